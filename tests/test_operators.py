import hashlib
import json
import math
import random
import tarfile
import unicodedata
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions import geometry, hashing, text
from gristmill.operators import graph, ordering, quality, relational
from gristmill.plans import curation
from gristmill.sources import files, sinks


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expr.alias("x")).first().x


def test_hashes(spark, sf):
    for k in ("a", "é", ""):
        h = hashlib.sha256(k.encode()).hexdigest()
        assert one(spark, hashing.sha256_mod(F.lit(k))) == int(h, 16) % 10000
        assert one(spark, hashing.unit_interval(F.lit(k))) == int(h[:8], 16) / 0xFFFFFFFF
    for r in curation.blake_bucket(spark, sf).collect():
        assert r.bucket == int.from_bytes(hashlib.blake2b(str(r.doc_id).encode(), digest_size=8).digest(), "big") % 100
    assert one(spark, hashing.hamming(F.lit(-1), F.lit(0).cast("long"))) == 64
    assert one(spark, hashing.hex64(F.lit("ffffffffffffffff"))) == -1


def test_bands_are_exact(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(20)]
    sigs = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(6)]
    signed = [s - (1 << 64) if s >> 63 else s for s in sigs]
    df = spark.createDataFrame(list(enumerate(signed)), "id long, sig long")
    for radius in (0, 3, 7):
        got = [(r.a, r.b) for r in relational.signature_pairs(df, df, radius).where("a < b").collect()]
        assert sorted(got) == [(i, j) for i in range(len(sigs)) for j in range(i + 1, len(sigs)) if (sigs[i] ^ sigs[j]).bit_count() <= radius]


def test_text(spark):
    assert one(spark, text.slug(F.lit("  Ab--c é!"))) == "ab-c-é"
    assert one(spark, text.strip_number(F.lit("camera-200"))) == "camera" and one(spark, text.strip_number(F.lit("-200"))) == "-200"
    assert one(spark, text.date_bucket(F.lit(""))) == "date-unknown"
    assert str(one(spark, text.parse_time(F.lit("2024-01-02T03-04-05")))) == "2024-01-02 03:04:05" and one(spark, text.parse_time(F.lit("x"))) is None
    assert [one(spark, text.licence_id(F.lit(x))) for x in ("https://creativecommons.org/licenses/by-sa/4.0/", "CC BY-NC 4.0", "MIT License", "other")] == ["cc-by-sa-4.0", "cc-by-nc-4.0", "mit", None]
    assert one(spark, text.nfc(F.lit("é"))) == unicodedata.normalize("NFC", "é") and one(spark, text.casefold(F.lit("Straße"))) == "strasse"
    assert one(spark, text.join_url(F.lit("http://a/b/c"), F.lit("../d"))) == "http://a/d" and one(spark, text.base36(F.lit("ff"))) == "73"


def test_geometry(spark):
    box = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert one(spark, geometry.iou(box(0, 0, 2, 2), box(1, 1, 2, 2))) == pytest.approx(1 / 7) and one(spark, geometry.iou(box(0, 0, 0, 0), box(0, 0, 0, 0))) == 0
    assert one(spark, geometry.union_box(F.array(box(0, 0, 1, 1), box(2, 3, 1, 1)))) == [0, 0, 3, 4]
    assert one(spark, geometry.tile_starts(F.lit(100), 40, 30)) == [0, 30, 60] and one(spark, geometry.tile_starts(F.lit(10), 40, 30)) == [0]
    assert one(spark, geometry.clip(box(5, 5, 10, 10), F.lit(10.0), F.lit(0.0), 8)) == [0, 5, 5, 3]
    assert one(spark, geometry.fold16(F.array(F.lit(1), F.lit(2)))) == 18 and one(spark, geometry.letterbox(F.lit(200), F.lit(100), 50)) == 0.25
    assert one(spark, geometry.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) == pytest.approx(111194.9, abs=1)


def test_reasons(spark):
    df = spark.createDataFrame([(1, "x"), (None, "SECRET")], "a int, b string")
    got = df.select(relational.first_reason([("null", F.col("a").isNull()), ("any", F.lit(True))]).alias("r"), relational.mentions(df, ["secret"]).alias("m")).collect()
    assert [(r.r, r.m) for r in got] == [("any", False), ("null", True)]


def test_alias_and_pairs(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, [])], "id long, aliases array<string>")
    frozen = spark.createDataFrame([("b",)], "name string")
    assert {r.id for r in relational.alias_anti(rows, "id", "aliases", frozen, "name").collect()} == {2, 3}
    sides = spark.createDataFrame([(1, "p_left", "left"), (2, "p_right", "right"), (3, "q_left", "left")], "id long, path string, side string")
    got = {r.pair_key: (r.left, r.right, r.complete) for r in relational.pairs_by_key(sides, F.regexp_replace("path", "_(left|right)$", ""), "side", ("left", "right")).collect()}
    assert got == {"p": (1, 2, True), "q": (3, None, False)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 10 != 9] + [(100, 100), (200, 100), (None, 1)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: i // 10 * 10 for i in range(60)} | {60: 60, 100: 100, 200: 100} or got == {i: i // 10 * 10 for i in range(60)} | {100: 100, 200: 100}
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_greedy_is_sequential(spark):
    rng = random.Random(9)
    edges = {(min(a, b), max(a, b)) for a, b in ((rng.randrange(60), rng.randrange(60)) for _ in range(90)) if a != b}
    accepted = []
    for i in range(60):
        if not any((j, i) in edges for j in accepted):
            accepted.append(i)
    got = quality.greedy_independent(spark.range(60), spark.createDataFrame(sorted(edges), "early long, late long"))
    assert sorted(r.id for r in got.collect()) == accepted


def test_thinning_and_fill(spark, sf):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate([0, 5, 9, 10, 14, 20, 31])], "k long, id long, s long").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    assert sorted(r.id for r in ordering.thinned(df, "k", "ts", "id", 10).collect()) == [0, 3, 5, 6]
    sizes = {r.source: r["count"] for r in spark.read.parquet(f"{sf}/documents.parquet").groupBy("source").count().collect()}
    filled, want = dict.fromkeys(("train", "validation", "test"), 0.0), {}
    target = {"train": 0.7, "validation": 0.15, "test": 0.15}
    for s, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        k = min(target, key=lambda t: (filled[t] / target[t], list(target).index(t)))
        filled[k] += n
        want[s] = k
    assert {r.source: r.split for r in curation.greedy_split(spark, sf).collect()} == want


def test_bootstrap(spark):
    rows = [(i, float(i % 7)) for i in range(50)]
    got = {r.round: r.statistic for r in ordering.bootstrap(spark.createDataFrame(rows, "id long, v double"), "id", "v", 20, 7).collect()}
    weight = lambda r, i: sum(int(hashlib.md5(f"7:{r}:{i}".encode()).hexdigest()[:8], 16) / 2**32 >= p for p in ordering.POISSON)
    for r in range(20):
        w = [weight(r, i) for i, _ in rows]
        assert abs(got[r] - sum(x * v for x, (_, v) in zip(w, rows, strict=True)) / sum(w)) < 1e-12


def test_within_metres(spark):
    """All places within a radius, at the poles and across the date line too."""
    rng = random.Random(8)
    places = [(i, rng.uniform(-180, 180), rng.choice([rng.uniform(-90, 90), 89.9, -89.9])) for i in range(150)] + [(150, 179.99, 0.0), (151, -179.99, 0.0), (152, 0.0, 90.0)]
    a, b = (spark.createDataFrame(places, f"{n} long, lon{k} double, lat{k} double") for n, k in (("a", 1), ("b", 2)))

    def far(p, q):
        x, y = (math.radians(v) for v in (p[2], q[2]))
        h = math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
        return 2 * geometry.EARTH_M * math.asin(min(1.0, math.sqrt(h)))

    for metres in (5_000.0, 800_000.0):
        got = {(r.a, r.b) for r in relational.within_metres(a, b, metres).collect()}
        assert got == {(p[0], q[0]) for p in places for q in places if far(p, q) <= metres} and (150, 151) in got


def test_search_in_blocks(spark, monkeypatch):
    """Blocks, ties, nulls and vectors of another length against plain loops."""
    from gristmill.operators import search

    monkeypatch.setattr(search, "QUERIES", 3)
    monkeypatch.setattr(search, "ROWS", 4)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 3)], "ab"[i % 2]) for i in range(40)]
    odd = [(50, [1.0], "a"), (51, None, "a"), (None, [1.0, 1.0, 1.0], "a"), (52, [1.0, None, 0.0], "b")]
    df = spark.createDataFrame(rows + odd, "id long, v array<double>, l string").repartition(3)
    q, r = df.where("id % 5 = 0").select(F.col("id").alias("a"), F.col("v").alias("x"), F.col("l").alias("la")), df.select(F.col("id").alias("b"), F.col("v").alias("y"), F.col("l").alias("lb"))
    order = {a: sorted((-sum(x * y for x, y in zip(v, w, strict=True)), b, m) for b, w, m in rows if b != a) for a, v, _ in rows if a % 5 == 0}
    got = search.dot_top_k(q.drop("la"), r.drop("lb"), 4, 3).collect()
    assert sorted((x.a, x.rank, x.b) for x in got) == [(a, k + 1, o[k][1]) for a, o in sorted(order.items()) for k in range(4)]
    first = {x.a: x.first for x in search.first_hit_rank(q, r, 3).collect()}
    assert first == {a: next(k + 1 for k, (_, _, m) in enumerate(o) if m == "ab"[a % 2]) for a, o in order.items()}
    assert search.dot_top_k(q.limit(0).drop("la"), r.drop("lb"), 4, 3).count() == 0
    sigs = spark.createDataFrame([(i, int(x)) for i, x in enumerate(rng.integers(-(2**63), 2**63 - 1, 60))], "id long, sig long")
    near = {x.a: (x.distance, x.b) for x in search.nearest_signature(sigs.where("id < 10"), sigs.where("id >= 10")).collect()}
    s = {x.id: x.sig for x in sigs.collect()}
    assert near == {a: min((((s[a] ^ s[b]) & (2**64 - 1)).bit_count(), b) for b in range(10, 60)) for a in range(10)}


def test_gates(spark, tmp_path):
    one_row = spark.createDataFrame([(3, None)], "n int, m double")
    gates = quality.gate_table(one_row, [("n", ">=", 2, "hard"), ("m", "<=", 1, "soft")])
    assert [(r.gate, r.passed) for r in gates.collect()] == [("n", True), ("m", False)]
    assert not sinks.publish_if(one_row, gates, f"{tmp_path}/p") and not (tmp_path / "p").exists()
    assert sinks.publish_if(one_row, gates.where("passed"), f"{tmp_path}/p") and (tmp_path / "p").exists()
    assert [one(spark, quality.ratio(F.lit(1), F.lit(0), s)) for s in ("zero", "max1", "null")] == [0, 1, None]


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('﻿{"a": 1}\n\n{"a": "x"}\nnot json\n{"a": 2}\n')
    schema = T.StructType([T.StructField("a", T.LongType())])
    rows, bad = files.jsonl_recording(spark, f"{tmp_path}/a.jsonl", schema)
    assert sorted(r.a for r in rows.collect()) == [1, 2] and bad.count() == 2
    with pytest.raises(Exception):  # noqa: B017
        files.jsonl_strict(spark, f"{tmp_path}/a.jsonl", schema).collect()
    (tmp_path / "c.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "x", "width": 2, "height": 3}, {"id": 2, "file_name": "y", "width": 2, "height": 3}], "annotations": [{"id": 5, "image_id": 1, "category_id": 0, "bbox": [0, 0, 1, 1]}], "categories": [{"id": 0, "name": "n"}]}))
    images, ann, cats = files.coco(spark, f"{tmp_path}/c.json")
    assert {r.id: len(r.annotations or []) for r in images.collect()} == {1: 1, 2: 0} and ann.count() == cats.count() == 1
    (tmp_path / "m").mkdir()
    (tmp_path / "m/x").write_text("hello")
    with tarfile.open(tmp_path / "m/t.tar", "w") as t:
        t.add(tmp_path / "m/x", "d/x")
        t.add(tmp_path / "m/x", "../evil")
    with zipfile.ZipFile(tmp_path / "m/z.zip", "w") as z:
        z.writestr("y", "zip")
    got = {r.member: (r.size, r.unsafe, r.content and bytes(r.content)) for r in files.archive_members(spark, f"{tmp_path}/m/*.*").collect()}
    assert got == {"d/x": (5, False, b"hello"), "../evil": (5, True, None), "y": (3, False, b"zip")}
    (tmp_path / "h.txt").write_text("AB\nab\n\ncd \n")
    assert {r.hash for r in files.hash_set(spark, f"{tmp_path}/h.txt").collect()} == {"ab", "cd"}
    with pytest.raises(ValueError, match="not unique"):
        files.unique_or_fail(spark.createDataFrame([(1,), (1,)], "k int"), "k")
    inv = {r.length: r.sha256 for r in files.inventory(spark, f"{tmp_path}/m", "x").collect()}
    assert inv == {5: hashlib.sha256(b"hello").hexdigest()}


def test_positions_and_pages(spark, tmp_path):
    spark.range(20).coalesce(1).write.parquet(f"{tmp_path}/p")
    all_rows = files.parquet_by_position(spark, f"{tmp_path}/p", ["id"])
    wanted = all_rows.where("row in (3, 7)").select("file", "row")
    assert sorted(r.id for r in files.parquet_by_position(spark, f"{tmp_path}/p", ["id"], wanted).collect()) == [3, 7]
    reviews = spark.createDataFrame([(1, "accept", 1), (1, "reject", 2)], "id long, decision string, reviewed_at long")
    page, total = files.page_of(spark.range(5), reviews, "id", "unreviewed", "id", 1, 2)
    assert ([r.id for r in page.collect()], total) == ([2, 3], 4)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, None)], "z int, a string")
    assert sinks.write_jsonl(df, f"{tmp_path}/j", "z") == sinks.write_jsonl(df.repartition(3), f"{tmp_path}/k", "z")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/j").collect()]
    assert sorted(lines, key=lambda x: x["z"]) == [{"a": None, "z": 1}, {"a": "b", "z": 2}]
    got = sinks.byte_shards(spark.createDataFrame([("g", i, s) for i, s in enumerate([50, 40, 20, 100, 1])], "g string, i int, s long"), "g", "i", "s", 100, 0)
    assert [r["shard"] for r in got.orderBy("i").collect()] == [0, 0, 1, 2, 3]
    rows = spark.createDataFrame([("x", [[0.0, 0.0, 1.0, 1.0]] * 2, [0, 1]), ("y", [], [])], "id string, b array<array<double>>, c array<int>")
    images, ann = sinks.coco_tables(rows, "id", "b", "c")
    assert sorted(r.image_id for r in images.collect()) == [1, 2] and sorted(r.annotation_id for r in ann.collect()) == [1, 2]
    sinks.cross_tab(df, ["z"], f"{tmp_path}/x")
    sinks.write_shards(spark.range(10).coalesce(1), f"{tmp_path}/s", 4)
    assert len(list((tmp_path / "s").glob("part-*"))) == 3


def test_sql_functions(spark):
    from gristmill.functions import sql

    assert sql.register(spark) == ["hamming64", "match_key", "hash_bucket", "haversine_m"]
    r = spark.sql("SELECT hamming64(-1L, 0L) AS a, match_key('  A  b ') AS b, round(haversine_m(0D, 0D, 0D, 1D)) AS c").first()
    assert (r.a, r.b, r.c) == (64, "a b", 111195)
