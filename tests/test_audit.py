import json
import zipfile
from io import BytesIO

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.functions import geometry, policy, signals
from gristmill.operators import audit
from gristmill.sources import files, sinks
from gristmill.tables import load


def value(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_strata_cap_against_a_loop(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"s{rng.integers(2)}", f"c{rng.integers(3)}", f"g{rng.integers(9)}", int(rng.integers(50))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, s string, c string, g string, t long")

    def quota(counts, n):
        seats = sorted((q > 1, -m / q, k) for k, m in counts.items() for q in range(1, m + 1))[:n]
        return {k: sum(s[2] == k for s in seats) for k in counts}

    for cap in (0, 7, 40, 500):
        want = set()
        by = lambda k: {v: [r for r in rows if r[k] == v] for v in sorted({r[k] for r in rows})}
        for s, n in quota({s: len(r) for s, r in by(1).items()}, cap).items():
            cams = {c: [r for r in rows if r[1] == s and r[2] == c] for c in by(2)}
            for c, k in quota({c: len(r) for c, r in cams.items() if r}, n).items():
                groups = {}
                for r in sorted(cams[c], key=lambda r: (r[4], r[0])):
                    groups.setdefault(r[3], []).append(r)
                names = sorted(groups, key=lambda g: (groups[g][0][4], g))
                middle = {g: [r for _, _, r in sorted((abs(i - (len(v) - 1) / 2), i, r) for i, r in enumerate(v))] for g, v in groups.items()}
                if k < len(names):
                    want |= {middle[names[(2 * j + 1) * len(names) // (2 * k)]][0][0] for j in range(k)}
                else:
                    want |= {r[0] for r in [middle[g][i] for i in range(300) for g in names if i < len(middle[g])][:k]}
        got = audit.strata_cap(df, "s", "c", "g", "t", "id", cap).where("selected").collect()
        assert {r.id for r in got} == want


def test_balanced_by_split(spark):
    df = spark.createDataFrame([(i, "train" if i < 8 else "test", "a" if i % 4 else "b") for i in range(12)], "id long, split string, g string")
    got = [r.id for r in audit.balanced_by_split(df, "id", "split", "g", {"train": 0.5, "validation": 0.25, "test": 0.25}, 8).collect()]
    # train 4 in turns of a, b; test 2; two more in turns from what is left
    assert sorted(got) == [0, 1, 2, 3, 4, 5, 8, 9]
    assert audit.balanced_by_split(df, "id", "split", "g", {"train": 1.0}, 20).count() == 12


def test_exclusions_and_ids(spark):
    rows = spark.createDataFrame([(1, "train", "a"), (2, "test", "a"), (3, "train", "b")], "id long, split string, g string")
    d = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, "a", "x"), (3, "c", "x"), (9, "a", "x")], "id long, g string, why string")
    issues = audit.exclusion_issues(rows, d, "id", "split", "g", "why")
    assert {(r.id, r.issue) for r in issues.collect()} == {(1, "repeated"), (2, "not_train"), (3, "group_changed"), (9, "missing")}
    with pytest.raises(ValueError):
        audit.excluded(rows, d, "id", issues)
    good = d.where("id = 1").distinct()
    assert {r.id for r in audit.excluded(rows, good, "id", audit.exclusion_issues(rows, good, "id", "split", "g", "why")).collect()} == {2, 3}
    assert sorted(r.new for r in audit.renumbered(rows, d, "id").collect()) == [4, 5, 6, 7]


def test_receipts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id long, t string")
    a = audit.receipt(df, ["id", "t"]).first()
    assert a == audit.receipt(df.orderBy(F.desc("id")).repartition(3), ["id", "t"]).first() and a.digest != audit.receipt(df.distinct(), ["id", "t"]).first().digest
    assert audit.receipt(df.limit(0), ["id", "t"]).first().rows == 0
    chain = spark.createDataFrame([(0, 3, "x", None, None), (1, 2, "y", 3, "x"), (2, 2, "z", 9, "y"), (3, 1, "w", 2, "no"), (7, 1, "q", 1, "w")], "step long, rows long, digest string, parent_rows long, parent_digest string")
    assert {(r.step, r.issue) for r in audit.chain_issues(chain).collect()} == {(2, "rows"), (3, "digest"), (7, "missing_parent")}


def test_masks_and_signals(spark):
    mask = [0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0]
    assert value(spark, audit.dilated(F.array(*[F.lit(m) for m in mask]), 4)) == [1, 1, 1, 0, 1, 1, 1, 0, 1, 1, 1, 0]
    assert value(spark, audit.dilated(F.array(*[F.lit(m) for m in [1, 0, 0, 0, 0, 0]]), 3)) == [1, 1, 0, 1, 1, 0]
    rng = np.random.default_rng(3)
    r = rng.normal(size=90)
    df = spark.createDataFrame([(r.tolist(), (5 + 3 * r[41:60]).tolist()), (r.tolist(), [1.0] * 5), ([1.0], r.tolist()), (None, None)], "r array<double>, q array<double>")
    got = [(x.s.place, x.s.score) for x in df.select(signals.contained_offset("r", "q").alias("s")).collect()]
    assert got[0] == (41, pytest.approx(1.0)) and [g[0] for g in got[1:]] == [None] * 3


def test_geometry(spark):
    p = value(spark, geometry.grid_to_lonlat(F.lit(3962799.45), F.lit(2999718.85)))
    assert (p.lon, p.lat) == (pytest.approx(5.0, abs=1e-7), pytest.approx(50.0, abs=1e-7))
    centre = value(spark, geometry.grid_to_lonlat(F.lit(4321000.0), F.lit(3210000.0)))
    assert (centre.lon, centre.lat) == (pytest.approx(10.0), pytest.approx(52.0))
    lit = lambda *v: [F.lit(float(x)) for x in v]
    seen = value(spark, geometry.project(lit(0, 10, 1), lit(0, 0, 0), lit(0, 1, 0), 100.0, 640, 480))
    assert (seen.u, seen.v, seen.depth) == (pytest.approx(320.0), pytest.approx(230.0), pytest.approx(10.0))
    behind = value(spark, geometry.project(lit(0, -1, 0), lit(0, 0, 0), lit(0, 1, 0), 100.0, 640, 480))
    assert behind.u is None and behind.depth == -1.0
    h = 0.5**0.5  # a quarter turn about z
    assert value(spark, F.array(*geometry.rotated(lit(1, 0, 0), lit(h, 0, 0, h)))) == [pytest.approx(0.0, abs=1e-12), pytest.approx(1.0), pytest.approx(0.0)]


def test_policies(spark):
    lit = F.lit
    delay = lambda h, a: value(spark, policy.retry_delay(lit(h).cast("string"), lit(a), 30.0))
    assert [delay(None, 2), delay(" 7 ", 2), delay("soon", 3), delay("99", 0), delay("1", 9)] == [4.0, 7.0, 8.0, 30.0, 30.0]
    plan = value(spark, policy.training_plan(lit(33), 8, 2, 3, 9))
    assert tuple(plan) == (5, 3, 9, True)
    content = value(spark, policy.message_content(lit(" a <image><image> b"), F.array(lit("1"), lit("2")), "<image>"))
    assert [tuple(c) for c in content] == [("text", "a"), ("image", "1"), ("image", "2"), ("text", "b")]
    assert value(spark, policy.message_content(lit("a"), F.array(lit("1")), "<image>")) is None
    kinds = [value(spark, policy.artifact_class(lit(p), lit(c), lit(r), ["cache"], [".pt"], [".tar"])) for p, c, r in (("a/Cache/x.pt", True, True), ("a/x.pt", True, True), ("a/x.pt", False, True), ("a/x.PT", False, False), ("a/x.tar", False, False), ("a.tar/x", False, False))]
    assert kinds == ["rebuildable_cache", "active_local", "remote_available", "legacy_model", "unused_dataset", "unknown"]
    family = lambda v, r: value(spark, policy.family(lit(v), lit(r).cast("string"), [("m", "web[0-9]+[.]jpg", "origin")], [("ab", "one"), ("b", "two")]))
    assert [family("m", "x/web12.jpg"), family("m", "web12.jpg.png"), family("xAB", None), family("cB", ""), family("z", "q")] == ["origin", "m", "one", "two", "z"]
    assert audit.gates_from('[{"column": "n", "operator": ">=", "target": 2}]') == [("n", ">=", 2.0, "error")]
    with pytest.raises(ValueError):
        audit.gates_from('[{"column": "n", "operator": "~", "target": 2}]')


def test_harvest(spark):
    schema = "a_relpath string, n int, s struct<b_relpath: string, l: array<struct<c_relpath: string, d: array<string>, e_relpath: array<string>>>>"
    df = spark.createDataFrame([("x", 1, ("y", [("z", ["no"], ["w", "x"]), (None, None, None)])), (None, 2, None)], schema)
    assert policy.leaves(df.schema, "_relpath") == ["a_relpath", "s.b_relpath", "s.l.c_relpath", "s.l.e_relpath"]
    assert [r.p for r in df.orderBy("n").select(policy.harvested(df.schema, "_relpath").alias("p")).collect()] == [["w", "x", "y", "z"], []]


def test_sources(spark, sf, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "m.json").write_text("{}")
    assert files.find_unique(spark, str(tmp_path), "m.json").endswith("/a/b/m.json")
    (tmp_path / "a" / "m.json").write_text("{}")
    for name in ("m.json", "none.json"):
        with pytest.raises(ValueError):
            files.find_unique(spark, str(tmp_path), name)
    with pytest.raises(ValueError):
        files.expect_rows(spark.range(3), 4)
    assert files.expect_rows(spark.range(3), 3).count() == 3
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 2.0], [0.0, 0.0]]
    shapes = [("Point", [5, 6.5]), ("Polygon", [ring]), ("MultiPolygon", [[ring], [ring]]), ("LineString", ring)]
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"i": i}, "geometry": {"type": k, "coordinates": c}} for i, (k, c) in enumerate(shapes)]}, indent=1))
    got = files.geojson_points(spark, f"{tmp_path}/g.json")
    assert {(r.feature, r.kind, r["count"]) for r in got.groupBy("feature", "kind").count().collect()} == {(0, "Point", 1), (1, "Polygon", 4), (2, "MultiPolygon", 8), (3, "LineString", 4)}
    assert tuple(got.where("feature = 0").select("lon", "lat").first()) == (5.0, 6.5) and json.loads(got.where("feature = 1").first().properties) == {"i": 1}
    assert load(spark, "/x/", "nation", lambda s, p: s.range(2).withColumn("p", F.lit(p))).first().p == "/x/nation"


def test_zip_archives(spark):
    df = spark.createDataFrame([(0, "b", b"2"), (0, "a", b"1"), (1, "c", None)], "shard long, name string, data binary")
    one, two = ({r.shard: r for r in sinks.zip_archives(x, "shard", "name", "data").collect()} for x in (df, df.orderBy(F.desc("name")).repartition(2)))
    assert {k: r.sha256 for k, r in one.items()} == {k: r.sha256 for k, r in two.items()}
    z = zipfile.ZipFile(BytesIO(bytes(one[0].archive)))
    assert [(n, z.read(n)) for n in z.namelist()] == [("a", b"1"), ("b", b"2")]


def test_pushed_filter(spark, sf):
    from gristmill.plans import review

    plan = review.pushed_filter(spark, sf)._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(EqualTo(user_id,13),EqualTo(event_type,error))]" in plan
