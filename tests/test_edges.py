"""Queries and operators on inputs that the small tables do not hold."""

import hashlib
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gristmill import plans
from gristmill.functions import hashing
from gristmill.operators import near, quality, relational
from gristmill.plans import curation


def against_sql(spark, folder, name, **tables):
    """The query and its SQL over tables of literal rows, both sorted."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table, rows in tables.items():
        pq.write_table(rows, f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = plans.queries()[name](spark, str(folder))
    want = con.execute(plans.oracle_sql()[name])
    columns = sorted(got.columns)
    at = [[c[0] for c in want.description].index(c) for c in columns]
    return sorted(map(tuple, got.select(*columns).collect())), sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_active_users_outside_the_range_and_between_seconds(spark, tmp_path):
    day, start = 86_400_000_000, 1_704_067_200_000_000
    spans = [(-400, 400)] * 2 + [(0, 3)] + [(40, 80)] * 3  # two reach out of the range, three never reach it
    stamps = [(u, start + day * t) for u, s in enumerate(spans) for t in s]
    stamps += [(9, start + 5 * day + 600_000), (9, start + 6 * day + 500_000), (10, start + 8 * day + 500_001), (10, start + 10 * day - 400_000), (11, None)]
    events = pa.table({"event_id": range(len(stamps)), "user_id": [u for u, _ in stamps], "ts": pa.array([t for _, t in stamps], pa.timestamp("us"))})
    got, want = against_sql(spark, tmp_path, "active_users", events=events)
    assert got == want and [r[1] // 86400 - start // day for r in got] == [0, 1, 2, 3, 6, 9, 10]


def signed(sig):
    return sig - (1 << 64) if sig >> 63 else sig


def close(count, seed, flips=6):
    """Signatures around one, with a few bits changed: all of a band or two."""
    rng = random.Random(seed)
    base = rng.getrandbits(64)
    return sorted({base ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, flips))) for _ in range(count)})


def near_by_force(sigs, radius):
    return {(i, j, d) for i in range(len(sigs)) for j in range(i + 1, len(sigs)) if (d := (sigs[i] ^ sigs[j]).bit_count()) <= radius}


def test_near_signatures_make_no_row_for_a_pair_that_is_only_compared(spark):
    sigs = close(700, 5)
    df = spark.createDataFrame([(i, signed(s), 1) for i, s in enumerate(sigs)], "id long, sig long, n long")
    found = relational.signature_pairs(df, df, 3)
    assert "Join" not in found._jdf.queryExecution().toString()
    got = [tuple(r) for r in found.where("a < b").collect()]
    assert len(got) == len(set(got)) and set(got) == near_by_force(sigs, 3)
    once = [tuple(r) for r in relational.class_pairs(df, 3).collect()]
    assert sorted(once) == sorted(got)


def test_large_bands_are_dealt_in_blocks(monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 40)
    monkeypatch.setattr(near, "CHUNK", 500)
    sigs, masks = close(300, 6) + close(25, 7) + [random.Random(8).getrandbits(64) for _ in range(50)], hashing.band_masks(4)
    rows = sorted((hash((k, s & m)), i, signed(s), k, 3) for i, s in enumerate(sigs) for k, m in enumerate(masks))
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["k", "id", "sig", "band", "side"])
    pairs, got, units = near._Pairs(masks, 4, True), [], 0
    for b in near._passed(iter(table.to_batches(max_chunksize=70)), pairs):
        for a, c, d, x, y in zip(*(col.to_pylist() for col in b.columns), strict=True):
            if x is None:
                got.append((a, c, d))
            else:
                units += 1
                pairs.blocks(np.frombuffer(x, near._ROW), None if y is None else np.frombuffer(y, near._ROW))
    while (found := pairs.taken()) is not None:
        got += zip(*(c.to_pylist() for c in found.columns[:3]), strict=True)
    assert units > 10 and len(got) == len(set(got)) and set(got) == near_by_force(sigs, 4)


def test_signatures_of_long_and_odd_texts():
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a", "a b", "x\x1cy\x0bz\x85 \xa0", "é" * 100 + " z"] + [" ".join(rng.choices("abcdefg", k=n)) for n in (254, 255, 256, 16319, 16320, 16321, 40000)]

    def plain(text):
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
        hashes = [int(hashlib.md5(w.encode()).hexdigest()[:16], 16) for w in words]
        return signed(sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))) if words else None

    assert hashing._simhash.func(pd.Series(texts)).astype(object).where(lambda s: s.notna(), None).tolist() == [plain(t) for t in texts]


@pytest.mark.parametrize("name", ["mirrored_pairs", "near_pairs_confirmed"])
def test_pairs_compare_without_a_join_of_bands(spark, sf, name):
    assert "band" not in plans.queries()[name](spark, sf)._jdf.queryExecution().toString()


def test_one_signature_of_many_lengths_makes_rows_for_confirmed_pairs_only(spark, tmp_path, monkeypatch):
    made, written = [], near.written
    monkeypatch.setattr(near, "written", lambda df, name: made.append(written(df, name)) or made[-1])
    texts = ["a " * (15 * i) + "b" * (i % 3) for i in range(1, 251)] + ["a " * 30 + "\n" * i for i in range(80)] + ["a  " * 40, None, "", " \n", "a" * 70, "a"]
    docs = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    got, want = against_sql(spark, tmp_path, "near_pairs_confirmed", documents=docs)
    assert got == want and len(got) > 1000
    assert sum(df.count() for df in made) == len(got)  # 250 lengths of a signature make 31,125 pairs


def test_features_in_large_and_small_bands(monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 40)
    monkeypatch.setattr(near, "CHUNK", 500)
    monkeypatch.setattr(near, "STRIP", 16)
    rng, masks = random.Random(9), hashing.band_masks(3)
    sigs = close(90, 10, 4) + [12345] * 400 + close(25, 11)
    f = [(rng.randint(0, 600), rng.randint(-30, 30)) for _ in sigs]
    rows = sorted((hash((k, s & m)), f[i][0], i, signed(s), k, 3, f[i][1]) for i, s in enumerate(sigs) for k, m in enumerate(masks))
    k, c, i, sig, band, side, w = zip(*rows, strict=True)
    table = pa.table({"k": k, "id": i, "sig": sig, "band": pa.array(band, pa.int32()), "side": pa.array(side, pa.int32()), "f0": c, "f1": w})
    pairs, got, units = near._Pairs(masks, 3, True, 2, 20), [], 0
    for b in near._passed(iter(table.to_batches(max_chunksize=70)), pairs):
        for a, c, d, x, y in zip(*(col.to_pylist() for col in b.columns), strict=True):
            if x is None:
                got.append((a, c, d))
            else:
                units += 1
                pairs.blocks(np.frombuffer(x, pairs.row), None if y is None else np.frombuffer(y, pairs.row))
    while (found := pairs.taken()) is not None:
        got += zip(*(c.to_pylist() for c in found.columns[:3]), strict=True)
    want = {(i, j, d) for i, j, d in near_by_force(sigs, 3) if abs(f[i][0] - f[j][0]) + abs(f[i][1] - f[j][1]) <= 20}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500
    assert 10 < units < 10 * 40  # a band of 400 or more makes 55 pairs of blocks at least


def test_each_text_is_signed_once(spark):
    df = spark.createDataFrame([(1, "a b"), (2, " "), (3, None)], "doc_id long, text string")
    signed_texts = hashing.simhash(df, "doc_id", "text")
    assert signed_texts._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r.id for r in signed_texts.collect()] == [1]


def test_rejects_and_components_join_no_sizes_of_classes(spark, sf, monkeypatch):
    monkeypatch.setattr(curation, "with_sizes", None)
    for name in ("cross_split_rejects", "component_keep_one"):
        assert plans.queries()[name](spark, sf).columns == ["id"]


def test_greedy_pass_over_a_long_chain(spark):
    chain = spark.range(400)
    edges = chain.where("id > 0").selectExpr("id - 1 as early", "id as late")
    assert sorted(r.id for r in quality.greedy_independent(chain, edges).collect()) == list(range(0, 400, 2))


def test_greedy_rounds_and_order_agree(spark):
    rng = random.Random(4)
    pairs = sorted({tuple(sorted(rng.sample(range(80), 2))) for _ in range(150)})
    want: set[int] = set()
    for i in range(80):
        if not any(late == i and early in want for early, late in pairs):
            want.add(i)
    edges = spark.createDataFrame(pairs, "early long, late long")
    for few in (0, 60, 1000):
        assert {r.id for r in quality.greedy_independent(spark.range(80), edges, few).collect()} == want
