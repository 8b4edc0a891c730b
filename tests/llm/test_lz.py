import hashlib
import random

import numpy as np
import xxhash

from gristmill.llm import lz

ROWS = [(9, "abc" * 40), (3, None), (7, "héé日本 word " * 30), (5, ""), (4, "abc" * 40), (1, "x"), (-2, "short one")]


def phrases(data):
    seen, out, a = set(), set(), 0
    for b in range(1, len(data) + 1):
        if data[a:b] not in seen:
            seen.add(data[a:b])
            out.add(data[a:b])
            a = b
    if a < len(data):
        out.add(data[a:])
    return out


def test_parse_is_lz78():
    for data in (b"", b"a", b"aaaaaaa", b"abababababab", "héé日本".encode() * 20, bytes(range(256)) * 3, b"\x00" * 50):
        p = lz.Parse()
        p.feed(data, 0)
        ends = p.ends if not data or p.ends and p.ends[-1] == len(data) else [*p.ends, len(data)]
        assert {data[a:b] for a, b in zip([0, *ends], ends, strict=False)} == phrases(data)
        for keep in {0, len(data) // 2, len(data)}:
            own, made = lz.sketch_pair(data, keep, b"tail of it")
            assert np.array_equal(own, lz.sketch(data)) and np.array_equal(made, lz.sketch(data[:keep] + b"tail of it"))


def brute(rows):
    order = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) ^ 1 << 63  # noqa: E731  # signed order
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), order(r[1]), r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        third = len(t) // 3
        e = t[: len(t) - third] + nxt[:third]
        a, b, c = (lz.sketch(x.encode()) for x in (t, e, nxt))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), lz.as_text(a), lz.as_text(b), lz.likeness(a, b), lz.likeness(a, c)))
    return out


def key(r):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)


def test_neighbours(spark, sf):
    rows = ROWS + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in lz.compare_neighbours(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_many_rows_with_one_id(spark):
    """A third of the rows without an id, a third with the same one: both are cut into ranges."""
    rng = random.Random(2)
    rows = [((None, 7, i)[i % 3], " ".join(rng.choices(["ab", "cde", "f", "ghij"], k=rng.randint(0, 12)))) for i in range(300)]
    rows += [(7, "same text")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = [tuple(r) for r in lz.compare_neighbours(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_ranges():
    a, h = lz._ranges([1, 5, 5, 5, 9])
    assert a.tolist() == [1, 5, 5, 5, 9] and h[0] == h[3] == h[4] == 2**63 - 1 and h[1] < h[2] < h[3]
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 11, 500), rng.integers(-(2**63), 2**63 - 1, 500)
    want = [sum((p, q) < (i, j) for p, q in zip(a.tolist(), h.tolist(), strict=True)) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
    assert lz._range_of(x, y, (a, h)).tolist() == want


def test_error_of_the_estimate(spark, sf):
    """64 hashes estimate the similarity of phrase sets with a standard error of a sixteenth at most."""
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    off = []
    for t in texts:
        e = t[: len(t) * 2 // 3] + texts[0][: len(t) // 3]
        a, b = phrases(t.encode()), phrases(e.encode())
        off.append(lz.likeness(lz.sketch(t.encode()), lz.sketch(e.encode())) - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.sqrt(np.mean(np.square(off))) < 0.08


def test_edges(spark):
    for rows in ([], [(1, "alone")], [(1, None)], [(2, "b"), (2, "a"), (2, "a"), (None, "z")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = [tuple(r) for r in lz.compare_neighbours(df).collect()]
        assert len(got) == len(rows)
        if len(rows) < 4:
            assert sorted(got, key=key) == sorted(brute(rows), key=key)
    df = spark.createDataFrame([("a b c", "x"), ("a b c", "y"), (None, "z")], "text string, lz_fingerprint string")
    got = [r.lz_fingerprint for r in lz.fingerprints(df).collect()]
    assert got[0] == got[1] and got[2] == ""


def test_likeness_orders():
    a = " ".join(f"word{i * i % 997}" for i in range(400))
    b = " ".join(f"other{i * 7 % 991}" for i in range(400))
    s = [lz.sketch(x.encode()) for x in (a, a + " tail", b)]
    assert lz.likeness(s[0], s[0]) == 1 and lz.likeness(s[0], s[1]) > 0.8 > 0.4 > lz.likeness(s[0], s[2])
