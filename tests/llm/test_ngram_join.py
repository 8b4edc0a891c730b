import random
import re

import numpy as np
import pytest

from gristmill.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, n):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, num, den):
    sets = [shingle_set(t, n) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        seen = {j for x in s for j in index.get(x, ())}
        for j in seen:
            both = len(s & sets[j])
            if den * both >= num * (len(s) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for x in s:
            index.setdefault(x, []).append(i)
    least, same = {}, {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
        if sets[i]:
            same[frozenset(sets[i])] = min(same.get(frozenset(sets[i]), d), d)
    return sorted((d, len(sets[i]), same.get(frozenset(sets[i]), d), links[i], least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocab, k=25))
    rows = ["", None, " \n", "a", "A", "a b", "A B", "b a", "a b c", "a b c d", "x\x0by\x1cz"]
    for _ in range(40):
        base = rng.choices(vocab, k=rng.choice([3, 8, 30, 120, 400]))
        for _ in range(rng.choice([1, 1, 2, 5, 40])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.3:
                w.insert(rng.randrange(len(w)), passage)
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return [(i * 7 % 10007, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, n, num, den, block", [(1, 3, 9, 10, 512), (2, 5, 8, 10, 16), (3, 2, 5, 10, 8)])
def test_exact(spark, monkeypatch, seed, n, num, den, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in ngram_join.link(df, n, num, den).collect()) == brute(rows, n, num, den)


def test_frequent_table_does_not_change_results(spark, monkeypatch):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    monkeypatch.setattr(ngram_join, "OFTEN", 2)
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", 3)
    assert sorted(tuple(r) for r in ngram_join.link(df, 3, 9, 10).collect()) == brute(rows, 3, 9, 10)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.link(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0
    text = "one two three four five six seven"
    df = spark.createDataFrame([(5, text, 1, "a"), (5, text, 2, "b"), (None, text, 3, "c"), (9, text, 4, "d"), (None, None, 5, "e"), (7, "", 6, "f")], "doc_id long, text string, sig int, family string")
    got = ngram_join.link(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.n_links, r.component_id is None or r.component_id) for r in got) == [(False, 5, 3, 3, 5), (False, 5, 3, 3, 5), (False, 7, 0, 0, 7), (False, 9, 3, 3, 5), (True, 0, 0, 0, True), (True, 0, 3, 3, 5)]
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {5, 7, None}


def test_common_shingles(spark, monkeypatch):
    """One passage in a third of the rows, in texts that are little more than it, blocks of a few."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "PAIRS_UP_TO", 3)
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocab, k=40)
    rows = []
    for i in range(360):
        own = rng.choices(vocab, k=rng.choice([1, 2, 3, 6, 30, 60]))
        rows.append((i, " ".join(passage + own if i % 3 == 0 else own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for n, num, den in ((2, 6, 10),):
        assert sorted(tuple(r) for r in ngram_join.link(df, n, num, den).collect()) == brute(rows, n, num, den)


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 62, int(n)).astype(np.uint64)) for n in (1, 2, 60, 64, 65, 130, 500, 1000)]
    sets += [np.unique(np.concatenate((s[: -max(1, len(s) // 9)], sets[2][:3]))) for s in sets]
    got = ngram_join.apart([ngram_join.parity(s) for s in sets])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert got[i, j] == got[j, i] <= len(np.setxor1d(a, b)) and (i != j or got[i, j] == 0)


def test_least_shared():
    """No pair of random sets shares fewer prefix shingles than it must."""
    rng = random.Random(6)
    for _ in range(3000):
        num, den = rng.choice([(9, 10), (8, 10), (1, 2)])
        base = rng.sample(range(400), rng.randint(1, 120))
        a, b = (sorted(set(rng.sample(base, rng.randint(max(1, int(0.8 * len(base))), len(base))) + rng.sample(range(400), rng.randint(0, 5)))) for _ in "ab")
        both = len(set(a) & set(b))
        if den * both < num * (len(a) + len(b) - both):
            continue
        slack = [min(0, rng.randint(1, 8) - ngram_join.needed(len(x), num, den)) for x in (a, b)]
        prefixes = [set(x[: len(x) + s]) for x, s in zip((a, b), slack, strict=True)]
        least = ngram_join.shared(np.array([len(a)]), np.array(slack[:1]), np.array([len(b)]), np.array(slack[1:]), num, den)[0]
        assert len(prefixes[0] & prefixes[1]) >= least


def test_clashing_names(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(1, text, 1, 2, 3, "x"), (2, text, 4, 5, 6, "y")], "doc_id long, text string, k int, `a.b` int, SIG int, component string")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, text, 1, 2, 3, "x")]


def test_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, 20).astype(np.uint64)) for _ in range(30)]
    got = ngram_join.overlaps(sets, width=7)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(30) for j in range(30) if i != j)


def test_query(spark, sf):
    from gristmill.llm import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op4_ngram_join(spark, sf).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(a, b, e) for a, b, _, _, e in brute(rows, 3, 90, 100)]


def test_keep_one_goes_by_rows(spark):
    a = "one two three four five six seven eight nine ten eleven twelve"
    near, b, c = a.replace("twelve", "twelve thirteen"), "quite another text that no other row holds at all", "a text that only rows without an id hold here"
    rows = [(3, a, "x"), (3, a, "y"), (3, a.upper(), "z"), (7, near, "n"), (7, b, "own"), (8, b + "!", "own too"), (7, c + " and more words", "p"), (None, a, "copy"), (None, c, "q"), (None, c, "r"), (7, "", "s"), (7, "", "t"), (None, None, "u"), (None, None, "v")]
    df = spark.createDataFrame([(*r, {r[2]: 1}) for r in rows] * 2, "doc_id long, text string, tag string, m map<string, int>").repartition(5)
    kept = ngram_join.keep_one(df, 3, 8, 10)
    got = sorted((r.doc_id or 0, r.text or "", r.tag) for r in kept.collect())
    want = [(3, a.upper(), "z"), (7, b, "own"), (8, b + "!", "own too"), (7, c + " and more words", "p"), (0, c, "q")] + [(7, "", "s"), (7, "", "t"), (0, "", "u"), (0, "", "v")] * 2
    assert kept.columns == df.columns and got == sorted(want)


def test_keep_one_of_components_with_one_smallest_id(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(7, a), (9, a + " x"), (7, b), (8, b + " x"), (7, b + " y")]
    got = sorted(tuple(r) for r in ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), 5, 8, 10).collect())
    assert len(got) == 2 and got[0] == (7, a) and got[1] in [(7, b), (7, b + " y")]
