import re

import pytest

from gristmill.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, window=8):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, covered = {}, set()
    for i in range(len(w) - window + 1):
        seen.setdefault(tuple(w[i : i + window]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(window)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


ODD = [None, "", " \n\t ", "a", "a b c d e f g h " * 2, "x " * 9, "x " * 8, "l\nl\n\nl \nm", "#*$%&|<> " * 30, "日本 é ü " * 12, "a\x0bb\x0cc\rd\x1ce " * 10, ("q w e r t y u i o p " * 3 + "z ") * 20]


def test_counts(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, kept string")
    got = {r.doc_id: r.quality_rules for r in quality.score(df).collect()}
    for i, t in docs:
        q = got[i]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == brute(t), (i, t)
        assert q.kept == (not q.failed) and not (q.base_failed and q.kept)


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "the text of it " * 8, 1, 2, 3, 4, 5)], "doc_id long, text string, __t int, W int, `a.b` int, m int, quality_rules int")
    (r,) = quality.score(df, out="q").collect()
    assert tuple(r)[:7] == tuple(df.first()) and r.q.n_words == 32
    assert quality.score(df).columns == ["doc_id", "text", "__t", "W", "a.b", "m", "quality_rules"]


@pytest.mark.parametrize("n", [30, 99, 100, 400])
def test_stop_words_count_at_any_length(spark, n):
    bare = [f"zq{i}v" for i in range(n)]
    rows = [(1, " ".join(bare)), (2, " ".join([*bare[: n - n // 20], *["the"] * (n // 20)]))]
    got = {r.doc_id: r.quality_rules for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "stop_words" in got[1].failed and "stop_words" not in got[2].failed and got[2].n_stop_words == n // 20


def test_plan_is_one_projection(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality.score(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert quality.score(df.limit(0)).count() == 0


@pytest.mark.parametrize("name, text", [("symbols", "word### other$$$ " * 20), ("capitals", "THE LOUD TEXT " * 3 + " ".join(f"W{chr(65 + i)}X" for i in range(25))), ("stop_words", " ".join(f"zq{i}v" for i in range(200)))])
def test_rules_reject(spark, name, text):
    (r,) = quality.score(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert name in r.quality_rules.failed and not r.quality_rules.kept
