import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from gristmill.llm import langid, queries
from gristmill.llm import text as kernel

EN = "the house of the king and his people is in this town with that old church "
FR = "la maison du roi et de ses gens est dans cette ville avec une vieille église "
RU = "дом короля и его людей стоит в этом городе рядом со старой церковью "


def plain(scores, penalty):
    n, k = scores.shape
    best = {(0, j): (scores[0, j], [j]) for j in range(k)}
    for t in range(1, n):
        for j in range(k):
            best[t, j] = max(((best[t - 1, i][0] - (i != j) * penalty + scores[t, j], best[t - 1, i][1] + [j]) for i in range(k)), key=lambda x: x[0])
    return max(best[n - 1, j][0] for j in range(k))


def value(scores, path, penalty):
    return scores[np.arange(len(path)), path].sum() - penalty * (np.diff(path) != 0).sum()


def test_viterbi_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = -rng.random((rng.integers(1, 12), 3)) * 6
        assert abs(value(s, langid.viterbi(s, 3.0), 3.0) - plain(s, 3.0)) < 1e-9


def test_viterbi_is_optimal_with_runs():
    """Runs of a language whose gain is near the penalty: two of them may share a switch."""
    s = np.array([[0, -6, -1.7]] * 4 + [[-6, 0, -1.7]] * 4)
    assert langid.viterbi(s, 8.0).tolist() == [0] * 4 + [1] * 4
    rng, switched = np.random.default_rng(11), 0
    for _ in range(1500):
        k, penalty = int(rng.integers(1, 5)), float(rng.choice([2, 4, 8]))
        runs = [int(rng.integers(k)) for _ in range(rng.integers(1, 5))]
        rows = [np.where(np.arange(k) == own, 0.0, -penalty * rng.random(k)) for own in runs for _ in range(rng.integers(1, 5))]
        s = np.round(np.array(rows) * rng.choice([0.3, 0.6, 1.0]), 1)
        path = langid.viterbi(s, penalty)
        switched += len(set(path.tolist())) > 1
        assert abs(value(s, path, penalty) - plain(s, penalty)) < 1e-9
        if langid.constant(s, penalty) is not None:
            assert abs(value(s, np.full(len(s), langid.constant(s, penalty)), penalty) - plain(s, penalty)) < 1e-9
    assert switched > 100


def letters(word):
    found = [c for c in word.decode() if unicodedata.category(c)[0] == "L"]
    return len(found), max((s for s in langid.SCRIPTS if found and s[0] <= ord(found[0])), default=(0, None))[1]


def bins(word):
    raw = b"\0" + word + b"\0"
    for n in (1, 2, 3, 4):
        for i in range(len(raw) - n + 1):
            h = (int.from_bytes(raw[i : i + n], "big") * 2654435761 + n * 40503) % 2**32
            yield ((h ^ h >> 15) * 2246822519 % 2**32) >> 16


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute(train, texts, penalty=8.0, floor=-6.0):
    """(language, score) of each text, by counting in dictionaries and trying all paths."""
    langs = sorted({k for _, k in train})
    grams, seen, shape, sizes = {k: Counter() for k in langs}, {k: Counter() for k in langs}, {}, Counter(k for _, k in train)
    look = lambda w: shape.setdefault(w, (*letters(w), list(bins(w))))
    for text, k in train:
        for w, c in Counter(words(text)).items():
            n, script, hit = look(w)
            if n:
                seen[k][script] += n * c
                for b in hit:
                    grams[k][b] += c
    total = {k: sum(grams[k].values()) + 0.5 * langid.BINS for k in langs}
    uses = {k: {s for s, n in seen[k].items() if n >= 0.01 * max(1, sum(seen[k].values()))} for k in langs}
    known = {}

    def word(w):
        n, script, hit = look(w)
        if not n or not any(script in uses[k] for k in langs):
            return [0.0] * len(langs)
        raw = [sum(math.log((grams[k][b] + 0.5) / total[k]) for b in hit) / 4 if script in uses[k] else -1e30 for k in langs]
        top = max(raw)
        norm = math.log(sum(math.exp(x - top) for x in raw))
        return [max(x - top - norm, floor) for x in raw]

    for text in texts:
        ws = words(text)
        if not any(look(w)[0] for w in ws):
            yield "und", 0.0
            continue
        scores = [known[w] if w in known else known.setdefault(w, word(w)) for w in ws]
        if not any(map(any, scores)):
            path = [max(range(len(langs)), key=lambda i: (sizes[langs[i]], langs[i]))] * len(ws)
        else:
            best, back = list(scores[0]), []
            for row in scores[1:]:
                came = [max(range(len(langs)), key=lambda i: best[i] - (i != j) * penalty) for j in range(len(langs))]
                best = [best[c] - (c != j) * penalty + row[j] for j, c in enumerate(came)]
                back.append(came)
            path = [max(range(len(langs)), key=best.__getitem__)]
            for came in reversed(back):
                path.append(came[path[-1]])
            path.reverse()
        share = Counter()
        for w, k in zip(ws, path, strict=True):
            share[k] += look(w)[0]
        top = max(range(len(langs)), key=lambda k: (share[k], -k))
        yield langs[top], share[top] / sum(share.values())


def test_query_against_brute_force(spark, sf):
    docs = sorted((r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect())
    held = {d: zlib.crc32(str(d).encode()) % 4 == 2 for d, *_ in docs}
    train = [(t, k) for d, t, k in docs if not held[d] and t is not None and k is not None]
    assert len(train) < 1500
    got = sorted((r.doc_id, r.held_out, r.lang_pred, r.score) for r in queries.op5_langid(spark, sf).collect())
    for (d, h, lang, score), (want, share) in zip(got, brute(train, [t for _, t, _ in docs]), strict=True):
        assert h == held[d] and lang == want and abs(score - share) < 1e-6, d


def test_clashing_names(spark):
    model = langid.train(spark.createDataFrame([(EN, "en"), (FR, "fr")] * 3, "text string, lang string"))
    df = spark.createDataFrame([(1, EN, "mine", 5)], "doc_id long, text string, language string, `a.b` int")
    (r,) = langid.predict(df, model, out="found").collect()
    assert r.language == "mine" and r["a.b"] == 5 and r.found.lang == "en"


def test_spans_and_edges(spark):
    rows = [(EN * 5, "en"), (FR * 5, "fr"), (RU * 5, "ru"), (None, "en"), (EN, None)] * 4
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["en", "fr", "ru"]
    texts = [EN, FR, RU, None, "", "12 34 !!", EN * 3 + FR, "日本語", "église"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, language string")
    got = {r.doc_id: r.language for r in langid.predict(df, model, spans=True).collect()}
    assert [got[i].lang for i in range(7)] == ["en", "fr", "ru", "und", "und", "und", "en"]
    assert got[7].lang in model.langs and got[8].lang == "fr" and 0.5 < got[6].score < 1
    assert [s.lang for s in got[6].spans] == ["en", "fr"]
    cut = got[6].spans[1].start
    assert abs(cut - len((EN * 3).encode())) < 20
    none = langid.train(spark.createDataFrame([], "text string, lang string"))
    assert {r.language.lang for r in langid.predict(df, none).collect()} == {"und"}


def test_scripts_narrow():
    model = langid.Model(["a", "b"], np.zeros((langid.BINS, 2), np.float32), np.zeros((len(langid.NAMES) + 1, 2), bool), 0)
    model.scripts[langid.NAMES.index("latin")] = [True, False]
    model.scripts[langid.NAMES.index("greek")] = [False, True]
    for _, _, data, offsets in kernel.blocks(pa.array(["abc αβγ ..."])):
        s = model.word_scores(langid.Words(data, offsets))
        assert s[0].argmax() == 0 and s[1].argmax() == 1 and not s[2].any()


def test_held_out_accuracy(spark):
    got = queries.op5_langid(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = got.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert got.count() == docs.count() and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)
