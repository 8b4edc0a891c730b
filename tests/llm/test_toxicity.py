import math
import random
import re

import numpy as np
import pyarrow as pa

from gristmill.llm import queries, toxicity
from gristmill.llm import text as kernel


def test_swaps():
    assert toxicity.swaps("no term here") == []
    a, b = toxicity.swaps("A Muslim and a woman")
    assert a == "A christian and a man" and b == "A jewish and a girl"


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    n, width = 30, 8
    hit = rng.random((n, width)) < 0.4
    rows, cols = np.nonzero(hit)
    y, m = rng.integers(0, 2, n).astype(float), rng.random(n)
    pairs = np.array([(0, 5), (1, 6), (2, 6)])
    w, b = rng.normal(size=width), 0.3

    def plain(v):  # by the dense matrix, one row at a time
        z = [v[-1] + sum(v[j] for j in range(width) if hit[i, j]) for i in range(n)]
        log = sum(m[i] * -(y[i] * math.log(1 / (1 + math.exp(-z[i]))) + (1 - y[i]) * math.log(1 - 1 / (1 + math.exp(-z[i])))) for i in range(n))
        return log + 0.01 / 2 * sum(x * x for x in v[:-1]) + 2.0 * sum((z[i] - z[j]) ** 2 for i, j in pairs) / len(pairs)

    value, grad = toxicity.loss(w, b, n, rows, cols, y, m, pairs, 2.0, 0.01)
    at = np.append(w, b)
    assert abs(value - plain(at)) < 1e-9
    for k in range(width + 1):
        step = np.eye(width + 1)[k] * 1e-5
        assert abs(grad[k] - (plain(at + step) - plain(at - step)) / 2e-5) < 1e-6


def test_mentions_are_learned(spark):
    """A word of mostly clean texts that leans to toxic ones is swapped without being listed."""
    spelt = lambda t: re.sub(r"w(\d+)", lambda m: f"w{chr(97 + int(m[1]) // 10)}{chr(97 + int(m[1]) % 10)}", t.replace("muslim", "zorgonian"))
    rows = [(i, spelt(t), y) for i, t, y in data(clean=0.14)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    named = [t for _, t, _ in rows if "zorgonian" in t][:80]
    gaps = {}
    for weight in (0.0, 5.0):
        model = toxicity.train(docs, labels, counterfactual=weight)
        assert any(line[0] == "zorgonian" for line in model.terms) and model.pairs > 20
        both = [x for t in named for x in (t, toxicity.swaps(t, model.terms, 1)[0])]
        (z,) = [model.logits(data, offsets) for _, _, data, offsets in kernel.blocks(pa.array(both))]
        gaps[weight] = np.abs(z[::2] - z[1::2]).mean()
        assert all(r.toxicity > 0.5 for r in toxicity.score(docs.where("text like '% vile %'"), model).collect())
    assert gaps[5.0] < 0.3 * gaps[0.0]


def data(clean=0.02):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(600 if clean < 0.1 else 1200):
        text = [rng.choice(words) for _ in range(12)]
        toxic = i % 3 == 0
        if toxic:
            text[3] = rng.choice(["vile", "moronic"])
        if (toxic and rng.random() < (0.9 if clean < 0.1 else 0.1)) or rng.random() < clean:  # the group is mostly named in toxic texts
            text[7] = "muslim"
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_counterfactual_pairs_agree(spark):
    rows = data()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 1) for r in rows], "doc_id long, toxic int, score int")
    probe = spark.createDataFrame([(1, "w1 w2 w3 muslim w4"), (2, "w1 w2 w3 christian w4"), (3, "w1 vile w3 w4"), (4, None), (5, "")], "doc_id long, text string")
    got = {}
    for weight in (0.0, 5.0):
        model = toxicity.train(docs, labels, counterfactual=weight)
        got[weight] = {r.doc_id: r.toxicity for r in toxicity.score(probe, model).collect()}
    free, held = got[0.0], got[5.0]
    assert held[3] > 0.5 > held[1] and held[4] == held[5] < 0.5
    assert abs(held[1] - held[2]) < 0.1 * abs(free[1] - free[2])
    none = toxicity.train(docs, labels.limit(0))
    assert all(r.toxicity < 0.5 for r in toxicity.score(probe, none).collect())
    assert toxicity.score(probe.limit(0), none).count() == 0


def test_held_out(spark):
    got = queries.op10_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    assert got.count() == 1000
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
