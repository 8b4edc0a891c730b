"""Toxicity classifier with counterfactual regularisation (operator 10).

Logistic regression over the words and word beginnings of a text. In training, labelled texts
that mention an identity group are scored again with the mention swapped, and differences between
the scores are penalised, so that a neutral mention moves no score. Which words are treated as
mentions is learned: besides listed terms, those that lean to toxic texts although most of the
texts that hold them are clean, each with words of like frequency that do not lean as its swaps.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import text as kernel

BITS = 20
BINS = 1 << BITS
#: A word's features: its first bytes, these many, and the whole word (0).
HEADS = (4, 5, 6, 7, 0)

#: Terms for identity groups to begin with; any term of a line may stand for any other.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer"),
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("immigrant", "refugee", "foreigner", "citizen", "native"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("disabled", "blind", "deaf", "autistic"),
)
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


Lines = tuple[tuple[str, ...], ...]


def swaps(text: str, terms: Lines = IDENTITY_TERMS, most: int = 2) -> list[str]:
    """``text`` with its terms moved on by one place in their lines, then by two, ..."""
    place: dict[str, tuple[tuple[str, ...], int]] = {}
    for line in terms:
        for i, t in enumerate(line):
            place.setdefault(t, (line, i))
    words = re.split(r"(\w+)", text)
    at = [i for i in range(1, len(words), 2) if words[i].lower() in place]
    out = []
    for step in range(1, most + 1 if at else 1):
        moved = words.copy()
        for i in at:
            line, k = place[words[i].lower()]
            moved[i] = line[(k + step) % len(line)]
        out.append("".join(moved))
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins [distinct words, heads], distinct word of each word, first word of each text)."""
    data = kernel.LOWER[data]
    starts, ends, first = kernel.words_of(data, offsets)
    for _ in range(3):  # quotes, brackets and full stops around a word
        starts = starts + (_PUNCTUATION[data[starts]] & (ends - starts > 1))
        ends = ends - (_PUNCTUATION[data[ends - 1]] & (ends - starts > 1))
    s, e, kind = kernel.distinct_spans(data, starts, ends)
    bins = np.empty((len(s), len(HEADS)), dtype=np.int64)
    for k, n in enumerate(HEADS):
        h = kernel.span_hashes(data, s, np.minimum(s + n, e) if n else e)
        bins[:, k] = kernel.mix(h + kernel.U(n + 1)) >> kernel.U(64 - BITS)
    return bins, kind, first


@dataclass
class Model:
    """``slot[bin]`` is the bin's place among the weights, or -1; the rest tells how it was trained."""

    slot: np.ndarray
    weights: np.ndarray
    bias: float
    terms: Lines = ()
    chosen: tuple[float, float] = (0.0, 0.0)
    pairs: int = 0

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, place = present(self.slot, data, offsets, len(self.weights))
        return self.bias + np.bincount(doc, weights=self.weights[place], minlength=len(offsets) - 1)


def present(slot: np.ndarray, data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every chosen feature that a text holds, each once."""
    bins, kind, first = features(data, offsets)
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hit = slot[bins]
    some = (hit >= 0).any(axis=1)
    at = np.flatnonzero(some[kind])
    doc = np.searchsorted(first, at, "right") - 1
    slots = hit[kind[at]]
    pairs = (doc[:, None] * (width + 1) + slots)[slots >= 0]
    pairs = np.unique(pairs)
    return pairs // (width + 1), pairs % (width + 1)


def loss(w: np.ndarray, b: float, n: int, rows: np.ndarray, cols: np.ndarray, y: np.ndarray, m: np.ndarray, pairs: np.ndarray, counterfactual: float, ridge: float) -> tuple[float, np.ndarray]:
    """Log loss of rows weighted by ``m`` + ridge / 2 * |w|**2 + counterfactual * mean squared logit
    difference of ``pairs`` (row, swapped row); and its gradient by weights and bias."""
    z = b + np.bincount(rows, weights=w[cols], minlength=n)
    g = m * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
    value = float((m * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * (w @ w))
    if len(pairs):
        gap = z[pairs[:, 0]] - z[pairs[:, 1]]
        value += counterfactual * float((gap * gap).mean())
        d = 2 * counterfactual * gap / len(pairs)
        g = g + np.bincount(pairs[:, 0], weights=d, minlength=n) - np.bincount(pairs[:, 1], weights=d, minlength=n)
    return value, np.append(np.bincount(cols, weights=g[rows], minlength=len(w)) + ridge * w, g.sum())


def fit(n: int, rows: np.ndarray, cols: np.ndarray, labels: np.ndarray, weight: np.ndarray, pairs: np.ndarray, width: int, counterfactual: float, ridge: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias that make ``loss`` small; ``labels`` < 0 marks rows that are only swaps."""
    y = np.where(labels >= 0, labels, 0).astype(np.float64)
    m = np.where(labels >= 0, weight, 0.0)
    m = m / max(m.sum(), 1e-9)
    w, b = np.zeros(width), 0.0
    moment, second = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        _, grad = loss(w, b, n, rows, cols, y, m, pairs, counterfactual, ridge)
        moment = 0.9 * moment + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        step = 0.1 * (moment / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bin, clean texts, toxic texts) of every bin that a task's texts hold."""
    total = np.zeros((2, BINS), dtype=np.int64)
    for b in batches:
        y = np.array(b.column(1).to_pylist(), dtype=np.int64)
        for lo, hi, data, offsets in kernel.blocks(b.column(0)):
            bins, kind, first = features(data, offsets)
            if not len(kind):
                continue
            doc = np.repeat(np.arange(hi - lo), np.diff(first))
            for c in (0, 1):
                mine = y[lo:hi][doc] == c
                for head in range(len(HEADS)):  # a head at a time bounds the memory
                    seen = np.unique(doc[mine] * BINS + bins[kind[mine], head])
                    total[c] += np.bincount(seen % BINS, minlength=BINS)
    at = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], names=["key", "zero", "one"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, clean texts, toxic texts) of every word of letters."""
    total: dict[str, list[int]] = {}
    for b in batches:
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for w in set(re.findall(r"[^\W\d_]{3,}", text.lower())):
                total.setdefault(w, [0, 0])[y] += 1
    cols = [pa.array(list(total), pa.string()), *(pa.array([c[y] for c in total.values()], pa.int64()) for y in (0, 1))]
    yield pa.RecordBatch.from_arrays(cols, names=["key", "zero", "one"])


def _leaning(counted: DataFrame, n: list[int], least: int) -> DataFrame:
    """Adds ``z``, the two-sample statistic of how much more toxic texts hold a key."""
    sums = counted.groupBy("key").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).where(F.col("zero") + F.col("one") >= least)
    pooled = (F.col("zero") + F.col("one")) / F.lit(float(sum(n)))
    error = F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-9)) * (1 / n[0] + 1 / n[1]))
    return sums.withColumn("z", F.round((F.col("one") / n[1] - F.col("zero") / n[0]) / error, 6))


def mentions(words: DataFrame, n: list[int], most: int = 200, lean: float = 2.0, neutral: float = 1.0, least: int = 10) -> Lines:
    """Lines of a word that leans to toxic texts while most of its texts are clean, and the two
    words next to it in frequency that lean to neither; ``most`` lines at most."""
    z = _leaning(words, n, least)
    terms = z.where((F.col("z") >= lean) & (F.col("zero") >= F.col("one"))).orderBy(F.desc("z"), "key").limit(most).collect()
    calm = z.where(F.abs("z") <= neutral).orderBy(F.desc(F.col("zero") + F.col("one")), "key").limit(20 * most).collect()
    size = lambda r: r.zero + r.one
    return tuple((r.key, *(c.key for c in sorted(calm, key=lambda c: (abs(size(c) - size(r)), c.key))[:2])) for r in terms)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_per_class: int = 2500,
    width: int = 4096,
    counterfactual: float = 1.0,
    grid: tuple[tuple[float, float], ...] = ((6.0, 5e-4), (6.0, 5e-3), (4.5, 5e-4), (4.5, 5e-3), (3.0, 5e-4), (3.0, 5e-3)),
    steps: int = 300,
    terms: Lines = IDENTITY_TERMS,
) -> Model:
    """Fit on a bounded sample: about ``sample_per_class`` labelled texts of each class, chosen by
    a hash of the id. Rows with a null id, text or label teach nothing; repeated label rows of one
    id with different labels count for each. Both classes weigh the same.

    Features are bins that lean to toxic texts (a text is not cleared by its other words), and the
    words of ``terms`` and of the mentions found. How far a bin must lean, and the ridge, are the
    pair of ``grid`` with the least loss on a fifth of the sample, after fitting on the others; the
    weights are then fitted on all of it. Without any labelled row every score is 0. What reaches
    the driver is bounded by the sample.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if not counts:
        return Model(np.full(BINS, -1, np.int32), np.zeros(0), -20.0)
    draw = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    share: Column = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(sample_per_class / n)).otherwise(share)
    chosen = known.where(draw < share)  # about two times sample_per_class rows: small enough to send
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    apart = (F.pmod(F.xxhash64("text", F.lit("tuning")), F.lit(5)) == 0).alias("apart")
    sample = written(texts.join(F.broadcast(chosen), "id").select("text", "y").distinct().select("text", "y", apart).repartition(8), "sample")

    learning = sample.where("not apart")
    drawn = {r.y: r["count"] for r in learning.groupBy("y").count().collect()}
    n = [max(1, drawn.get(c, 0)) for c in (0, 1)]
    found = mentions(learning.select("text", "y").mapInArrow(_words, "key string, zero long, one long"), n)
    lines = (*terms, *found)
    bins = _leaning(learning.select("text", "y").mapInArrow(_counts, "key long, zero long, one long"), n, 3)
    best = bins.where(F.col("z") >= min(z for z, _ in grid)).orderBy(F.desc("z"), "key").limit(width).collect()
    lean = {int(r.key): float(r.z) for r in best}
    for _, _, data, offsets in kernel.blocks(pa.array([w for line in found for w in line], pa.string())):
        for b in np.unique(features(data, offsets)[0][:, HEADS.index(0)]).tolist():
            lean[b] = float("inf")  # mentions take part however little they lean
    place = np.array(sorted(lean), dtype=np.int64)
    slot = np.full(BINS, -1, dtype=np.int32)
    slot[place] = np.arange(len(place))
    shared, size = docs.sparkSession.sparkContext.broadcast(slot), len(place)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both, origin = [], []
            for i, t in enumerate(b.column(0).to_pylist()):
                versions = [t, *swaps(t, lines)]
                both += versions
                origin += [i] * len(versions)
            held: list[list[int]] = [[] for _ in both]
            for lo, _, data, offsets in kernel.blocks(pa.array(both, pa.string())):
                for d, f in zip(*(x.tolist() for x in present(shared.value, data, offsets, size)), strict=True):
                    held[lo + d].append(f)
            out: list[list[list[int]]] = [[] for _ in range(b.num_rows)]
            for i, f in zip(origin, held, strict=True):
                out[i].append(f)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out, pa.list_(pa.list_(pa.int32())))], names=["y", "apart", "versions"])

    rows, cols, ys, pairs, aside = [], [], [], [], []
    for r in sample.select("text", "y", "apart").mapInArrow(rows_of, "y int, apart boolean, versions array<array<int>>").collect():
        own = len(ys)
        for k, fs in enumerate(r.versions):
            if k:
                pairs.append((own, len(ys)))
            rows += [len(ys)] * len(fs)
            cols += fs
            ys.append(-1 if k else r.y)
            aside.append(r.apart)
    rows, cols, y, aside = np.array(rows, np.int64), np.array(cols, np.int64), np.array(ys), np.array(aside, bool)
    pairs = np.array(pairs, np.int64).reshape(-1, 2)
    leans = np.array([lean[b] for b in place.tolist()])

    def fitted(z: float, ridge: float, part: np.ndarray) -> tuple[np.ndarray, float]:
        weight = (0.5 / np.array([max(1, int((y[part] == c).sum())) for c in (0, 1)]))[np.maximum(y, 0)]
        use = (leans[cols] >= z) & part[rows] if len(cols) else np.zeros(0, bool)
        mine = pairs[part[pairs[:, 0]]]
        return fit(len(y), rows[use], cols[use], np.where(part, y, -1), weight, mine, size, counterfactual, ridge, steps)

    def missed(z: float, ridge: float) -> float:
        w, b = fitted(z, ridge, ~aside)
        logit = b + np.bincount(rows, weights=w[cols], minlength=len(y))
        each = [np.logaddexp(0, logit[at] * (1 - 2 * c)).mean() for c in (0, 1) if (at := aside & (y == c)).any()]
        return float(sum(each))

    z, ridge = min(grid, key=lambda g: round(missed(*g), 9)) if aside.any() and not aside.all() else grid[0]
    weights, bias = fitted(z, ridge, np.ones(len(y), bool))
    return Model(slot, weights, bias, lines, (z, ridge), len(pairs))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a double column ``toxicity`` between 0 and 1.

    Whole texts, row by row, no shuffle; a null text scores as an empty one, that is by the bias
    alone; other columns pass, a column ``toxicity`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of bins and weights

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, _, data, offsets in kernel.blocks(texts):
            out.append(1 / (1 + np.exp(-np.clip(shared.value.logits(data, offsets), -30, 30))))
        return pa.array(np.concatenate(out), pa.float64())

    return docs.withColumn("toxicity", run(F.col(text_col).cast("string")))
