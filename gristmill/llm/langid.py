"""Language identification of mixed-language text (operator 5).

Script ranges narrow a word's candidate languages; byte n-grams score the word in each; a
Viterbi pass with a switching penalty labels runs of words; the language with the most letters
is the text's.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as kernel

BINS = 1 << 16
ORDERS = (1, 2, 3, 4)

#: Fixed values: (first code point, script) of the ranges; a range ends where the next begins.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "other"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
    (0x323B0, "other"),
)
_STARTS = [a for a, _ in SCRIPTS]
NAMES = sorted({s for _, s in SCRIPTS})
_INDEX = [NAMES.index(s) for _, s in SCRIPTS]
_LATIN = NAMES.index("latin")
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def _letters(word: bytes) -> tuple[int, int]:
    """(letters, script number of the first one or -1) of a word."""
    n, script = 0, -1
    for c in word.decode("utf-8", "replace"):
        if unicodedata.category(c)[0] == "L":
            n += 1
            if script < 0:
                script = _INDEX[bisect_right(_STARTS, ord(c)) - 1]
    return n, script


class Words:
    """The words of a block of texts, with what depends on a distinct word alone."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = kernel.LOWER[data]
        self.starts, self.ends, self.first = kernel.words_of(self.data, offsets)
        s, e, self.kind = kernel.distinct_spans(self.data, self.starts, self.ends)
        ascii_letters = np.concatenate(([0], np.cumsum(_ASCII_LETTER[self.data])))
        high = np.concatenate(([0], np.cumsum(self.data >= 128)))
        self.letters = (ascii_letters[e] - ascii_letters[s]).astype(np.int64)
        self.script = np.where(self.letters > 0, _LATIN, -1)
        for i in np.flatnonzero(high[e] > high[s]).tolist():
            self.letters[i], self.script[i] = _letters(self.data[s[i] : e[i]].tobytes())
        self.spans = s, e

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(bins, word of each) of all n-grams of the distinct words, word ends included."""
        raw, at = kernel.gathered(self.data, *self.spans)
        own = np.repeat(np.arange(len(at) - 1), np.diff(at))
        left = at[own + 1] - np.arange(len(raw))
        bins, owner = [], []
        wide = np.concatenate((raw, np.zeros(max(ORDERS), np.uint8))).astype(np.uint32)
        value = np.zeros(len(raw), dtype=np.uint32)
        for n in ORDERS:
            value = (value << np.uint32(8)) | wide[n - 1 : n - 1 + len(raw)]
            fits = left >= n
            h = value[fits] * np.uint32(2654435761) + np.uint32(n * 40503)
            h ^= h >> np.uint32(15)
            h *= np.uint32(2246822519)
            bins.append((h >> np.uint32(16)).astype(np.int64))
            owner.append(own[fits])
        return np.concatenate(bins), np.concatenate(owner)


@dataclass
class Model:
    """Log probabilities of n-gram bins by language, and the scripts each language uses."""

    langs: list[str]
    table: np.ndarray  # [BINS, languages]
    scripts: np.ndarray  # [scripts, languages] of bool
    prior: int
    penalty: float = 8.0
    floor: float = -6.0

    def word_scores(self, w: Words) -> np.ndarray:
        """Log posterior of each distinct word by language; words without a letter say nothing."""
        total = np.zeros((len(w.letters), len(self.langs)), dtype=np.float32)
        bins, owner = w.grams()
        for k in range(len(self.langs)):
            total[:, k] = np.bincount(owner, weights=self.table[bins, k], minlength=len(total)) / len(ORDERS)
        allowed = np.where((w.script >= 0)[:, None], self.scripts[w.script], True)
        allowed |= ~allowed.any(axis=1, keepdims=True)
        total[~allowed] = -1e30
        total -= total.max(axis=1, keepdims=True) if total.size else 0
        total -= np.log(np.exp(total).sum(axis=1, keepdims=True))
        total = np.maximum(total, self.floor)
        none = (w.letters == 0) | ~self.scripts[w.script].any(axis=1)
        total[none] = 0
        return total


def constant(scores: np.ndarray, penalty: float) -> int | None:
    """The language of the best path if some test shows that it never switches, else None.

    A stretch of words outside of the best overall language gains at most the sum of each word's
    best other score. Inside the text it costs two switches, at an end of it one, and if it is all
    of the text at least one, since a single other language gains nothing.
    """
    best = int(scores.sum(axis=0, dtype=np.float64).argmax())
    if scores.shape[1] == 1:
        return best
    other = np.delete(scores, best, axis=1).max(axis=1)
    sums = np.concatenate(([0.0], np.cumsum(other - scores[:, best], dtype=np.float64)))
    inside = (sums - np.minimum.accumulate(sums)).max()
    return best if inside <= 2 * penalty and sums.max() <= penalty and sums[-1] - sums.min() <= penalty else None


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best path through ``scores`` [words, languages] when each switch costs ``penalty``."""
    n, width = scores.shape
    if (best := constant(scores, penalty)) is not None:
        return np.full(n, best)
    back = np.empty((n, width), dtype=np.int32)
    value = scores[0].astype(np.float64)
    own = np.arange(width)
    for t in range(1, n):
        top = int(value.argmax())
        switch = value[top] - penalty
        stay = value >= switch
        back[t] = np.where(stay, own, top)
        value = np.where(stay, value, switch) + scores[t]
    path = np.empty(n, dtype=np.int64)
    path[-1] = value.argmax()
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def label(model: Model, data: np.ndarray, offsets: np.ndarray, spans: bool = False) -> Iterator[tuple[str, float, list]]:
    """(language, share of its letters, spans) of each text of a block; spans are byte ranges."""
    w = Words(data, offsets)
    scores = model.word_scores(w) if len(w.letters) else np.zeros((0, len(model.langs)), np.float32)
    for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
        kinds = w.kind[a:b]
        letters = w.letters[kinds]
        if not letters.any():
            yield "und", 0.0, []
            continue
        s = scores[kinds]
        path = viterbi(s, model.penalty) if s.any() else np.full(b - a, model.prior)
        share = np.bincount(path, weights=letters, minlength=len(model.langs))
        top = int(share.argmax())
        found = []
        if spans:
            cut = np.flatnonzero(np.diff(path, prepend=-1))
            for x, y in zip(cut.tolist(), [*cut[1:].tolist(), b - a], strict=True):
                found.append((int(w.starts[a + x] - offsets[i]), int(w.ends[a + y - 1] - offsets[i]), model.langs[path[x]]))
        yield model.langs[top], float(share[top] / share.sum()), found


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, sample_per_lang: int = 1500) -> Model:
    """Fit a model on a bounded sample: about ``sample_per_lang`` texts of each language, chosen
    by a hash of ``key`` (default: the text), so that the choice does not depend on the partitions.

    Rows with a null language or text teach nothing. Without any row the model knows no language
    and prediction answers ``und``. A language uses the scripts of at least a hundredth of its
    letters; words of other scripts say nothing for it.
    """
    key = F.col(text_col) if key is None else key
    src = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in src.groupBy(F.col(lang_col)).count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((BINS, 0), np.float32), np.zeros((len(NAMES) + 1, 0), bool), 0)
    share = F.lit(0.0)
    for name in langs:
        share = F.when(F.col(lang_col) == name, F.lit(sample_per_lang / counts[name])).otherwise(share)
    draw = F.pmod(F.xxhash64(key, F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    sample = src.where(draw < share).select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text")).repartition(8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = {k: np.zeros(BINS, dtype=np.float32) for k in langs}
        seen = {k: np.zeros(len(NAMES), dtype=np.float32) for k in langs}
        for b in batches:
            of = np.array(b.column(0).to_pylist())
            for lo, hi, data, offsets in kernel.blocks(b.column(1)):
                w = Words(data, offsets)
                if not len(w.letters):
                    continue
                bins, owner = w.grams()
                owner_of_word = np.repeat(np.arange(hi - lo), np.diff(w.first))
                for name in set(of[lo:hi].tolist()):
                    here = (of[lo:hi] == name)[owner_of_word]
                    times = np.bincount(w.kind[here], minlength=len(w.letters)) * (w.letters > 0)
                    grams[name] += np.bincount(bins, weights=times[owner], minlength=BINS).astype(np.float32)
                    seen[name] += np.bincount(w.script + 1, weights=times * w.letters, minlength=len(NAMES) + 1)[1:].astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array([grams[k].tobytes() + seen[k].tobytes() for k in langs], pa.binary())], names=["lang", "blob"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype=np.float32).astype(np.float64) for x in pdf["blob"])
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "blob": [total.astype(np.float32).tobytes()]})

    got = {r.lang: np.frombuffer(r.blob, dtype=np.float32) for r in sample.mapInArrow(count, "lang string, blob binary").groupBy("lang").applyInPandas(add, "lang string, blob binary").collect()}
    grams = np.stack([got[k][:BINS] for k in langs], axis=1).astype(np.float64)
    seen = np.stack([got[k][BINS:] for k in langs], axis=1)
    table = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BINS)).astype(np.float32)
    scripts = np.vstack((seen >= 0.01 * np.maximum(seen.sum(axis=0), 1), np.zeros((1, len(langs)), bool)))
    return Model(langs, table, scripts, max(range(len(langs)), key=lambda i: (counts[langs[i]], langs[i])))


def predict(docs: DataFrame, model: Model, text_col: str = "text", spans: bool = False, out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out``: ``lang, score, spans``.

    ``lang`` is a learned language, or ``und`` (score 0) for a null text, a text without a letter,
    or an empty model; ``score`` is the share of the letters in that language's runs; ``spans``
    (only on request, else empty) are byte ranges of the UTF-8 text. Whole texts, row by row; no
    shuffle; other columns pass, a column named ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bins x languages: fixed by the model's shape
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])))])

    @F.arrow_udf("struct<lang string, score double, spans array<struct<start long, stop long, lang string>>>")
    def run(texts: pa.Array) -> pa.Array:
        m, got = shared.value, []
        for lo, hi, data, offsets in kernel.blocks(texts):
            if not m.langs:
                got += [{"lang": "und", "score": 0.0, "spans": []}] * (hi - lo)
                continue
            got += [{"lang": x, "score": s, "spans": [{"start": a, "stop": b, "lang": k} for a, b, k in found]} for x, s, found in label(m, data, offsets, spans)]
        return pa.array(got, kind)

    return docs.withColumn(out, run(F.col(text_col).cast("string")))
