"""Lempel-Ziv phrase fingerprints (operator 6).

A text is parsed into dictionary phrases (LZ78 over its UTF-8 bytes); the phrase set is hashed
and its smallest hashes are the fingerprint. Two texts that compress well together share phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as kernel

#: Hashes kept, and hex digits of each.
SIZE, DIGITS = 64, 8


class Parse:
    """An LZ78 parse that can be continued, and branched by ``copy``."""

    def __init__(self) -> None:
        self.trie: dict[int, int] = {}
        self.node = 0
        self.ends: list[int] = []

    def copy(self) -> Parse:
        out = Parse()
        out.trie, out.node, out.ends = self.trie.copy(), self.node, self.ends.copy()
        return out

    def feed(self, data: bytes, at: int) -> None:
        """Parse ``data``, which begins at position ``at`` of the whole text."""
        trie, node, n = self.trie, self.node, len(self.trie)
        get, put = trie.get, self.ends.append
        for at, byte in enumerate(data, at + 1):  # noqa: B020, PLR1704
            key = node | byte
            node = get(key, 0)
            if not node:
                n += 1
                trie[key] = n << 8
                put(at)
        self.node = node


def _hashes(data: np.ndarray, ends: list[int], start: int) -> np.ndarray:
    e = np.asarray(ends, dtype=np.int64)
    s = np.concatenate(([start], e[:-1])) if len(e) else e
    return kernel.span_hashes(data, s, e) >> kernel.U(64 - 4 * DIGITS)


def smallest(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    return np.unique(hashes)[:size]


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard similarity of two phrase sets from their smallest hashes; two empty: 1."""
    union = np.union1d(a, b)[:size]
    if not len(union):
        return 1.0
    return float((np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)).sum() / len(union))


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u4").astype(np.uint64)


def sketch(data: bytes, size: int = SIZE) -> np.ndarray:
    """The smallest phrase hashes of one text."""
    p = Parse()
    p.feed(data, 0)
    ends = p.ends if not data or p.ends and p.ends[-1] == len(data) else [*p.ends, len(data)]
    return smallest(_hashes(np.frombuffer(data, dtype=np.uint8), ends, 0), size)


def sketch_pair(data: bytes, keep: int, tail: bytes, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of ``data`` and of ``data[:keep] + tail``, parsing the common part once."""
    p = Parse()
    p.feed(data[:keep], 0)
    shared = len(p.ends)
    out, common = [], None
    for last, parse in ((tail, p.copy()), (data[keep:], p)):
        parse.feed(last, keep)
        total = keep + len(last)
        ends = parse.ends if not total or parse.ends and parse.ends[-1] == total else [*parse.ends, total]
        whole = np.frombuffer(data[:keep] + last, dtype=np.uint8)
        if common is None:
            common = _hashes(whole, ends[:shared], 0)
        rest = _hashes(whole, ends[shared:], ends[shared - 1] if shared else 0)
        out.append(smallest(np.concatenate((common, rest)), size))
    return out[1], out[0]


def fingerprints(docs: DataFrame, text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with a string column ``lz_fingerprint`` (hex, ``size`` hashes of 8 digits at most).

    Equal texts have equal fingerprints; null reads as empty and has the empty fingerprint.
    No shuffle. A column of that name is replaced.
    """

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: as_text(sketch((t or "").encode(), size)))

    return docs.withColumn("lz_fingerprint", made(F.col(text_col).cast("string")))


def edited(text: str, following: str) -> tuple[int, str]:
    """(bytes kept, replacement): the last third of ``text`` gives way to as many leading code
    points of ``following``, or all of it if it is shorter."""
    cut = len(text) - len(text) // 3
    return len(text[:cut].encode()), following[: len(text) // 3]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(size: int):
    names = [x.split()[0] for x in _OUT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for its next
        rows: list[tuple] = []

        def close(nxt: str, nxt_sketch: np.ndarray | None) -> tuple[np.ndarray, tuple]:
            _, doc, text = held
            data = text.encode()
            keep, repl = edited(text, nxt)
            own, made = sketch_pair(data, keep, repl.encode(), size)
            return own, (doc, len(text), hashlib.sha256(data[:keep] + repl.encode()).hexdigest(), as_text(own), as_text(made), likeness(own, made, size))

        before: tuple | None = None  # (sketch, row) that lacks only its likeness to the next
        for b in batches:
            for bucket, extra, doc, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                text = text or ""
                if held is not None and held[0] == bucket:
                    own, row = close(text, None)
                    if before is not None:
                        rows.append((*before[1], likeness(before[0], own, size)))
                    before = (own, row)
                    if extra:
                        rows.append((*row, likeness(own, sketch(text.encode(), size), size)))
                        before = held = None
                        continue
                held = None if extra else (bucket, doc, text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                rows = []

    return run


def _ranges(cuts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Upper bounds (a, h) of the ranges from sorted cuts of ``a``, made from quantiles.

    A value that several quantiles meet holds that many ranges' rows, which are cut by their hash.
    """
    bounds = []
    for a in sorted(set(cuts)):
        many = cuts.count(a)
        bounds += [(a, -(1 << 63) + (j << 64) // many) for j in range(1, many)] + [(a, (1 << 63) - 1)]
    pairs = np.array(bounds, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _range_of(a: np.ndarray, h: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many bounds lie before (a, h)."""
    lo, hi = np.searchsorted(bounds[0], a, "left"), np.searchsorted(bounds[0], a, "right")
    out = lo.copy()
    for at in np.unique(lo[hi - lo > 1]).tolist():
        here = (lo == at) & (hi - lo > 1)
        out[here] += np.searchsorted(bounds[1][at : int(hi[here][0])], h[here], "left")
    return out.astype(np.int32)


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, range_bytes: int = 64 << 20) -> DataFrame:
    """Fingerprint every text and its edited text, in falling order of id.

    A row's next is the one with the next smaller id, the last one's next is the first; rows with
    one id follow each other by a hash of the text, null ids come last, null texts are empty; a
    table of one row is its own next. Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``. The order is made by ranges of about
    ``range_bytes`` of text: each is sorted in one task, and only its first row is copied, to the
    range before it. Ranges are cut at quantiles of all ids; an id with more rows than a range is
    cut by the hash too, so only rows that repeat an id and its text must meet.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    # Complements run the other way, and without overflow: falling ids, nulls last.
    a = F.coalesce(F.bitwise_not(F.col(id_col).cast("long")), F.lit((1 << 63) - 1))
    src = docs.select(a.alias("a"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_bytes))
    cuts = src.agg(F.percentile_approx("a", [i / parts for i in range(1, parts)], 10 * max(1000, parts)).alias("q")).first().q or []
    bounds = _ranges(cuts)

    @F.pandas_udf("int")
    def bucket(a: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(_range_of(a.to_numpy(np.int64), h.to_numpy(np.int64), bounds))

    # One row a range: as many as there are tasks.
    firsts = {r.b: (r.f.a, r.f.h) for r in src.select("a", "h", bucket("a", "h").alias("b")).groupBy("b").agg(F.min(F.struct("a", "h")).alias("f")).collect()}
    order = sorted(firsts)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the first range's first row goes to the last

    @F.pandas_udf("array<struct<bucket int, extra boolean>>")
    def places(a: pd.Series, h: pd.Series) -> pd.Series:
        own = _range_of(a.to_numpy(np.int64), h.to_numpy(np.int64), bounds).tolist()
        return pd.Series([[{"bucket": b, "extra": False}, *([{"bucket": before[b], "extra": True}] if firsts[b] == (x, y) else [])] for b, x, y in zip(own, a.tolist(), h.tolist(), strict=True)])

    rows = src.select(F.inline(places("a", "h")), "a", "h", "doc_id", "text")
    rows = rows.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "extra", "a", "h", "text")
    return rows.select("bucket", "extra", "doc_id", "text").mapInArrow(_pairs(size), _OUT)
