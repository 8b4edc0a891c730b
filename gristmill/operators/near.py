"""Pairs of 64-bit signatures within a Hamming radius, compared in arrays (survey 2.D).

Two signatures within the radius share a band (``hashing.bands``). Rows meet by band in Spark's
shuffle; a task passes its sorted rows and compares those of one band as numpy arrays, so a pair
that is compared and not near is never a row. Bands of many rows are cut into pairs of blocks,
which are dealt to all tasks. Features (whole numbers) may narrow the pairs: a band's rows then lie in
order of the first one, and only those that it leaves in reach are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import band_masks
from ..session import written

#: Sides of a row: it may stand first in a pair, second, or both.
FIRST, SECOND = 1, 2
#: Rows passed at a time, rows of a band compared shift by shift, rows of a block, rows of a strip.
CHUNK, FEW, BLOCK, STRIP = 1 << 17, 32, 4096, 256
_ROW = np.dtype([("id", "<i8"), ("sig", "<u8"), ("band", "<i4"), ("side", "<i4")])
_FOUND = "a long, b long, distance int, x binary, y binary"


class _Pairs:
    """Compares rows by position and keeps the pairs that are near, in order, and first met here.

    With features (their number), rows come in order of the first, and a pair's differ by ``total`` at most.
    """

    def __init__(self, masks: list[int], radius: int, rising: bool, features: int = 0, total: int = 0) -> None:
        self.masks, self.radius, self.rising = np.array(masks, dtype=np.uint64), radius, rising
        self.features, self.total = features, total
        self.row = np.dtype([*_ROW.descr, ("f", "<i8", (features,))]) if features else _ROW
        self.out: list[tuple] = []

    def end(self, rows: np.ndarray, others: np.ndarray) -> int:
        """Where those of ``others`` begin that lie behind the reach of all rows."""
        return int(np.searchsorted(others["f"][:, 0], rows["f"][-1, 0] + self.total, "right")) if self.features else len(others)

    def alike(self, p: np.ndarray, q: np.ndarray) -> np.ndarray | bool:
        return np.abs(p["f"] - q["f"]).sum(axis=1) <= self.total if self.features else True

    def keep(self, p: np.ndarray, q: np.ndarray, apart: np.ndarray, far: np.ndarray) -> None:
        """Near rows p and q (equally long); a pair counts at the first band that it shares."""
        band = p["band"]
        good = (band == q["band"]) & ((apart & self.masks[band]) == 0) & self.alike(p, q)
        for k, mask in enumerate(self.masks[:-1]):
            good &= (band <= k) | ((apart & mask) != 0)
        for a, b in ((p, q), (q, p)):
            fit = good & ((a["side"] & FIRST) > 0) & ((b["side"] & SECOND) > 0)
            if self.rising:
                fit &= a["id"] < b["id"]
            if fit.any():
                self.out.append((a["id"][fit], b["id"][fit], far[fit]))

    def compare(self, p: np.ndarray, q: np.ndarray) -> None:
        apart = p["sig"] ^ q["sig"]
        far = np.bitwise_count(apart)
        near = far <= self.radius
        if near.any():
            self.keep(p[near], q[near], apart[near], far[near])

    def blocks(self, x: np.ndarray, y: np.ndarray | None = None) -> None:
        """All rows of x with all of y; without y each pair within x once."""
        others = x if y is None else y
        other = np.ascontiguousarray(others["sig"])
        for at in range(0, len(x), STRIP):
            rows, skip = x[at : at + STRIP], at if y is None else 0
            apart = np.ascontiguousarray(rows["sig"])[:, None] ^ other[None, skip : self.end(rows, others)]
            far = np.bitwise_count(apart)
            i, j = np.nonzero(far <= self.radius)
            if y is None:
                i, j = (k[i < j] for k in (i, j))
            if len(i):
                self.keep(rows[i], others[skip + j], apart[i, j], far[i, j])

    def taken(self) -> pa.RecordBatch | None:
        if not self.out:
            return None
        a, b, far = (np.concatenate(c) for c in zip(*self.out, strict=True))
        self.out = []
        none = pa.nulls(len(a), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(far.astype(np.int32)), none, none], names=["a", "b", "distance", "x", "y"])


def _units(rows: np.ndarray, pairs: _Pairs) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks of a large band, to be compared elsewhere."""
    cut = [rows[at : at + BLOCK].tobytes() for at in range(0, len(rows), BLOCK)]
    for i, x in enumerate(cut):
        ys = [None, *cut[i + 1 : pairs.end(rows[i * BLOCK : (i + 1) * BLOCK], rows[::BLOCK])]]
        none = pa.nulls(len(ys), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none.cast(pa.int32()), pa.array([x] * len(ys), pa.binary()), pa.array(ys, pa.binary())], names=["a", "b", "distance", "x", "y"])


def _passed(batches: Iterator[pa.RecordBatch], pairs: _Pairs) -> Iterator[pa.RecordBatch]:
    """Compares rows sorted by ``k`` (and the first feature), band by band."""

    def groups(key: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        left = np.repeat(start + size, size) - np.arange(len(key)) - 1  # rows of the same band that follow
        at, shift = np.flatnonzero((left > 0) & (np.repeat(size, size) <= FEW)), 1
        while len(at):
            pairs.compare(rows[at], rows[at + shift])
            shift += 1
            at = at[left[at] >= shift]
        for s, n in zip(start[size > FEW], size[size > FEW], strict=True):
            if n <= BLOCK:
                pairs.blocks(rows[s : s + n])
            else:
                yield from _units(rows[s : s + n], pairs)
        if (found := pairs.taken()) is not None:
            yield found

    held: list[tuple[np.ndarray, np.ndarray]] = []
    count, last = 0, None

    def joined() -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate(c) for c in zip(*held, strict=True))

    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy(zero_copy_only=False)
        rows = np.empty(len(key), dtype=pairs.row)
        for i, name in enumerate(("id", "sig", "band", "side"), 1):
            column = b.column(i).to_numpy(zero_copy_only=False)
            rows[name] = column.view(np.uint64) if name == "sig" else column
        for i in range(pairs.features):
            rows["f"][:, i] = b.column(5 + i).to_numpy(zero_copy_only=False)
        held.append((key, rows))
        count += len(key)
        if count >= CHUNK and not (last is not None and key[-1] == last):
            key, rows = joined()
            whole = np.searchsorted(key, key[-1])  # the last band may go on
            if whole:
                yield from groups(key[:whole], rows[:whole])
            held, count = [(key[whole:], rows[whole:])], len(key) - whole
        last = held[-1][0][-1]
    if held:
        yield from groups(*joined())


def near_signatures(rows: DataFrame, radius: int, rising: bool = True, features: list[str] | None = None, total: int = 0) -> DataFrame:
    """``a, b, distance`` of rows (id long, sig long, side int) within the radius, exactly.

    a stands first and b second by their sides; with ``rising`` only where a < b. A row does not
    meet itself. A pair is made at the first band that it shares, so none is made twice, unless
    ids repeat. Give it classes of equal signatures, not rows. With ``features`` (columns of whole
    numbers, the most telling first) only pairs whose absolute differences add up to ``total`` at most;
    give it classes of equal signatures and features then (D20).
    """
    masks, features = band_masks(radius), features or []
    numbers = [F.col(c).cast("long").alias(f"f{i}") for i, c in enumerate(features)]

    def banded(sig: Column) -> Column:
        return F.array(*[F.struct(F.xxhash64(F.lit(i), sig.bitwiseAND(F.lit(m - (m >> 63 << 64)))).alias("k"), F.lit(i).alias("band")) for i, m in enumerate(masks)])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _passed(batches, _Pairs(masks, radius, rising, len(features), total))

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs(masks, radius, rising, len(features), total)
        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pairs.blocks(np.frombuffer(x, dtype=pairs.row), None if y is None else np.frombuffer(y, dtype=pairs.row))
                if (found := pairs.taken()) is not None:
                    yield found

    dealt = rows.dropna(subset=["id", "sig", *features]).select(F.col("id").cast("long").alias("id"), "sig", "side", *numbers, F.inline(banded(F.col("sig"))))
    order = [f"f{i}" for i in range(len(features))]
    dealt = dealt.select("k", "id", "sig", "band", "side", *order).repartition("k").sortWithinPartitions("k", *order[:1])
    first = written(dealt.mapInArrow(within, _FOUND), "near")
    found, units = first.where("x is null").select("a", "b", "distance"), first.where("x is not null").select("x", "y")
    if units.isEmpty():
        return found
    dealt = units.repartition(F.xxhash64("x", "y"))
    return found.unionAll(written(dealt.mapInArrow(between, _FOUND).select("a", "b", "distance"), "near_blocks"))
