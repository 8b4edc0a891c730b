"""Vectorised word kernels over Arrow batches.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; lower-casing touches A-Z only.
Both rules act on single UTF-8 bytes, so a whole batch is handled as one byte array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_MASK = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes hashed at a time; bounds the working memory to about 40 times this.
SEGMENT = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(_R))
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SEGMENT + (SEGMENT >> 2), 1 << max(0, (n - 1)).bit_length())
    if size not in _POW:
        up, down = np.full(size + 1, _R, dtype=U), np.full(size + 1, _RINV, dtype=U)
        up[0] = down[0] = 1
        got = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > 4 * SEGMENT:
            return got
        _POW[size] = got
    return _POW[size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``data[starts[i]:ends[i]]``; depends on the bytes only."""
    if not len(starts):
        return np.zeros(0, dtype=U)
    out = np.empty(len(starts), dtype=U)
    at = 0
    while at < len(starts):  # spans are in order; take as many as fit a segment
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        top = int(ends[to - 1])
        up, down = _powers(top - base)
        total = np.zeros(top - base + 1, dtype=U)
        np.cumsum(_BYTE[data[base:top]] * up[: top - base], out=total[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (total[e] - total[s]) * down[s]
        at = to
    return mix(out ^ ((ends - starts).astype(U) * U(0xD6E8FEB86659FD93)))


def blocks(column: pa.Array, size: int = 8 * SEGMENT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into blocks of about ``size`` bytes of whole texts.

    Yields (first row, row after the last, bytes with one space after each text, offsets of the
    texts in those bytes, one more than texts). Nulls read as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8) if n and column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        part = offs[at : to + 1] - offs[at]
        shifted = part + np.arange(to - at + 1)
        data = np.full(int(shifted[-1]), 0x20, dtype=np.uint8)
        keep = np.ones(len(data), dtype=bool)
        keep[shifted[1:] - 1] = False
        data[keep] = raw[offs[at] : offs[to]]
        yield at, to, data, shifted
        at = to


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, which ends with a space or is empty."""
    word = np.concatenate(([False], ~SPACE[data], [False]))
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[::2], edge[1::2]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): text i has the words first[i]:first[i+1]."""
    starts, ends = word_spans(data)
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """Per text its sorted distinct n-word shingle hashes.

    ``words``: word hashes of all texts in order. A text with fewer than n words has its whole
    sequence as the one shingle, a text without words has none.
    """
    out = []
    if len(words) >= n:
        rolled = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            rolled = mix(rolled * U(0xA0761D6478BD642F) + words[k : len(words) - n + 1 + k])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            h = U((b - a) * 0xE7037ED1A0B428DB & _MASK)
            for w in words[a:b]:
                h = mix(np.array([h * U(0xA0761D6478BD642F) + w], dtype=U))[0]
            out.append(np.array([h], dtype=U))
        else:
            out.append(np.zeros(0, dtype=U))
    return out


np.seterr(over="ignore")


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, inverse) of the distinct spans, in order of place; spans[inverse] restores all."""
    _, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    order = np.argsort(first, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return starts[first[order]], ends[first[order]], rank[inverse]


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans' bytes one after the other, a zero before and after each; and where each begins."""
    size = ends - starts + 2
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(int(at[-1]), dtype=np.uint8)
    inner = np.arange(int((ends - starts).sum()))
    own = np.repeat(np.arange(len(starts)), ends - starts)
    shift = np.concatenate(([0], np.cumsum(ends - starts)))[:-1]
    out[inner + 2 * own + 1] = data[inner - shift[own] + starts[own]]
    return out, at
