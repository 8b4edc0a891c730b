"""Packing of tokenised documents into fixed windows (operator 1).

Method: documents longer than a window are cut into full windows; the rests are packed by
best-fit decreasing, where a segment tree over the remaining capacities finds the tightest open
window. What then stays open is closed: the emptiest windows are taken apart, and their documents
fill the others, whole where one fits and cut to the free length where none does. So of documents
that fit no better a window each keeps one whole, and only the rest is cut.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, bin long"
_ENCODERS: dict[str, object] = {}
_SLOW: dict[str, object] = {}
#: The pattern's look-ahead keeps a place on a stack for each character of a run of white space,
#: and the stack has a million places. Texts with a run this long go to the vocabulary's own library.
LONG_RUN = 100_000
_RUN = re.compile(r"\s{%d}" % LONG_RUN)

#: The split pattern of the byte-level vocabulary (a fixed value of the public tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str):
    """A byte-level BPE encoder for a ``tokenizers`` JSON file, one per worker process.

    The merge ranks of such a vocabulary are its ids, so the same ids come out of the ranked
    encoder, at about a quarter of the CPU seconds. Added tokens are matched in the text first,
    as the JSON's own library does.
    """
    if path not in _ENCODERS:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE without a normalizer is needed")
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(shown[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        _ENCODERS[path] = tiktoken.Encoding("pack", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def encode(path: str, text: str) -> np.ndarray:
    """The token ids of one text as uint32."""
    if len(text) >= LONG_RUN and _RUN.search(text):
        if path not in _SLOW:
            from tokenizers import Tokenizer

            _SLOW[path] = Tokenizer.from_file(path)
        return np.array(_SLOW[path].encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    return encoder(path).encode_to_numpy(text, allowed_special="all")


class CapacityTree:
    """Segment tree whose leaf c counts the open windows with c tokens left."""

    def __init__(self, window: int) -> None:
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, left: int, window_no: int) -> None:
        self.open[left].append(window_no)
        i = self.size + left
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest open window with room for ``need``."""
        i = self.size + need
        if not self.count[i]:
            while True:  # climb until a right sibling has windows
                if i == 1:
                    return None
                if not i & 1 and self.count[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        left = i - self.size
        while i:
            self.count[i] -= 1
            i >>= 1
        return left, self.open[left].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of item numbers; ``lengths`` are at most ``window`` and in falling order."""
    tree, windows = CapacityTree(window), []
    for i, n in enumerate(lengths):
        if (found := tree.take(n)) is None:
            left, w = window, len(windows)
            windows.append([])
        else:
            left, w = found
        windows[w].append(i)
        if left > n:
            tree.put(left - n, w)
    return windows


def _tokenised(path: str, window: int, bins: int, eos: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "bin"]
        types = [pa.int64()] * 5 + [pa.binary(), pa.int64()]
        small = max(encoder(path).n_vocab, eos + 1) <= 1 << 16
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(path, text.as_py() or ""), eos).astype("<u4")
                row += 1
                spread = zlib.crc32(f"{doc} {row}".encode())
                for k, at in enumerate(range(0, len(ids), window)):
                    part = ids[at : at + window]
                    held = None if len(part) == window else part.astype("<u2" if small else "<u4").tobytes()
                    for c, v in zip(cols, (doc, at, len(part), zlib.crc32(part.tobytes()), len(ids), held, (spread + k) % bins), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return pieces


class Pool:
    """Pieces of windows that were taken apart: (row, first id, ids), given out whole or cut."""

    def __init__(self) -> None:
        self.pieces: list[tuple[int, int, int]] = []  # (ids, row, first id), short ones first
        self.total = 0

    def add(self, row: int, start: int, n: int) -> None:
        insort(self.pieces, (n, row, start))
        self.total += n

    def fill(self, room: int) -> Iterator[tuple[int, int, int]]:
        """Pieces of ``room`` ids in all, or what there is: the longest that fits, else a cut one."""
        while room and self.pieces:
            at = bisect_left(self.pieces, (room + 1,)) - 1
            n, row, start = self.pieces.pop(max(at, 0))
            take = min(n, room)
            self.total -= n
            if take < n:
                self.add(row, start + take, n - take)
            room -= take
            yield row, start, take


def closed(windows: list[list[int]], lengths: list[int], window: int, spare: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, first id, ids): ``windows`` with their free places filled.

    Windows with at most ``spare`` free places stay as they are. Of the others the emptiest are
    taken apart until the rest is full. What is left at last makes sequences of powers of two.
    """
    used = [sum(lengths[i] for i in w) for w in windows]
    out = [[(i, 0, lengths[i]) for i in w] for w in windows]
    open_ = sorted((w for w in range(len(windows)) if window - used[w] > spare and used[w] & (used[w] - 1)), key=lambda w: (-used[w], w))
    pool, first, last = Pool(), 0, len(open_) - 1
    while first <= last:
        w = open_[first]
        while pool.total < window - used[w] and last > first:
            for i in windows[open_[last]]:
                pool.add(i, 0, lengths[i])
            out[open_[last]] = []
            last -= 1
        if pool.total < window - used[w]:  # the last one: what is left makes up its own sequences
            for i in windows[w]:
                pool.add(i, 0, lengths[i])
            out[w] = []
            break
        out[w] += pool.fill(window - used[w])
        first += 1
    while pool.total:
        out.append(list(pool.fill(min(window, 1 << (pool.total.bit_length() - 1)))))
    return [s for s in out if s]


def _packer(window: int, spare: int):
    def one_bin(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        base = int(pdf["bin"].iloc[0]) << 36
        rows = list(zip(pdf["doc_id"], pdf["start"], pdf["length"], pdf["ids_crc32"], pdf["doc_tokens"], pdf["ids"], strict=True))
        lengths, out = [r[2] for r in rows], []
        for seq, parts in enumerate(closed(best_fit_decreasing(lengths, window), lengths, window, spare)):
            at, total = 0, sum(n for *_, n in parts)
            for i, first, n in parts:
                doc, start, length, crc, tokens, ids = rows[i]
                if n < length:
                    part = np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * length else "<u4")[first : first + n]
                    crc = zlib.crc32(part.astype("<u4").tobytes())
                out.append((doc, start + first, n, crc, tokens, base + seq, at, total))
                at += n
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"])

    return one_bin


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, eos: int = 0, spare: int = 16, bin_docs: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document of ``docs`` into sequences of at most ``window`` tokens.

    Returns one row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, sequence_tokens``. A document is its ids followed by ``eos``; a null or empty text is
    the one id ``eos``. Documents are dealt to bins of about ``bin_docs`` by a hash of id and
    place in their task, so many rows with one id (or null ids, kept as null) spread too; each
    bin is packed by itself, in a total order, so that a recomputed task gives the same rows.
    ``window`` is a power of two. An empty table gives no rows; other columns are not read.
    Ids are shuffled only of rests shorter than a window, two bytes each for a small vocabulary.
    ``spare``: a window with that few free places is padded rather than filled with a cut document.
    Texts of any length and with runs of any kind pass. Bins pack apart, so each may leave one set
    of short sequences, of powers of two.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bins = max(1, -(-docs.count() // bin_docs))
    pieces = src.mapInArrow(_tokenised(tokenizer_path, window, bins, eos), _PIECES)
    return pieces.groupBy("bin").applyInPandas(
        _packer(window, spare),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long",
    )


def sequences(packed: DataFrame, docs: DataFrame, tokenizer_path: str, eos: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Materialise packed sequences: ``sequence_id, ids`` (array of int, in order of offset).

    Needs ids that are unique and not null: pieces find their text by an equi-join on the id.
    """

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for text, start, length in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                got.append(np.append(encode(tokenizer_path, text or ""), eos)[start : start + length].tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.list_(pa.int32()))], names=["sequence_id", "offset", "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = packed.join(texts, "doc_id").select("sequence_id", "offset", "text", "start", "length").mapInArrow(ids, "sequence_id long, offset long, ids array<int>")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
