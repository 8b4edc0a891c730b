"""SentencePiece encoding and decoding of a BPE model by suffix-array matching (operator 8).

The distinct words of a batch are concatenated and indexed by a suffix array (sorted to the
length of the longest piece). Every piece is found by binary search as a range of the array; the
occurrences are edges, sorted by where they end; one pass over the positions then relaxes them:
an edge survives if its piece may follow the last piece of the best way to its start. For a
byte-pair model exactly one such way reaches a position, and it is the merge result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: A unit: spaces and the word after them; no piece reaches from a word into the next space.
UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Code points of distinct units indexed at a time, and units remembered by a worker.
INDEXED, REMEMBERED = 400_000, 1_000_000
#: Code points of texts encoded together; the more, the fewer searches of the whole piece list.
TOGETHER = 4_000_000


class Codec:
    """A model's pieces, its merges, and encoding and decoding of batches."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        if sp.normalize("ﬁ a  b ") != f"{SPACE}ﬁ{SPACE}a{SPACE}{SPACE}b{SPACE}" or any(SPACE in p.lstrip(SPACE) for p, k in zip(pieces, plain, strict=True) if k):
            raise ValueError("the model normalises texts, or its pieces cross spaces")
        self.unknown = sp.unk_id()
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        self.text = [b"" if sp.is_control(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i) else " ⁇ ".encode() if sp.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        # Ranks: single characters first, then merged pieces from the best score down.
        order = sorted((i for i in range(n) if plain[i]), key=lambda i: (len(pieces[i]) > 1, -sp.get_score(i), i))
        self.ids = np.array(order, dtype=np.int64)
        self.pieces = [pieces[i] for i in order]
        self.singles = sum(len(p) == 1 for p in self.pieces)
        rank = {p: r for r, p in enumerate(self.pieces)}
        self.merge = {(rank[p[:k]], rank[p[k:]]): r for r, p in enumerate(self.pieces) for k in range(1, len(p)) if p[:k] in rank and p[k:] in rank}
        self.halves = [(r, r) for r in range(self.singles)] + [(-1, -1)] * (len(self.pieces) - self.singles)
        for r in range(self.singles, len(self.pieces)):
            parts = self._merged([rank[c] for c in self.pieces[r] if c in rank], r)
            if len(parts) == 2 and "".join(self.pieces[x] for x in parts) == self.pieces[r]:
                self.halves[r] = parts[0], parts[1]
        self.known = set(self.pieces[: self.singles])
        self.longest = max(map(len, self.pieces))
        chars = max(map(ord, self.known)) + 1
        self.codes = np.zeros((len(self.pieces), self.longest), dtype=np.int32)
        for r, p in enumerate(self.pieces):
            self.codes[r, : len(p)] = [ord(c) for c in p]
        self.lengths = np.array([len(p) for p in self.pieces])
        self.top = chars
        self.follow: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.inside = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}

    def _merged(self, parts: list[int], below: int) -> list[int]:
        """Merge the best-ranked pair, leftmost first, with pieces ranked before ``below``."""
        while len(parts) > 1:
            best = min(((m, i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (m := self.merge.get(p, below)) < below), default=None)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [best[0]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' characters ends in just these two pieces.

        The boundary holds unless some pair across it would have been merged before the pieces on
        its sides were made; their last merges are undone one by one, the later one first.
        """
        key = left * len(self.pieces) + right
        if (known := self.follow.get(key)) is not None:
            return known
        a, b, limit, ok = left, right, len(self.pieces) + 1, True
        while True:
            if self.merge.get((a, b), limit) < limit:
                ok = False
                break
            undo_left = (a > b and a >= self.singles) or b < self.singles
            if undo_left:
                if a < self.singles:
                    break
                limit, a = a, self.halves[a][1]
            else:
                limit, b = b + 1, self.halves[b][0]
        if len(self.follow) > 4_000_000:
            self.follow.clear()
        self.follow[key] = ok
        return ok

    def edges(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts of the units, and start, end, piece of every occurrence sorted by end)."""
        code = np.frombuffer(("\0".join(units) + "\0").encode("utf-32-le"), dtype=np.int32)
        begin = np.concatenate(([0], np.cumsum([len(u) + 1 for u in units])))
        n = len(code)
        rank = np.unique(code, return_inverse=True)[1].astype(np.int64)
        step = 1
        while True:
            shifted = np.zeros(n, dtype=np.int64)
            shifted[: n - step] = rank[step:] + 1 if step < n else 0
            key = rank * (n + 1) + shifted
            suffixes = np.argsort(key, kind="stable")
            step *= 2
            if step >= self.longest:
                break
            ordered = key[suffixes]
            rank = np.empty(n, dtype=np.int64)
            rank[suffixes] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        low, high = np.zeros(len(self.pieces), np.int64), np.full(len(self.pieces), n, np.int64)
        padded = np.concatenate((code, np.zeros(self.longest, np.int32)))
        for depth in range(self.longest):
            live = np.flatnonzero((self.lengths > depth) & (low < high))
            want = self.codes[live, depth]
            for side, bound in (("left", low), ("right", high)):
                a, b = low[live].copy(), high[live].copy()
                while (open_ := a < b).any():
                    mid = (a + b) >> 1
                    c = padded[suffixes[np.minimum(mid, n - 1)] + depth]
                    right = open_ & ((c < want) if side == "left" else (c <= want))
                    a = np.where(right, mid + 1, a)
                    b = np.where(open_ & ~right, mid, b)
                if side == "left":
                    first = a
                else:
                    high[live] = a
            low[live] = first
        count = np.maximum(high - low, 0)
        piece = np.repeat(np.arange(len(self.pieces)), count)
        at = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        start = suffixes[at]
        end = start + self.lengths[piece]
        order = np.lexsort((start, end))
        return begin, start[order], end[order], piece[order]

    def _relax(self, a: int, low: int, high: int, first: list[int], start: list[int], piece: list[int], last: list[int], back: list[int]) -> None:
        """Find the last piece of the best way to each position in (low, high] of the unit that
        begins at ``a``; edges that end at position e are first[e - low] up to first[e - low + 1]."""
        follow, memo, width, halves, singles = self.may_follow, self.follow.get, len(self.pieces), self.halves, self.singles
        for e in range(low + 1, high + 1):
            for k in range(first[e - low], first[e - low + 1]):
                s, p = start[k], piece[k]
                left = last[s] if s > a else -1
                if left < 0:  # nothing merges across the unit's start or an unknown character
                    if (s == a or last[s] == -2) and (p < singles or halves[p][0] >= 0):
                        last[e], back[e] = p, s
                        break
                    continue
                ok = memo(left * width + p)
                if (follow(left, p) if ok is None else ok) and (p < singles or halves[p][0] >= 0):
                    last[e], back[e] = p, s
                    break
            else:
                last[e], back[e] = -2, e - 1  # an unknown character

    def _ids(self, unit: str, a: int, last: list[int], back: list[int]) -> bytes:
        """The ids on the best way through the unit that begins at ``a``."""
        got, e = [], a + len(unit)
        while e > a:
            if last[e] >= 0:
                got.append(int(self.ids[last[e]]))
            else:
                raw = unit[e - 1 - a].encode()
                got += [self.bytes.get(x, self.unknown) for x in reversed(raw)] if self.bytes else [self.unknown]
            e = back[e]
        return np.array(got[::-1], dtype="<u4").tobytes()

    def _long_unit(self, unit: str) -> bytes:
        """One unit of any length, indexed in parts that overlap by the longest piece."""
        last, back = array("i", [-1]) * (len(unit) + 1), array("i", [0]) * (len(unit) + 1)
        for low in range(0, len(unit), INDEXED):
            before, high = max(0, low - self.longest), min(len(unit), low + INDEXED)
            _, start, end, piece = self.edges([unit[before:high]])
            keep = end + before > low
            first = np.searchsorted(end[keep] + before, np.arange(low, high + 2)).tolist()
            self._relax(0, low, high, first, (start[keep] + before).tolist(), piece[keep].tolist(), last, back)
        return self._ids(unit, 0, last, back)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of each unit as little-endian 32-bit numbers."""
        if any(len(u) > INDEXED for u in units):
            short = [u for u in units if len(u) <= INDEXED]
            done = iter(self.encode_units(short) if short else [])
            return [self._long_unit(u) if len(u) > INDEXED else next(done) for u in units]
        begin, start, end, piece = self.edges(units)
        total = int(begin[-1])
        first = np.searchsorted(end, np.arange(total + 2)).tolist()
        start, piece = start.tolist(), piece.tolist()
        last, back, out = [-1] * (total + 1), [0] * (total + 1), []
        for u, a in zip(units, begin[:-1].tolist(), strict=True):
            self._relax(a, a, a + len(u), first[a : a + len(u) + 2], start, piece, last, back)
            out.append(self._ids(u, a, last, back))
        return out

    def _pieces_apart(self, unit: str) -> list[str]:
        """``unit`` cut between characters that stand side by side in no piece: no merge reaches across."""
        inside, out, a = self.inside, [], 0
        for i in range(1, len(unit)):
            if unit[i - 1 : i + 1] not in inside:
                out.append(unit[a:i])
                a = i
        out.append(unit[a:])
        return out

    def _learn(self, words: set[str]) -> None:
        """Put the ids of ``words`` (units without their leading space mark) into the cache."""
        apart = {w: self._pieces_apart(SPACE + w) for w in sorted(words)}
        fresh, held = [], 0
        for part in dict.fromkeys(x for parts in apart.values() for x in parts if x not in self.parts):
            fresh.append(part)
            held += len(part) + 1
            if held >= INDEXED:
                self.parts.update(zip(fresh, self._safe(fresh), strict=True))
                fresh, held = [], 0
        if fresh:
            self.parts.update(zip(fresh, self._safe(fresh), strict=True))
        known = self.parts
        self.cache.update((w, b"".join([known[x] for x in parts])) for w, parts in apart.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the model's own library gives them."""
        cache = self.cache
        if len(cache) > REMEMBERED:
            cache.clear()
            self.parts.clear()
        cut, fresh = [], set()
        for t in texts:
            if not t:
                words = []
            elif "  " in t or t[-1] == " " or t[0] == " " or SPACE in t:  # runs of spaces belong to the word after them
                words = [u[1:] if u[0] == SPACE else u for u in UNITS.findall(SPACE + t.replace(" ", SPACE))]
            else:
                words = t.split(" ")
            cut.append(words)
            fresh.update(words)
        self._learn(fresh.difference(cache))
        return [b"".join([cache[w] for w in words]) for words in cut]

    def _safe(self, units: list[str]) -> list[bytes]:
        """Units with the separator inside are cut around it; it is never a piece."""
        if "\0" not in "".join(units):
            return self.encode_units(units)
        out = []
        for u in units:
            parts = u.split("\0")
            zero = np.array([self.bytes.get(0, self.unknown)], dtype="<u4").tobytes()
            done = iter(self.encode_units([p for p in parts if p])) if any(parts) else iter(())
            out.append(zero.join(next(done) if p else b"" for p in parts))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces and bytes joined, without the space put before the text."""
        text = self.text
        raw = b"".join([text[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about TOGETHER bytes of the second column, one row at least."""
    size = np.cumsum([n or 0 for n in pc.binary_length(batch.column(1)).to_pylist()])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + TOGETHER, "right")))
        yield batch.slice(at, to - at)
        at = to


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids`` (array of int), equal to the model library's ids.

    Null and empty texts have no ids. Whole texts, row by row, no shuffle; other columns pass, a
    column ``piece_ids`` is replaced.
    """

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        c, out = codec(model_path), []
        for part in _parts(pa.RecordBatch.from_arrays([texts, texts], names=["key", "text"])):
            out += [np.frombuffer(x, dtype="<i4") for x in c.encode([t or "" for t in part.column(1).to_pylist()])]
        return pa.array(out, pa.list_(pa.int32()))

    return docs.withColumn("piece_ids", run(F.col(text_col).cast("string")))


def decode(docs: DataFrame, model_path: str, ids_col: str = "piece_ids") -> DataFrame:
    """``docs`` with ``decoded`` (string); null ids read as none."""

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        c = codec(model_path)
        return pa.array([c.decode(np.array(x or [], dtype="<u4").tobytes()) for x in ids.to_pylist()], pa.string())

    return docs.withColumn("decoded", run(F.col(ids_col)))


def digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: ``doc_id, n_ids, ids_crc32, decoded_sha256, round_trip``.

    ``round_trip``: decoding gives the text back (a null text counts as empty; a text that itself
    holds the space mark U+2581 cannot). One pass, no shuffle.
    """
    names, types = ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "round_trip"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in batches:
            rows = []
            for part in _parts(b):
                texts = [t or "" for t in part.column(1).to_pylist()]
                for i, t, x in zip(part.column(0).to_pylist(), texts, c.encode(texts), strict=True):
                    back = c.decode(x)
                    rows.append((i, len(x) // 4, zlib.crc32(x), hashlib.sha256(back.encode()).hexdigest(), back == t))
            cols = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c_, t) for c_, t in zip(cols, types, strict=True)], names=names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean")
