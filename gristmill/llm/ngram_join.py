"""N-gram Jaccard self-join by adaptive multi-match prefixes (operator 4).

Every text is its set of word shingles. All shingles are in one global order: those whose hash
lies in a fixed low region come first, by document frequency and then hash; the others follow by
hash. A text's prefix is its first shingles in that order. Two sets that reach the threshold
share at least ``l`` shingles of their prefixes when both prefixes are ``l - 1`` longer than
needed for one; each text chooses the ``l`` with the least estimated cost of scanning and
verifying candidates, and a pair must share as many as the smaller ``l`` of the two asks for.

Texts with equal sets are one class from the start. Shared shingles are looked for in three steps,
each exact and each on fewer texts: lists of rare shingles propose pairs, which must share enough
of them; texts that common shingles could join are compared by their prefixes alone; what is left
is verified with whole sets. The last two work on groups cut into blocks by set size, and compare
only blocks whose sizes may link, by sparse products, so no pair of a large group is ever a row of
a table; only a spanning forest of the links leaves a block.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import written
from . import names
from . import text as kernel

U = np.uint64
#: Document key of a null id; sorts after all others.
NO_ID = (1 << 63) - 1
#: Longest match requirement that a text may choose; those with common shingles in their prefix do.
MOST = 8
#: Shingles held by a task before it hands them on.
FLUSH = 1 << 20
#: A shingle seen this often in one flush is a candidate for the table of frequent ones ...
OFTEN = 8
#: ... which holds at most this many, and only those with this many texts.
FREQUENT, FREQUENT_FROM = 200_000, 64
#: A shingle of this many texts at most proposes pairs; one of more texts joins them by a node.
PAIRS_UP_TO = 16
#: Texts of a group that are compared with each other in one go.
BLOCK = 512
#: Routed shingles, or list entries, that a task takes at a time.
TASK_ROWS = 2_000_000
#: Shingles of verified sets that a task takes at a time.
TASK_SHINGLES = 1_000_000
#: Bits of the filter over verified texts: eight a text, within these powers of two.
BLOOM_LEAST, BLOOM_MOST = 20, 28
#: Share of all hashes in the low region beyond what prefixes need.
MARGIN = 0.1


def needed(size: int, num: int, den: int) -> int:
    """Least overlap of a set of ``size`` with any set at a Jaccard similarity of num/den or more."""
    return -(-num * size // den)


def signature(h: np.ndarray) -> int:
    """A 64-bit hash of a set of shingle hashes, as a signed number."""
    total = kernel.mix(h ^ U(0x5851F42D4C957F2D)).sum(dtype=U) + U(len(h)) * U(0x9E3779B97F4A7C15)
    return int(kernel.mix(np.array([total], dtype=U)).view(np.int64)[0])


def parity(h: np.ndarray) -> bytes:
    """One bit for each bin of hashes, about a bit a shingle: whether the bin holds an odd number.

    The bits in which two such maps differ are at most the shingles that one of the sets lacks.
    """
    bits = 1 << max(6, (len(h) - 1).bit_length())
    return np.packbits(np.bincount((h & U(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def apart(maps: list[bytes]) -> np.ndarray:
    """In how many bits the maps of each two sets differ, the longer one folded to the shorter."""
    size = np.array([len(m) for m in maps])
    out = np.zeros((len(maps), len(maps)), dtype=np.int64)
    for width in np.unique(size).tolist():
        at = np.flatnonzero(size >= width)
        folded = np.stack([np.bitwise_xor.reduce(np.frombuffer(maps[i], np.uint8).reshape(-1, width), axis=0) for i in at.tolist()])
        ones = np.unpackbits(folded, axis=1).astype(np.float32)
        held = ones.sum(axis=1)
        far = (held[:, None] + held[None, :] - 2 * (ones @ ones.T)).astype(np.int64)
        short = np.minimum(size[at][:, None], size[at][None, :]) == width
        block = out[np.ix_(at, at)]
        block[short] = far[short]
        out[np.ix_(at, at)] = block
    return out


def sets_of(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The shingle set of each text of an Arrow column."""
    for _, _, data, offsets in kernel.blocks(column):
        data = kernel.LOWER[data]
        starts, ends, first = kernel.words_of(data, offsets)
        yield from kernel.shingles(kernel.span_hashes(data, starts, ends), first, words)


def _batch(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def _region(h: np.ndarray, limit: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(low shingles, those after them that a prefix may need) of a set, cut to 48 bits.

    48 bits keep the order, and tell the shingles of any two texts apart; sets are verified with
    all 64.
    """
    size, low = len(h), int(np.searchsorted(h, U(limit)))
    most = min(size, size - needed(size, num, den) + MOST)
    return np.unique(h[:low] >> U(16)), np.unique(h[low:most] >> U(16)) if low < most else h[:0]


def _slim(words: int, num: int, den: int, limit: int):
    """Per text its key, set size and signature, with its parity map where the set is new to the
    task; rows with n = -1 hold often seen shingles."""
    names, types = ["k", "n", "sig", "map", "often"], [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def often(held: dict[int, np.ndarray]) -> tuple:
        t, c = np.unique(np.concatenate(list(held.values())), return_counts=True)
        keep = c >= OFTEN
        return None, -1, None, None, np.concatenate((t[keep], c[keep].astype(U))).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        count = 0
        for b in batches:
            rows = []
            for k, h in zip(b.column(0).to_pylist(), sets_of(b.column(1), words), strict=True):
                sig = signature(h) if len(h) else None
                new = sig is not None and sig not in held
                rows.append((k, len(h), sig, parity(h) if new else None, None))
                if new:
                    held[sig] = _region(h, limit, num, den)[0]
                    count += len(held[sig])
                    if count >= FLUSH:
                        rows.append(often(held))
                        held, count = {}, 0
            yield _batch(names, types, rows)
        if held:
            yield _batch(names, types, [often(held)])

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for blob in b.column(0):
            t, c = np.frombuffer(blob.as_buffer(), dtype=np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(c)], names=["token", "c"])


def _flushes(batches: Iterator[pa.RecordBatch], words: int, limit: int, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """(low shingles, signature of each, rows) of distinct sets, some FLUSH shingles at a time.

    rows: (signature, set size, low shingles, further shingles). Input: a column of texts.
    """
    seen: set[int] = set()
    low, sigs, rows, held = [], [], [], 0
    for b in batches:
        for h in sets_of(b.column(0), words):
            sig = signature(h) if len(h) else None
            if sig is None or sig in seen:
                continue
            seen.add(sig)
            t, beyond = _region(h, limit, num, den)
            low.append(t)
            sigs.append(np.full(len(t), sig, dtype=np.int64))
            rows.append((sig, len(h), len(t), beyond))
            held += len(t) + 16
            if held >= FLUSH:
                yield np.concatenate(low), np.concatenate(sigs), rows
                seen, low, sigs, rows, held = set(), [], [], [], 0
    if rows:
        yield np.concatenate(low), np.concatenate(sigs), rows


def coded(df: np.ndarray) -> np.ndarray:
    """A frequency in one byte, never falling: exact to 127, then eight steps a doubling."""
    big = 128 + np.floor(8 * np.log2(np.maximum(df, 128) / 128)).astype(np.int64)
    return np.where(df < 128, df, np.minimum(big, UNKNOWN - 1)).astype(np.uint8)


def decoded(code: np.ndarray) -> np.ndarray:
    """About the frequency of a code; an unknown one counts as two."""
    c = code.astype(np.float64)
    return np.where(code == UNKNOWN, 2.0, np.where(c < 128, c, 128 * 2 ** ((c - 128) / 8)))


class Frequent:
    """Document frequencies of the most frequent shingles; the same table for every task."""

    def __init__(self, tokens: list[int], counts: list[int]) -> None:
        t = np.array(tokens, dtype=np.int64).view(U)
        order = np.argsort(t)
        self.tokens, self.counts = t[order], np.array(counts, dtype=np.int64)[order]

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """The frequency of each token, 0 where it is not in the table."""
        if not len(self.tokens):
            return np.zeros(len(tokens), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.counts[at], 0)


#: Layouts of the blobs that tasks exchange: columns one after the other.
ROUTED = (np.dtype("<u4"), np.dtype("<u2"), np.dtype("<i8"))  # shingle (high, low), signature
ANSWER = (np.dtype("<i8"), np.dtype("<u4"), np.dtype("<u2"), np.dtype("u1"))  # signature, shingle, code
#: Codes of an answer that are no frequency: its number is the set's size, or its low shingles.
SIZE, LOW, UNKNOWN = 0, 1, 255


def _dealt(bucket: np.ndarray, layout: tuple, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, blob) with the columns' values of each bucket."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = [c[order].astype(t) for c, t in zip(columns, layout, strict=True)]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    rows = [(int(bucket[a]), b"".join(c[a:b].tobytes() for c in columns)) for a, b in zip(cut, [*cut[1:], len(bucket)], strict=True)]
    yield _batch(["bucket", "blob"], [pa.int32(), pa.binary()], rows)


def _gather(batches: Iterator[pa.RecordBatch], layout: tuple) -> list[np.ndarray]:
    width = sum(t.itemsize for t in layout)
    parts: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in layout]
    for b in batches:
        for blob in b.column("blob"):
            raw = blob.as_buffer()
            n, at = raw.size // width, 0
            for p, t in zip(parts, layout, strict=True):
                p.append(np.frombuffer(raw, dtype=t, count=n, offset=at))
                at += n * t.itemsize
    return [np.concatenate(p) for p in parts]


def _whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (high.astype(np.int64) << 16) | low


def _route(frequent, words: int, limit: int, num: int, den: int, buckets: int):
    """Shingles outside the table go to the bucket of their hash, with their set."""
    step = U(max(1, -(-(limit >> 16) // buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for low, sigs, _ in _flushes(batches, words, limit, num, den):
            keep = frequent.value.of(low) == 0
            t = low[keep]
            yield from _dealt((t // step).astype(np.int64), ROUTED, [t >> U(16), t & U(0xFFFF), sigs[keep]])

    return run


def _sig_bucket(sigs: np.ndarray, buckets: int) -> np.ndarray:
    return (sigs.view(U) % U(buckets)).astype(np.int64)


def _answers(sigs: np.ndarray, tokens: np.ndarray, codes: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    t = tokens.astype(U)
    yield from _dealt(_sig_bucket(sigs, buckets), ANSWER, [sigs, t >> U(16), t & U(0xFFFF), codes])


def _frequencies(buckets: int):
    """Per shingle of a bucket its distinct sets; those with two or more go back to their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, sigs = _gather(batches, ROUTED)
        tokens = _whole(high, low)
        order = np.lexsort((sigs, tokens))
        tokens, sigs = tokens[order], sigs[order]
        fresh = np.ones(len(tokens), dtype=bool)
        fresh[1:] = (tokens[1:] != tokens[:-1]) | (sigs[1:] != sigs[:-1])
        tokens, sigs = tokens[fresh], sigs[fresh]
        if len(tokens):
            run_of = np.diff(np.append(np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))), len(tokens)))
            df = np.repeat(run_of, run_of)
            many = df >= 2
            yield from _answers(sigs[many], tokens[many], coded(df[many]), buckets)

    return run


def _own(frequent, words: int, limit: int, num: int, den: int, buckets: int):
    """What a set knows by itself: its size, its frequent shingles, its shingles beyond the region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for low, sigs, rows in _flushes(batches, words, limit, num, den):
            df = frequent.value.of(low)
            f = df > 0
            s, n, m, beyond = zip(*rows, strict=True)
            sig = np.array(s, dtype=np.int64)
            further = np.repeat(sig, [len(e) for e in beyond])
            codes = [coded(df[f]), np.full(len(sig), SIZE, np.uint8), np.full(len(sig), LOW, np.uint8), np.full(len(further), UNKNOWN, np.uint8)]
            tokens = [low[f], np.array(n, dtype=U), np.array(m, dtype=U), *beyond]
            yield from _answers(np.concatenate([sigs[f], sig, sig, further]), np.concatenate(tokens), np.concatenate(codes), buckets)

    return run


def choose(size: int, singles: int, df: np.ndarray, num: int, den: int) -> tuple[int, int]:
    """(l, prefix shingles taken from ``df``) with the least estimated cost.

    ``df``: frequencies of the set's shared shingles in global order, after ``singles`` that no
    other set has. At most sum(df - 1) / l others can share l of them, each to be verified at
    about eight times the cost of one list entry.
    """
    best = (float("inf"), 1, 0)
    overlap = needed(size, num, den)
    for match in range(1, min(MOST, overlap) + 1):
        take = min(size, size - overlap + match) - singles
        if take <= 0:
            return match, 0
        lists = float((df[:take] - 1).clip(min=1).sum())
        best = min(best, (lists * (1 + 8 / match), match, take))
    return best[1], best[2]


def shared(n: np.ndarray, slack: np.ndarray, n2: np.ndarray, slack2: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least number of shared prefix shingles of linked sets of ``n`` and ``n2`` shingles.

    ``slack``: prefix length less set size. Of an overlap of ``o`` at most ``-slack`` lie beyond the
    prefix that ends first, and the others are in both prefixes.
    """
    overlap = -(-num * (n + n2) // (num + den))
    return overlap + np.minimum(slack, slack2)


def _prefixes(num: int, den: int):
    """One row per set that may have a partner: its size, its slack, its prefix without singles.

    ``rare``: shingles of PAIRS_UP_TO texts at most, or of an unknown number; ``common``: the
    others, the most common one last; ``more``: shingles that it may share other than as a pair of
    a list; ``nodes``: of ``common``, those that join it with others. Sets that share common
    shingles alone share MOST of them, hence one that is not among the MOST - 1 last of either.
    """
    names, types = ["sig", "n", "slack", "more", "nodes", "rare", "common"], [pa.int64()] * 5 + [pa.binary()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, high, low, code = _gather(batches, ANSWER)
        tokens = _whole(high, low)
        order = np.lexsort((tokens, code, sigs))
        sigs, tokens, code = sigs[order], tokens[order], code[order]
        fresh = np.ones(len(sigs), dtype=bool)
        fresh[1:] = (sigs[1:] != sigs[:-1]) | (tokens[1:] != tokens[:-1]) | (code[1:] != code[:-1])
        sigs, tokens, code = sigs[fresh], tokens[fresh], code[fresh]
        if not len(sigs):
            return
        first = np.flatnonzero(np.concatenate(([True], sigs[1:] != sigs[:-1])))  # a set's size, then its low shingles
        size, low_count = tokens[first], tokens[first + 1]
        known = np.add.reduceat(((code > LOW) & (code < UNKNOWN)).astype(np.int64), first)
        singles = low_count - known
        df = decoded(code)
        common = (code > PAIRS_UP_TO) & (code < UNKNOWN)
        overlap = -(-num * size // den)
        live = singles < size - overlap + 1  # others have a prefix that no other set shares
        last = np.append(first[1:], len(sigs))
        rows = []
        for i in np.flatnonzero(live).tolist():
            a, b, n = int(first[i]) + 2, int(last[i]), int(size[i])
            match, take = choose(n, int(singles[i]), df[a:b], num, den)
            if common[a : a + take].any():
                match = min(MOST, int(overlap[i]))
                take = min(n, n - int(overlap[i]) + match) - int(singles[i])
            got, often = tokens[a : a + take], common[a : a + take]
            many = int(often.sum())
            spare = MOST - 1 if needed(needed(n, num, den), num, den) >= MOST else 0  # its least partner's overlap
            more = many + int((code[a : a + take] == UNKNOWN).sum())
            rows.append((int(sigs[a - 1]), n, min(0, match - int(overlap[i])), more, max(0, many - spare), got[~often].tobytes(), got[often].tobytes()))
        if rows:
            yield _batch(names, types, rows)

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rare shingles of each prefix as rows."""
    for b in batches:
        tokens = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in b.column("rare")]
        times = [len(t) for t in tokens]
        rest = [np.repeat(b.column(c).to_numpy(zero_copy_only=False), times) for c in ("sig", "n", "slack", "more")]
        cols = [np.concatenate(tokens) if tokens else np.zeros(0, np.int64), *rest]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["token", "sig", "n", "slack", "more"])


def node_of(tokens: np.ndarray) -> np.ndarray:
    """A graph node for each shingle, unlike any set's."""
    return kernel.mix(tokens.view(U) ^ U(0x7F4A7C159E3779B9)).view(np.int64)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An edge from a set to the node of each common shingle that joins it."""
    for b in batches:
        tokens = [np.frombuffer(x.as_buffer(), dtype=np.int64)[:n] for x, n in zip(b.column("common"), b.column("nodes").to_pylist(), strict=True)]
        sig = np.repeat(b.column("sig").to_numpy(zero_copy_only=False), [len(t) for t in tokens])
        yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(node_of(np.concatenate(tokens)) if tokens else sig)], names=["src", "dst"])


def _proposed(num: int, den: int):
    """Pairs of each list, and how many lists they must share at least; a long list (its shingles'
    number was unknown) gives links to its least set instead, which hold by themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(5)] for b in batches]
        if not got:
            return
        token, *rest = (np.concatenate(c) for c in zip(*got, strict=True))
        order = np.lexsort((rest[0], token))
        token, rest = token[order], [c[order] for c in rest]
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else token
        length = np.diff(np.append(first, len(token)))
        for c in range(2, PAIRS_UP_TO + 1):
            of = first[length == c]
            if not len(of):
                continue
            x, y = np.triu_indices(c, 1)
            x, y = (of[:, None] + x).ravel(), (of[:, None] + y).ravel()
            (a, n, s, m), (b, n2, s2, m2) = ([col[i] for col in rest] for i in (x, y))
            need = np.maximum(shared(n, s, n2, s2, num, den) - np.minimum(m, m2), 1)
            keep = den * np.minimum(n, n2) >= num * np.maximum(n, n2)
            yield pa.RecordBatch.from_arrays([pa.array(v[keep]) for v in (a, b, need)], names=["src", "dst", "need"])
        long = np.repeat(length > PAIRS_UP_TO, length)
        hub = np.repeat(rest[0][first], length) if len(first) else rest[0]
        yield pa.RecordBatch.from_arrays([pa.array(rest[0][long]), pa.array(hub[long]), pa.array(np.ones(int(long.sum()), np.int64))], names=["src", "dst", "need"])

    return run


def _blocked(members: DataFrame, num: int, den: int) -> DataFrame:
    """``members`` (family, sig, n, ...) once for each pair of blocks that it takes part in: adds
    ``own, i, j``. Blocks hold about BLOCK members of a family, in order of set size; a pair of
    blocks stands for those whose sizes may link."""
    counts = members.groupBy("family", "n").agg(F.count(F.lit(1)).alias("here"))
    before = F.sum("here").over(Window.partitionBy("family").orderBy("n")) - F.col("here")
    counts = counts.select("family", "n", "here", before.alias("before"))
    own = F.floor((F.col("before") + F.pmod(F.xxhash64("sig"), F.col("here"))) / BLOCK).cast("int")
    placed = members.join(counts, ["family", "n"]).withColumn("own", own)
    blocks = placed.groupBy("family", "own").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    table = F.array_sort(F.collect_list(F.struct("own", "lo", "hi")))
    family = blocks.groupBy("family").agg(table.alias("table"))  # an entry for BLOCK members
    family = family.select("family", F.explode("table").alias("b"), "table")
    with_ = F.filter("table", lambda t: F.when(t["own"] <= F.col("b.own"), den * t["hi"] >= num * F.col("b.lo")).otherwise(den * F.col("b.hi") >= num * t["lo"]))
    family = family.select("family", F.col("b.own").alias("own"), F.transform(with_, lambda t: t["own"]).alias("with"))
    out = placed.join(family, ["family", "own"]).withColumn("with", F.explode("with"))
    return out.withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with")).drop("here", "before", "with")


def _grouped(rows: DataFrame, weight: int, task: int) -> DataFrame:
    """Adds ``g``: pairs of blocks are groups of their own, families of one block are dealt to
    groups of about ``task`` out of all ``weight``."""
    single = F.pmod(F.xxhash64("family"), F.lit(max(8, -(-weight // task))))
    return rows.withColumn("g", F.when((F.col("i") == 0) & (F.col("j") == 0), single).otherwise(F.xxhash64("family", "i", "j")))


def _candidates(num: int, den: int):
    """Sets of a pair of blocks joined where their prefixes share enough and their maps differ little."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.drop_duplicates(["family", "i", "j", "sig"]).groupby(["family", "i", "j"], sort=False):
            sets = [np.frombuffer(x + y, dtype=np.int64) for x, y in zip(g["rare"], g["common"], strict=True)]
            n, slack = g["n"].to_numpy(np.int64), g["slack"].to_numpy(np.int64)
            need = shared(n[:, None], slack[:, None], n[None, :], slack[None, :], num, den)
            differ = n[:, None] + n[None, :] + 2 * (-num * (n[:, None] + n[None, :]) // (num + den))  # of linked sets at most
            linked = (overlaps(sets) >= np.maximum(need, 1)) & (apart(g["map"].tolist()) <= differ)
            np.fill_diagonal(linked, False)
            root = _roots(linked)
            joined = root != np.arange(len(root))
            sig = g["sig"].to_numpy(np.int64)
            out.append(pd.DataFrame({"src": sig[joined], "dst": sig[root[joined]]}))
        return pd.concat(out) if out else pd.DataFrame({"src": [], "dst": []})

    return run


def _probes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = kernel.mix(keys.astype(np.int64).view(U) + U(1))
    return (h % U(bits)).astype(np.int64), ((h >> U(32)) % U(bits)).astype(np.int64)


def _bloom(members: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter over the members' keys; built by eight tasks at most.

    It has eight bits a member, 32 MB at most: beyond that more rows pass it, which the join drops.
    """
    size = 1 << min(BLOOM_MOST, max(BLOOM_LEAST, (8 * count).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, dtype=bool)
        for b in batches:
            for at in _probes(b.column(0).to_numpy(zero_copy_only=False), size):
                bits[at] = True
        yield _batch(["blob"], [pa.binary()], [(np.packbits(bits).tobytes(),)])

    bits = np.zeros(size // 8, dtype=np.uint8)
    for r in members.select("k").coalesce(8).mapInArrow(run, "blob binary").toLocalIterator():
        bits |= np.frombuffer(r.blob, dtype=np.uint8)
    return bits


def _member_sets(bloom, words: int):
    names, types = ["k", "sig", "shingles"], [pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(bloom.value) * 8
        seen: set[tuple[int, int]] = set()  # rows that repeat an id and a text
        for b in batches:
            one, two = _probes(b.column(0).to_numpy(zero_copy_only=False), size)
            hit = [bloom.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 for at in (one, two)]
            b = b.filter(pa.array((hit[0] & hit[1]).astype(bool)))
            rows = []
            for k, h in zip(b.column(0).to_pylist(), sets_of(b.column(1), words), strict=True):
                if len(h) and (key := (k, signature(h))) not in seen:
                    seen.add(key)
                    rows.append((*key, h.tobytes()))
            yield _batch(names, types, rows)

    return run


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, from slices of the set-by-shingle matrix."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.float32)
    if n < 2:
        return out
    own = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count > 1
    column = np.cumsum(several) - 1
    keep = several[place]
    own, place = own[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    own, place = own[order], place[order]
    for at in range(0, int(several.sum()), width):
        a, b = np.searchsorted(place, [at, at + width])
        m = np.zeros((n, width), dtype=np.float32)
        m[own[a:b], place[a:b] - at] = 1
        out += m @ m.T
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    """Per row the smallest row of its component under a symmetric link matrix."""
    root = np.arange(len(linked))
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1, initial=len(root)))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verified(num: int, den: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), g in pdf.groupby(["family", "i", "j"], sort=False):
            g = g.drop_duplicates("sig")
            sets = [np.frombuffer(x, dtype=U) for x in g["shingles"]]
            size = np.array([len(s) for s in sets], dtype=np.int64)
            both = overlaps(sets).astype(np.int64)
            linked = den * both >= num * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(linked, False)
            if i != j:  # pairs within a block are counted with that block
                own = g["own"].to_numpy()
                linked &= own[:, None] != own[None, :]
            root = _roots(linked)
            sig, weight = g["sig"].to_numpy(np.int64), g["copies"].to_numpy(np.int64)
            out.append(pd.DataFrame({"sig": sig, "root": sig[root], "links": linked.astype(np.int64) @ weight}))
        return pd.concat(out) if out else pd.DataFrame({"sig": [], "root": [], "links": []})

    return run


def _tasks(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions of about ``each`` rows, and as many as the session has at least."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def _collect_garbage(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of tables that are written and no longer needed."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def link(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of the texts under Jaccard similarity of at least ``num / den``.

    Returns one row per row of ``docs``: ``doc_id, n_shingles, class_id, n_links, component_id``.
    ``class_id``: smallest id with an equal set; ``n_links``: rows linked with it, copies
    included; ``component_id``: smallest id reachable by links, itself included. Words are runs
    outside of ASCII white space, with A-Z lower-cased; a text with fewer than ``words`` words
    is one shingle; a null or empty text has none, is linked with nothing and is its own
    component. Rows that repeat an id are rows of their own; a null id counts as the largest
    and shows as null. An empty table gives an empty one; other columns are not read.
    The result is exact up to collisions of 64-bit hashes. At no place does a table hold all
    pairs of a group; the driver gets the fixed-size table of frequent shingles and a filter.
    """
    slim, classes = _linked(docs, words, num, den, id_col, text_col)
    classes = classes.select("sig", F.col("k").alias("class_k"), "n_links", "component_id")
    shown = lambda c: F.nullif(F.coalesce(F.col(c), F.col("k")), F.lit(NO_ID))
    return slim.join(classes, "sig", "left").select(
        F.nullif(F.col("k"), F.lit(NO_ID)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        shown("class_k").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        shown("component_id").alias("component_id"),
    )


def _linked(docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(k, n, sig) of every row, and (sig, k, n_links, component_id, component) of every distinct set.

    ``component`` tells components apart also where two of them have the same smallest id.
    """
    spark = docs.sparkSession
    # The region holds somewhat more than the shingles of a prefix, so that few sets run beyond it.
    limit = int(min(0.999, 1 - num / den + MARGIN) * (1 << 64))
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("k"), F.col(text_col).cast("string").alias("text"))
    all_rows = written(src.mapInArrow(_slim(words, num, den, limit), "k long, n long, sig long, map binary, often binary"), "slim")
    slim = all_rows.where("n >= 0").select("k", "n", "sig")
    classes = written(slim.where("sig is not null").groupBy("sig").agg(F.min("k").alias("k"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "classes")
    buckets = _tasks(spark, int((slim.agg(F.sum("n")).first()[0] or 0) * (limit / (1 << 64))), TASK_ROWS)

    often = all_rows.where("n < 0").select("often").mapInArrow(_unpacked, "token long, c long").groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT_FROM)
    table = often.orderBy(F.desc("c"), "token").limit(FREQUENT).collect()
    frequent = spark.sparkContext.broadcast(Frequent([r.token for r in table], [r.c for r in table]))
    # The shingles are made anew from the texts where they are needed: that costs some CPU, but a
    # table of them would be as large as the input.
    texts, blob = src.select("text"), "bucket int, blob binary"
    routed = texts.mapInArrow(_route(frequent, words, limit, num, den, buckets), blob).repartitionById(buckets, "bucket").mapInArrow(_frequencies(buckets), blob)
    own = texts.mapInArrow(_own(frequent, words, limit, num, den, buckets), blob)
    prefix = written(routed.unionAll(own).repartitionById(buckets, "bucket").mapInArrow(_prefixes(num, den), "sig long, n long, slack long, more long, nodes long, rare binary, common binary"), "prefix")
    del routed, own, often
    _collect_garbage(spark)

    entries = int(prefix.agg(F.sum(F.octet_length("rare"))).first()[0] or 0) // 8
    lists = prefix.select("sig", "n", "slack", "more", "rare").mapInArrow(_entries, "token long, sig long, n long, slack long, more long")
    pairs = lists.repartition(_tasks(spark, entries, TASK_ROWS), "token").mapInArrow(_proposed(num, den), "src long, dst long, need long")
    pairs = pairs.groupBy("src", "dst", "need").agg(F.count(F.lit(1)).alias("c")).where("c >= need and src <> dst").select("src", "dst")
    joined = prefix.where("nodes > 0").select("sig", "nodes", "common").mapInArrow(_joined, "src long, dst long")
    families = connected_components(pairs.unionAll(joined)).select(F.col("node").alias("sig"), F.col("component").alias("family"))
    members = written(families.join(prefix.select("sig", "n"), "sig"), "families")
    members = members.join(members.groupBy("family").agg(F.count(F.lit(1)).alias("of")).where("of > 1").select("family"), "family")
    maps = all_rows.where("map is not null").select("sig", "map")
    compared = _grouped(_blocked(members, num, den), entries, TASK_SHINGLES).join(prefix.select("sig", "slack", "rare", "common"), "sig").join(maps, "sig")
    compared = compared.select("g", "family", "i", "j", "sig", "n", "slack", "rare", "common", "map")
    near = written(compared.groupBy("g").applyInPandas(_candidates(num, den), "src long, dst long"), "near")

    families = connected_components(near).select(F.col("node").alias("sig"), F.col("component").alias("family"))
    members = written(families.join(classes, "sig"), "members")
    count, shingles = members.agg(F.count(F.lit(1)), F.sum("n")).first()
    bloom = spark.sparkContext.broadcast(_bloom(members, count))
    sets = src.mapInArrow(_member_sets(bloom, words), "k long, sig long, shingles binary")
    held = _grouped(_blocked(members, num, den), shingles or 0, TASK_SHINGLES).join(sets, ["k", "sig"])
    checked = held.select("g", "family", "i", "j", "sig", "copies", "shingles", "own").groupBy("g").applyInPandas(_verified(num, den), "sig long, root long, links long")
    checked = written(checked, "checked")

    found = connected_components(checked.where("sig <> root").select(F.col("sig").alias("src"), F.col("root").alias("dst")))
    links = checked.groupBy("sig").agg(F.sum("links").alias("links")).where("links > 0")
    linked = links.join(found, links["sig"] == found["node"]).select("sig", "links", "component").join(classes, "sig")
    linked = written(linked, "linked")
    least = linked.groupBy("component").agg(F.min("k").alias("component_id"))
    linked = linked.join(least, "component").select("sig", "links", "component_id", "component")
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    return slim, classes.join(linked, "sig", "left").select("sig", "k", links, F.coalesce("component_id", "k").alias("component_id"), F.coalesce("component", "sig").alias("component"))


def _signatures(words: int) -> Callable:
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([signature(h) if len(h) else None for h in sets_of(texts, words)], pa.int64())

    return run


def keep_one(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``link``: one of its smallest id; columns as they are.

    The rows are chosen by id and shingle set, so a row stays or goes by its own text where others
    repeat its id. A null id counts as the largest. If the smallest id of a component has several
    sets, the least signature stays; if rows repeat the id and the set, the least row does, by
    those of its columns that can be ordered. Every text without words stays.
    """
    slim, classes = _linked(docs, words, num, den, id_col, text_col)
    k, sig, row = (names.free(docs, x) for x in ("k", "sig", "row"))
    first = classes.groupBy("component").agg(F.min(F.struct("k", "sig")).alias("first")).select("component", "first")
    held = slim.where("sig is not null").groupBy("k", "sig").agg(F.count(F.lit(1)).alias("rows"))
    first = classes.select("sig", "component").join(first, "component").select("sig", "first")
    stays = F.struct("k", "sig") == F.col("first")
    marked = held.join(first, "sig").select(F.col("k").alias(k), F.col("sig").alias(sig), stays.alias("stays"), "rows").where("not stays or rows > 1")
    marked = written(marked, "marked")
    rows = docs.select(*names.own(docs), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias(k), _signatures(words)(F.col(text_col).cast("string")).alias(sig))
    once = rows.join(marked.select(k, sig), [k, sig], "left_anti").select(*names.own(docs))
    again = marked.where("stays").select(k, sig)
    if again.isEmpty():
        return once
    ordered = [c for c, f in zip(names.own(docs), docs.schema, strict=True) if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    least = rows.join(again, [k, sig], "left_semi").groupBy(k, sig).agg(F.min_by(F.struct(*names.own(docs)), F.struct(*ordered)).alias(row))
    return once.unionAll(least.select(f"{row}.*"))
