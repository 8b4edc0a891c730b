import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gristmill.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, "a", "  \n\n x  ", "<|endoftext|> a", "日本語" * 50, "é́'S 's", "word " * 3000, "same", "same", "\x00\x85\x1c", "a" * 5000]


def want(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def verify(rows, docs, window=1024):
    ids = dict(zip([d for d, _ in docs], want([t for _, t in docs]), strict=True))
    by_doc, by_seq = {}, {}
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, x in ids.items():
        at = 0
        for s, n in sorted(by_doc[d]):
            assert s == at
            at += n
        assert at == len(x)
    padding = tokens = 0
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window
        tokens += at
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding <= 0.02 * tokens


def test_equal_ids():
    for text, ids in zip(ODD, want(ODD), strict=True):
        assert packing.encode(PATH, text or "").tolist() + [0] == ids


def test_runs_of_any_length():
    for text in ("a" + " " * 1_200_000 + "b", "\n" * 700_000 + " x", " \t" * 400_000, "a" * 300_000, "7" * 300_000, "!" * 300_000, "ab " * 200_000):
        assert np.array_equal(packing.encode(PATH, text), np.array(want([text])[0][:-1]))
    assert len(packing.encode(PATH, " " * 5_000_000)) > 0


def test_long_space_is_packed(spark):
    rows = [(1, " " * 1_000_000), (2, "x"), (3, "\n" * 600_000 + "end")]
    verify(packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect(), rows)


def test_documents_stay_whole():
    """Of equal documents that leave a gap, each window keeps its own whole; gaps are closed."""
    for size, per_window in ((600, 1), (450, 2)):
        lengths = [size] * 500
        got = packing.closed(packing.best_fit_decreasing(lengths, 1024), lengths, 1024, 16)
        whole = sum(n == size for s in got for _, _, n in s)
        full = sum(sum(n for *_, n in s) == 1024 for s in got)
        assert full == 500 * size // 1024 and whole >= per_window * full and whole > 250
        covered = sorted((i, a, a + n) for s in got for i, a, n in s)
        for i in range(500):
            spans = [(a, b) for k, a, b in covered if k == i]
            assert spans[0][0] == 0 and spans[-1][1] == size and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_pack_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = packing.pack(df, PATH, bin_docs=64).collect()
    verify(got, rows)
    assert sorted(got) == sorted(packing.pack(df, PATH, bin_docs=64).collect())


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, PATH).count() == 0
    df = spark.createDataFrame([(None, None, 1), (None, "x", 2), (5, "x", 3), (5, "x", 4)], "doc_id long, text string, start int")
    got = packing.pack(df, PATH).collect()
    assert len(got) == 4 and sum(r.doc_id is None for r in got) == 2


def test_best_fit_is_tightest():
    rng = random.Random(4)
    for _ in range(30):
        lengths = sorted((rng.randint(1, 64) for _ in range(80)), reverse=True)
        room, plain = [], []
        for i, n in enumerate(lengths):
            fits = [r for r in room if r >= n]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - n)
            else:
                room.append(64 - n)
            plain.append(sorted(room))
        windows = packing.best_fit_decreasing(lengths, 64)
        assert sorted(64 - sum(lengths[i] for i in w) for w in windows) == sorted(room)


def test_sequences(spark):
    rows = [(i, f"text number {i} " * (i + 1)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    packed = packing.pack(df, PATH, window=64)
    got = {r.sequence_id: r.ids for r in packing.sequences(packed, df, PATH).collect()}
    assert sum(map(len, got.values())) == sum(map(len, want([t for _, t in rows])))
    ids = want([t for _, t in rows])
    for p in packed.collect():
        assert got[p.sequence_id][p.offset : p.offset + p.length] == ids[p.doc_id][p.start : p.start + p.length]
