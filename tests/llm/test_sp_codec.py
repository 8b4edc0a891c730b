import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from gristmill.llm import queries, sp_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "  a  b", "a\x00b", "\x00", "<s> </s> <unk>", "日本語 テスト", "aaaaaaaaaaaaaaaaaaaaaaa", "\n\n\t x \r\n", "é́ö ﬁ①", "😀😀 x", "    " * 9 + "y", "▁a", "word" * 300, "0x0A <0x0A>"]


@pytest.fixture(scope="module")
def codec():
    return sp_codec.codec(PATH)


def same(codec, texts):
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in codec.encode(texts)]
    assert got == [SP.encode(t) for t in texts]
    for t, x in zip(texts, codec.encode(texts), strict=True):
        assert codec.decode(x) == t.replace("▁", " ")


def test_odd_texts(codec):
    same(codec, ODD)


def test_random_texts(codec):
    rng = random.Random(2)
    pieces = [p.replace("▁", " ") for p in codec.pieces]
    same(codec, ["".join(rng.choices(pieces, k=40)) for _ in range(500)])
    same(codec, ["".join(rng.choices("abeinrst ", k=200)) for _ in range(300)])


def test_long_units(codec, monkeypatch):
    """Units beyond the index's size are taken in parts; texts without any space among them."""
    rng = random.Random(7)
    texts = ["".join(rng.choices("abeinrst", k=900)), "ab" * 400 + " x", "日本語" * 100, "z\x00" + "anana" * 90, "word" * 150 + " " + "é" * 200]
    for size in (17, 60, 301):
        monkeypatch.setattr(sp_codec, "INDEXED", size)
        codec.cache.clear()
        codec.parts.clear()
        same(codec, texts)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(codec, text):
    got = np.frombuffer(codec.encode([text])[0], dtype="<u4").tolist()
    assert got == SP.encode(text)


def test_whole_table(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    import zlib

    got = queries.op8_sentencepiece(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(SP.encode(texts[r.doc_id] or ""), dtype="<u4")
        assert (r.n_ids, r.ids_crc32, r.round_trip) == (len(ids), zlib.crc32(ids.tobytes()), True)


def test_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5), (None, None, 6), (1, "a b", 5)], "doc_id long, text string, piece_ids int")
    got = sp_codec.decode(sp_codec.encode(df, PATH), PATH).collect()
    assert [r.decoded for r in got] == ["a b", "", "a b"] and [r.piece_ids for r in got] == [SP.encode("a b"), [], SP.encode("a b")]
    assert sp_codec.digest(df, PATH).count() == 3 and sp_codec.digest(df.limit(0), PATH).count() == 0
