"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..tables import load
from . import langid, license_scan, lz, ngram_join, oracles, packing, quality, sp_codec, toxicity, url_filter, warc


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: The rules that the contract of op2 fixes.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url judged by rule or by its template."""
    return url_filter.filter_urls(load(spark, sf_dir, "pages"), URL_RULES)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    path = f"{scratch_dir(spark)}/archive"
    warc.write(load(spark, sf_dir, "pages"), path)
    got = warc.read(spark, path, with_payload=False)
    number = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("")).cast("long")
    return got.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word shingle similarity of 0.9 or more."""
    return ngram_join.link(load(spark, sf_dir, "documents"), words=3, num=90, den=100).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) == 2
    model = langid.train(docs.where(~held), key=F.col("doc_id"))
    got = langid.predict(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return got.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op6_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase fingerprints of every document and of its edited text."""
    return lz.compare_neighbours(load(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    q = quality.score(load(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return q.select("doc_id", *[F.col(f"quality_rules.{n}").alias(n) for n in names])


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded into pieces and decoded again."""
    return sp_codec.digest(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source / range of 4096 ids / range of 64 ids / file.

    The tables hold no paths. Names come from ids alone: the first id of each range stands for the
    NOTICE of its directory, whatever its text.
    """
    source = F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown"))
    large, small = F.expr("doc_id div 4096").cast("string"), F.expr("doc_id div 64").cast("string")
    notice, file = F.concat(F.lit("NOTICE-"), F.col("doc_id")), F.concat(F.col("doc_id"), F.lit(".txt"))
    path = F.when(F.expr("doc_id % 4096 = 0"), F.concat_ws("/", source, large, notice)).when(F.expr("doc_id % 8 = 0"), F.concat_ws("/", source, large, small, notice)).otherwise(F.concat_ws("/", source, large, small, file))
    return docs.select("doc_id", "text", path.alias("path"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, stated or inherited."""
    got = license_scan.scan(as_files(load(spark, sf_dir, "documents")))
    return got.withColumn("doc_id", F.regexp_extract("path", "([0-9]+)(?:[.]txt)?$", 1).cast("long"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned from the labels that are not held out."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    held = lambda c: (F.crc32(F.col(c).cast("string").cast("binary")) % 5) == 0
    model = toxicity.train(docs, load(spark, sf_dir, "labels").where(~held("doc_id")))
    got = toxicity.score(docs, model)
    return got.select("doc_id", held("doc_id").alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_packing, op2_url_filter, op3_warc, op4_ngram_join, op5_langid, op6_lz_fingerprint, op7_quality, op8_sentencepiece, op9_license_scan, op10_toxicity)}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": oracles.warc_sql(), "op4_ngram_join": oracles.components_sql(), "op7_quality": oracles.quality_sql()}
