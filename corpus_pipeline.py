"""A training-corpus pipeline: quality rules, language, near duplicates, packing.

``STAGES`` lists (name, function) pairs. A function takes (spark, docs, sf_dir) and returns the
rows that go on; the last one returns packed pieces. ``run`` writes each stage's result to the
shared folder and reads it back as the next one's input, so a lost executor repeats one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import langid, names, ngram_join, packing, quality
from gristmill.session import written
from gristmill.tables import load

#: A document whose letters belong to its main language by less than this is rejected.
MAIN_LANGUAGE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; a null text has no words and goes."""
    q = names.free(docs, "quality")
    return quality.score(docs, out=q).where(f"{q}.kept").select(*names.own(docs))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language, learned from the stated languages of these documents."""
    model = langid.train(docs, key=F.col("doc_id"))
    spoken = names.free(docs, "spoken")
    found = langid.predict(docs, model, out=spoken)
    return found.where((F.col(f"{spoken}.lang") != "und") & (F.col(f"{spoken}.score") >= MAIN_LANGUAGE)).select(*names.own(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group under 5-word shingle similarity of 0.8 or more: the smallest id."""
    return ngram_join.keep_one(docs, words=5, num=8, den=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All kept documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("language", language), ("near_duplicates", near_duplicates), ("packing", packed)]

#: SQL cannot express the language, shingle and token stages; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole documents table."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
