"""The input tables: names and a loader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

NAMES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str, reader: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """One input table; column pruning and filters reach the parquet scan. ``reader`` may stand in
    for that scan and gets the path without its suffix (P1)."""
    if name not in NAMES:
        raise ValueError(f"unknown table {name!r}")
    if reader:
        return reader(spark, f"{sf_dir.rstrip('/')}/{name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
