"""Column names that do not clash with those of a user's table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def own(df: DataFrame, *without: str) -> list[Column]:
    """All columns of ``df`` but those named, also where a name holds a dot."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in without]


def free(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores added until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
