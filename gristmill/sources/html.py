"""Links of HTML pages (survey 2.A)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def links(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """``id, link, n``: every ``<a href="...">`` in order, and how many the page has."""
    found = F.regexp_extract_all(F.col(html_col), F.lit(r'<a\s+href="([^"]*)"'), 1)
    return pages.select(id_col, F.explode(found).alias("link"), F.size(found).cast("long").alias("n"))
