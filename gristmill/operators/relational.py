"""Joins and set operators (survey 2.C, 2.D, 2.H)."""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry
from . import near


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, null if none does."""
    out = F.lit(None).cast("string")
    for name, test in reversed(rules):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def all_reasons(rules: list[tuple[str, Column]]) -> Column:
    """The sorted names of all rules that hold."""
    return F.array_sort(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules])))


def mentions(df: DataFrame, markers: list[str]) -> Column:
    """Whether the row's JSON, names included, holds a marker in any case."""
    dump = F.lower(F.to_json(F.struct(*df.columns)))
    out = F.lit(False)
    for m in markers:
        out = out | dump.contains(m.lower())
    return out


def bijection(left: DataFrame, right: DataFrame, key: str, equal: list[str]) -> DataFrame:
    """Violations of a one-to-one match: missing on a side, or unequal bound fields."""
    a, b = left.select(key, *[F.col(c).alias(f"l_{c}") for c in equal], F.lit(1).alias("__l")), right.select(key, *[F.col(c).alias(f"r_{c}") for c in equal], F.lit(1).alias("__r"))
    joined = a.join(b, key, "full_outer")
    rules = [("missing_right", F.col("__r").isNull()), ("missing_left", F.col("__l").isNull())]
    rules += [(f"unequal_{c}", ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))) for c in equal]
    return joined.select(key, first_reason(rules).alias("issue")).where("issue is not null")


def overlay(base: DataFrame, over: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Upsert: overlay values win where present, rows of the overlay alone are appended."""
    o = over.select(key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__hit"))
    j = base.join(o, key, "full_outer")
    rest = [c for c in base.columns if c != key and c not in columns]
    return j.select(key, *rest, *[F.coalesce(f"__{c}", c).alias(c) for c in columns], F.coalesce("__hit", F.lit(False)).alias("overlaid"))


def two_key_lookup(rows: DataFrame, first: DataFrame, second: DataFrame, key: str, fallback: list[str], value: str) -> DataFrame:
    """Match by one key, else by another, else not at all."""
    a = first.select(key, F.col(value).alias("__a"))
    b = second.select(*fallback, F.col(value).alias("__b"))
    j = rows.join(a, key, "left").join(b, fallback, "left")
    by = F.when(F.col("__a").isNotNull(), "first").when(F.col("__b").isNotNull(), "second").otherwise("none")
    return j.select(*rows.columns, F.coalesce("__a", "__b").alias(value), by.alias("matched_by"))


def alias_anti(rows: DataFrame, key: str, aliases: str, frozen: DataFrame, name: str) -> DataFrame:
    """Rows none of whose aliases is frozen."""
    hit = rows.select(key, F.explode(aliases).alias(name)).join(frozen.select(name), name, "left_semi").select(key).distinct()
    return rows.join(hit, key, "left_anti")


def signature_classes(sigs: DataFrame, more: list[str] | None = None) -> DataFrame:
    """``id, sig, n``: one row for each signature (and ``more`` columns), its least id and its rows.

    Pairs are looked for between classes, so a group of equal rows is never expanded.
    """
    return sigs.groupBy("sig", *(more or [])).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))


def signature_pairs(left: DataFrame, right: DataFrame, radius: int, id_col: str = "id", sig_col: str = "sig") -> DataFrame:
    """Pairs of two tables within a Hamming radius, exact by the pigeonhole principle.

    Give it classes of equal signatures (``signature_classes``), not rows. ``class_pairs`` takes one
    table with itself in half the work.
    """
    rows = [t.select(F.col(id_col).alias("id"), F.col(sig_col).alias("sig"), F.lit(side).alias("side")) for t, side in ((left, near.FIRST), (right, near.SECOND))]
    return near.near_signatures(rows[0].unionAll(rows[1]), radius, rising=False)


def class_pairs(classes: DataFrame, radius: int, features: list[str] | None = None, mean: float = 0) -> DataFrame:
    """``a, b, distance``: pairs a < b of one table of classes (id, sig) within a Hamming radius.

    With ``features`` (whole numbers, part of the class) only those whose mean absolute difference is at
    most ``mean``, compared along with the signatures, so no pair that it leaves out is a row (D20).
    """
    rows = classes.select("id", "sig", F.lit(near.FIRST | near.SECOND).alias("side"), *(features or []))
    return near.near_signatures(rows, radius, features=features, total=math.floor(mean * len(features or [])))


def within_metres(left: DataFrame, right: DataFrame, metres: float, keys: list[str] | None = None) -> DataFrame:
    """Pairs of rows (lon1, lat1; lon2, lat2) at most ``metres`` apart, with their distance.

    Places are points of a ball, dealt to cubes of that size; a chord is no longer than its arc, so
    partners lie in the same or a neighbouring cube, at the poles and the date line too.
    """
    cell = lambda lon, lat, by: [F.floor(c / metres).cast("long") + d for c, d in zip(geometry.ball(F.col(lon), F.col(lat)), by, strict=True)]
    a = left.withColumn("__cube", F.array(*cell("lon1", "lat1", (0, 0, 0))))
    around = F.array(*[F.array(*cell("lon2", "lat2", by)) for by in product((-1, 0, 1), repeat=3)])
    b = right.withColumn("__cube", F.explode(around))
    far = F.round(geometry.haversine(F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2")), 3)
    return a.join(b, [*(keys or []), "__cube"]).withColumn("metres", far).where(F.col("metres") <= metres).drop("__cube")


def interval_counts(spans: DataFrame, start: str, end: str, step: int, least: int) -> DataFrame:
    """Ticks covered by at least ``least`` spans, with the ids that cover them."""
    a, b = F.ceil(F.col(start) / step).cast("long"), F.floor(F.col(end) / step).cast("long")
    ticks = spans.where(a <= b).select("id", F.explode(F.sequence(a, b)).alias("k"))
    return ticks.groupBy((F.col("k") * step).alias("tick")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def pairs_by_key(rows: DataFrame, key: Column, kind: str, kinds: tuple[str, str]) -> DataFrame:
    """Two kinds of rows that share a derived key, side by side; orphans have a null side."""
    g = rows.select(key.alias("pair_key"), kind, "id").groupBy("pair_key").pivot(kind, list(kinds)).agg(F.min("id"))
    return g.withColumn("complete", F.col(kinds[0]).isNotNull() & F.col(kinds[1]).isNotNull())
