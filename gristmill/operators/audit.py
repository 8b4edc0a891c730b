"""Nested quotas, exclusion lists, receipts, coverage and baselines (survey 2.E, 2.F, 2.G, 2.H, 2.L, 2.M, 2.O)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import haversine
from . import ordering


def nested_quota(counts: DataFrame, parent: list[str], key: str, n: str, budget: str) -> DataFrame:
    """Highest-averages seats of each parent's ``budget`` among its keys, at least one each."""
    seats = counts.where(F.col(budget) > 0).withColumn("q", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col(n), F.col(budget)).cast("long"))))
    w = Window.partitionBy(*parent).orderBy(F.when(F.col("q") == 1, 0).otherwise(1), F.desc(F.col(n) / F.col("q")), key)
    return seats.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= F.col(budget)).groupBy(*parent, key).agg(F.count(F.lit(1)).alias("quota"))


def strata_cap(df: DataFrame, split: str, camera: str, episode: str, ts: str, tie: str, cap: int) -> DataFrame:
    """Every row and ``selected``: quotas by split, then by camera, then spread over episodes.

    With fewer places than episodes the j-th place goes to episode floor((2j + 1) E / 2k) in time
    order, else episodes give their rows in turn; inside an episode the middle goes first. The
    quota tables hold counts only; the last rank needs a camera's rows in order.
    """
    stratum = [split, camera]
    c = df.groupBy(*stratum).agg(F.count(F.lit(1)).alias("__n"))
    top = ordering.proportional_quota(c.groupBy(split).agg(F.sum("__n").alias("__n")), split, "__n", cap).withColumnRenamed("quota", "__b")
    quota = nested_quota(c.join(top, split), [split], camera, "__n", "__b")
    e = df.groupBy(*stratum, episode).agg(F.min(ts).alias("__first"))
    e = e.withColumn("__e", F.row_number().over(Window.partitionBy(*stratum).orderBy("__first", episode)).cast("long") - 1).withColumn("__all", F.count(F.lit(1)).over(Window.partitionBy(*stratum)))
    j = ordering.centre_out(df, [*stratum, episode], [F.col(ts), F.col(tie)]).join(e.drop("__first"), [*stratum, episode]).join(quota, stratum, "left")
    k, n, p = F.coalesce("quota", F.lit(0)), F.col("__all"), F.col("__e")
    place = F.floor((2 * k * p + n - 1) / (2 * n))  # the first place that can fall on episode p
    spread = (F.col("centre_rank") == 1) & (place < k) & (F.floor((2 * place + 1) * n / F.greatest(2 * k, F.lit(1))) == p)
    turn = F.row_number().over(Window.partitionBy(*stratum).orderBy("centre_rank", "__e"))
    return j.withColumn("selected", F.when(k < n, spread).otherwise(turn <= k)).select(*df.columns, "selected")


def balanced_by_split(df: DataFrame, key: str, split: str, group: str, ratios: dict[str, float], most: int) -> DataFrame:
    """At most ``most`` rows: round(most * ratio) a split, groups in turn, the rest refilled likewise.

    The last split of ``ratios`` takes what the others leave; a half rounds to even.
    """
    if df.count() <= most:
        return df
    want = {s: round(most * r) for s, r in list(ratios.items())[:-1]}
    want[list(ratios)[-1]] = most - sum(want.values())
    quota = F.coalesce(*[F.when(F.col(split) == s, F.lit(n)) for s, n in want.items()], F.lit(0))
    p = ordering.positions(df, [split, group], [F.col(key)])
    w = Window.partitionBy(split).orderBy("i", group)
    first = p.where(F.col("i") < quota).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= quota).select(*df.columns)
    rest = ordering.round_robin(df.join(first.select(key), key, "left_anti").select(*df.columns), group, [F.col(key)], max(0, most - first.count()))
    return first.unionByName(rest.select(*df.columns))


def diagonal_pairs(a: DataFrame, b: DataFrame, size: int) -> DataFrame:
    """All pairs of ``a`` (i) and ``b`` (j, numbered below ``size``) by diagonal (j - i) mod size, then i.

    The diagonals are generated and ``b`` is looked up, so early cases cover both sides.
    """
    g = a.withColumn("diagonal", F.explode(F.sequence(F.lit(0), F.lit(size - 1)))).withColumn("j", (F.col("i") + F.col("diagonal")) % size)
    return g.join(b, "j")


def renumbered(base: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """``old, new``: ids of ``extra`` moved behind the largest id of ``base``, in digest order (H3)."""
    ids = extra.select(F.col(key).alias("old")).distinct().withColumn("__h", F.md5(F.col("old").cast("string").cast("binary")))
    top = base.agg(F.coalesce(F.max(key), F.lit(0)).alias("__top"))  # one row
    return ordering.numbered(ids, ["__h", "old"], "place").crossJoin(F.broadcast(top)).select("old", (F.col("__top") + F.col("place") + 1).cast("long").alias("new"))


def exclusion_issues(rows: DataFrame, decisions: DataFrame, key: str, split: str, group: str, reason: str) -> DataFrame:
    """Decisions that may not be applied: missing, not_train, no_reason, group_changed, repeated."""
    d = decisions.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(reason).alias("__reason"), F.min(group).alias("__group"))
    j = d.join(rows.select(key, split, group, F.lit(1).alias("__hit")), key, "left")
    issue = F.when(F.col("__hit").isNull(), "missing").when(F.col(split) != "train", "not_train").when(F.coalesce("__reason", F.lit("")) == "", "no_reason")
    issue = issue.when(~F.col(group).eqNullSafe(F.col("__group")), "group_changed").when(F.col("__n") > 1, "repeated")
    return j.select(key, issue.alias("issue")).where("issue is not null")


def excluded(rows: DataFrame, decisions: DataFrame, key: str, issues: DataFrame) -> DataFrame:
    """Rows without the decided ones; fails if a decision has an issue."""
    bad = issues.limit(5).collect()
    if bad:
        raise ValueError(f"exclusions that may not be applied: {[tuple(r) for r in bad]}")
    return rows.join(decisions.select(key).distinct(), key, "left_anti")


def receipt(df: DataFrame, columns: list[str]) -> DataFrame:
    """``rows, digest``: a checksum of the rows as a multiset.

    Two 60-bit sums of row digests are added up, so no task sees the rows in order; a repeated row
    counts twice.
    """
    h = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
    part = lambda i: F.conv(F.substring(h, i, 15), 16, 10).cast("decimal(38,0)")
    sums = df.select(part(1).alias("a"), part(16).alias("b")).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("a"), F.lit(0).cast("decimal(38,0)")).alias("a"), F.coalesce(F.sum("b"), F.lit(0).cast("decimal(38,0)")).alias("b"))
    return sums.select("rows", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), F.col("a").cast("string"), F.col("b").cast("string")), 256).alias("digest"))


def chain_issues(receipts: DataFrame) -> DataFrame:
    """Links of a chain of receipts (step, rows, digest, parent_rows, parent_digest) that do not fit the step before."""
    before = receipts.select((F.col("step") + 1).alias("step"), F.col("rows").alias("__rows"), F.col("digest").alias("__digest"))
    j = receipts.where("parent_digest is not null").join(before, "step", "left")
    issue = F.when(F.col("__digest").isNull(), "missing_parent").when(F.col("__digest") != F.col("parent_digest"), "digest").when(F.col("__rows") != F.col("parent_rows"), "rows")
    return j.select("step", issue.alias("issue")).where("issue is not null")


def gates_from(text: str) -> list[tuple[str, str, float, str]]:
    """Gates as data: a JSON list of objects column, operator, target, severity, in the order given."""
    out = [(g["column"], g["operator"], float(g["target"]), g.get("severity", "error")) for g in json.loads(text)]
    bad = [g for g in out if g[1] not in (">=", "<=", "=")]
    if bad:
        raise ValueError(f"unknown operator in gates {bad}")
    return out


def dispatched(profile: Column, registry: dict[str, Column]) -> Column:
    """The expression registered for the row's profile; an unknown profile is null."""
    out = None
    for name, expression in registry.items():
        out = F.when(profile == name, expression) if out is None else out.when(profile == name, expression)
    return out


def object_sizes(boxes: DataFrame, sizes: list[int], small: float = 32.0) -> DataFrame:
    """Boxes (cls, width, height of the frame; w, h) after fitting frames into squares, by size and class.

    A null class is the total over all classes. Sizes are exploded, not joined.
    """
    b = boxes.withColumn("target", F.explode(F.array(*[F.lit(s) for s in sizes])))
    scale = F.least(F.col("target") / F.col("width"), F.col("target") / F.col("height"))
    b = b.select("target", "cls", (F.col("w") * scale).alias("sw"), (F.col("h") * scale).alias("sh"))
    least = F.least("sw", "sh")
    sets = b.groupingSets([[F.col("target"), F.col("cls")], [F.col("target")]], F.col("target"), F.col("cls"))
    return sets.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("sw"), 6).alias("mean_width"), F.round(F.avg("sh"), 6).alias("mean_height"), F.round(F.min(least), 6).alias("least_side"), F.count_if(least < small).alias("n_small"))


def extents(points: DataFrame, keys: list[str], lon: str, lat: str) -> DataFrame:
    """Bounds, centre and the distance from the centre to the farthest corner."""
    g = points.groupBy(*keys).agg(F.min(lon).alias("west"), F.max(lon).alias("east"), F.min(lat).alias("south"), F.max(lat).alias("north"), F.count(F.lit(1)).alias("n"))
    g = g.withColumn("lon", (F.col("west") + F.col("east")) / 2).withColumn("lat", (F.col("south") + F.col("north")) / 2)
    return g.withColumn("radius_m", F.greatest(*[haversine(F.col("lon"), F.col("lat"), F.col(x), F.col(y)) for x in ("west", "east") for y in ("south", "north")]))


def coverage(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """(measure, value): how many rows meet each predicate, in one pass; ``rows`` counts all."""
    cells = [F.struct(F.lit("rows").alias("measure"), F.count(F.lit(1)).alias("value"))]
    cells += [F.struct(F.lit(k).alias("measure"), F.count_if(F.coalesce(v, F.lit(False))).alias("value")) for k, v in measures.items()]
    return df.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def neighbour_consensus(df: DataFrame, keys: list[str], order: list[Column], flag: Column) -> Column:
    """flag AND (the flag before OR the flag after) in its group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    near = F.coalesce(F.lag(flag).over(w), F.lit(False)) | F.coalesce(F.lead(flag).over(w), F.lit(False))
    return flag & near


def dilated(mask: Column, width: int) -> Column:
    """A flat row-major 0/1 mask grown by one cell on all eight sides."""
    n = F.size(mask)

    def cell(j: Column) -> Column:
        x = j % width
        near = [F.coalesce(F.when((x + dx).between(0, width - 1) & (j + dy * width + dx).between(0, n - 1), F.get(mask, j + dy * width + dx)), F.lit(0)) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
        return F.greatest(*near)

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), cell)).otherwise(mask)


def temporal_vote(keys: list[str], order: list[Column], flag: Column, reach: int, votes: int) -> Column:
    """Whether at least ``votes`` of the rows within ``reach`` places are flagged."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-reach, reach)
    return F.sum(flag.cast("int")).over(w) >= votes


def distances(df: DataFrame, keys: list[str], value: str, quantiles: list[float], limits: list[float]) -> DataFrame:
    """n, mean, interpolated quantiles and the share within each limit; null without values (M2, M9)."""
    v = F.col(value)
    out = [F.count(v).alias("n"), F.avg(v).alias("mean")]
    out += [F.percentile(v, q).alias(f"p{round(q * 100)}") for q in quantiles]
    out += [F.avg((v <= x).cast("int")).alias(f"within_{x:g}".replace(".", "_")) for x in limits]
    return df.groupBy(*keys).agg(*out)


def majority(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, ties to the smaller one."""
    c = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    return c.groupBy(*keys).agg(F.min(F.struct((-F.col("__n")).alias("m"), F.col(value).alias("v"))).alias("b")).select(*keys, F.col("b.v").alias("prior"))


def within_budget(df: DataFrame, keys: list[str], order: list[Column], size: str, budget: int) -> DataFrame:
    """Rows in order until the running size of their key passes the budget; the first over it stops the key."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("used", F.sum(size).over(w)).where(F.col("used") <= budget)


def date_class(df: DataFrame, stated: Column, derived: Column) -> DataFrame:
    """Whether a stated date is a constant of the export (L12): several rows, all with one valid
    stated date, while the dates derived from names are complete and vary."""
    g = df.agg(F.count(F.lit(1)).alias("rows"), F.count(stated).alias("stated"), F.countDistinct(stated).alias("stated_kinds"), F.count(derived).alias("derived"), F.countDistinct(derived).alias("derived_kinds"))
    proven = F.expr("rows > 1 AND stated = rows AND stated_kinds = 1 AND derived = rows AND derived_kinds > 1")
    return g.withColumn("classification", F.when(proven, "dataset_constant_export_metadata").otherwise("capture_metadata_not_ignorable"))


def first_seen(rows: DataFrame, key: str, order: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """The first row of each key over all landed result pages, with the sorted reasons against it."""
    from .relational import all_reasons

    seen = rows.groupBy(key).agg(F.min(F.struct(*order, *[c for c in rows.columns if c not in (key, *order)])).alias("__r"))
    return seen.select(key, "__r.*").withColumn("reasons", all_reasons(rules))
