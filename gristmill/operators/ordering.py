"""Window-style operators, picks and quotas (survey 2.F, 2.G, 2.K)."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sessions(df: DataFrame, key: str, ts: str, gap_s: int, tie: str) -> DataFrame:
    """Gap sessions: a new one when the gap exceeds ``gap_s``; id is its start, number its order (F1, F2)."""
    w = Window.partitionBy(key).orderBy(ts, tie)
    seconds = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = seconds - F.lag(seconds).over(w)
    df = df.withColumn("__new", F.when(gap.isNull() | (gap > gap_s * 1_000_000), 1).otherwise(0))
    df = df.withColumn("episode", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__new")
    return df.withColumn("session_start", F.min(ts).over(Window.partitionBy(key, "episode")))


def positions(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Zero-based place ``i`` and size ``n`` of each row's group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("i", F.row_number().over(w).cast("long") - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int | Column) -> DataFrame:
    """The first k rows of each key; k may be a column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def centre_out(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rank by distance from the middle of the group, then by place."""
    p = positions(df, keys, order)
    w = Window.partitionBy(*keys).orderBy(F.abs(F.col("i") - (F.col("n") - 1) / 2), "i")
    return p.withColumn("centre_rank", F.row_number().over(w).cast("long"))


def quantile_picks(df: DataFrame, keys: list[str], order: list[Column], quantiles: list[float]) -> DataFrame:
    """Rows at round-half-even(q * (n - 1)) of each group, each once."""
    p = positions(df, keys, order)
    want = F.array(*[F.bround(F.lit(q) * (F.col("n") - 1)).cast("long") for q in quantiles])
    return p.where(F.array_contains(want, F.col("i")))


def even_picks(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """At most k rows a group at floor((2j + 1) n / 2k)."""
    p = positions(df, keys, order)
    want = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.floor((2 * j + 1) * F.col("n") / (2 * k)).cast("long"))
    return p.where((F.col("n") <= k) | F.array_contains(want, F.col("i")))


def thinned(df: DataFrame, key: str, ts: str, tie: str, least_s: float) -> DataFrame:
    """Keep a row if it is at least ``least_s`` after the last kept row of its key.

    The state is the last kept row, which no window frame expresses; each key is one ordered run.
    """
    schema = df.schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([ts, tie])
        t, last, keep = pdf[ts].astype("int64").to_numpy() // 1000, None, []
        for x in t:
            ok = last is None or x - last >= least_s * 1_000_000
            last = x if ok else last
            keep.append(ok)
        return pdf[keep]

    return df.groupBy(key).applyInPandas(run, schema)


def round_robin(df: DataFrame, group: str, order: list[Column], limit: int) -> DataFrame:
    """Index k of every group in turn, up to ``limit`` rows."""
    p = positions(df, [group], order)
    return p.orderBy("i", group).limit(limit)


def proportional_quota(counts: DataFrame, key: str, n: str, budget: int) -> DataFrame:
    """Highest-averages seats n/(q + 1), at least one each, never above n, ties by key."""
    seats = counts.select(key, F.explode(F.sequence(F.lit(1), F.least(F.col(n), F.lit(budget)).cast("int"))).alias("q"), n)
    first = F.when(F.col("q") == 1, 0).otherwise(1)
    ranked = seats.select(key, "q", first.alias("f"), (F.col(n) / F.col("q")).alias("p")).orderBy("f", F.desc("p"), key).limit(budget)
    return ranked.groupBy(key).agg(F.count(F.lit(1)).alias("quota"))


def repeated(df: DataFrame, extra: Column) -> DataFrame:
    """Each row, and ``extra`` more copies numbered from 1."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), extra.cast("int"))))


def rank_split(groups: DataFrame, key: str, train: float = 0.8, validation: float = 0.9) -> DataFrame:
    """Groups sorted by sha256 and cut at floor(share * n) (K7).

    The groups are numbered by range partitions and offsets, not in one task.
    """
    g = groups.select(key).distinct().withColumn("h", F.sha2(F.col(key).cast("string"), 256))
    g = numbered(g, ["h", key], "i")
    total = g.agg(F.count(F.lit(1)).alias("n"))
    j = g.crossJoin(F.broadcast(total))  # one row
    return j.select(key, F.when(F.col("i") < F.floor(F.col("n") * train), "train").when(F.col("i") < F.floor(F.col("n") * validation), "validation").otherwise("test").alias("split"))


def numbered(df: DataFrame, order: list[str], name: str, digits: int = 3) -> DataFrame:
    """Global zero-based numbers in the order of ``order``, whose first column is a hex digest.

    Buckets of the digest's first ``digits`` hex digits are numbered apart and shifted by the
    sizes of the buckets before them.
    """
    b = df.withColumn("__b", F.substring(order[0], 1, digits))
    sizes = b.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__at", F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))  # 16**digits rows at most
    w = Window.partitionBy("__b").orderBy(*order)
    j = b.withColumn("__i", F.row_number().over(w)).join(F.broadcast(before), "__b")
    return j.withColumn(name, (F.col("__i") - 1 + F.coalesce("__at", F.lit(0))).cast("long")).drop("__b", "__i", "__n", "__at")


def chronological_cut(groups: DataFrame, key: str, first: str, n: str, train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """The two boundaries in time order that best meet the shares.

    ``groups`` is the small table of groups with their sizes. For a first boundary the cost is a
    parabola in the second one's prefix sum, so the sums beside its vertex are the ones to try.
    """
    kind = dict(groups.dtypes)[key]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([first, key])
        c = pdf[n].cumsum().to_numpy(np.float64)
        t, best, test = c[-1], None, 1 - train - validation
        for i in range(len(c) - 1):
            vertex = (t * (1 + validation - test) + c[i]) / 2
            for j in {np.searchsorted(c, vertex) - 1, np.searchsorted(c, vertex), i + 1, np.searchsorted(c, t) - 1}:
                if i < j < len(c) and c[j] < t:
                    cost = (c[i] / t - train) ** 2 + ((c[j] - c[i]) / t - validation) ** 2 + ((t - c[j]) / t - test) ** 2
                    best = min(best or (np.inf,), (round(cost, 12), i, int(j)))
        if best is None:
            return pd.DataFrame({key: [], "split": []})
        at = np.arange(len(c))
        return pd.DataFrame({key: pdf[key], "split": np.where(at <= best[1], "train", np.where(at <= best[2], "validation", "test"))})

    one = groups.select(key, F.col(first), F.col(n).cast("long").alias(n), F.lit(0).alias("__one"))
    return one.groupBy("__one").applyInPandas(lambda pdf: run(pdf.drop(columns="__one")), f"{key} {kind}, split string")


def greedy_fill(groups: DataFrame, key: str, n: str, targets: dict[str, float]) -> DataFrame:
    """Largest group first into the split with the least filled share.

    A sequential choice over the table of groups, not over their rows; one task holds ids and sizes.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([n, key], ascending=[False, True])
        filled, out = {s: 0.0 for s in targets}, []
        for size in pdf[n]:
            s = min(targets, key=lambda s: (filled[s] / targets[s], list(targets).index(s)))
            filled[s] += size
            out.append(s)
        return pd.DataFrame({key: pdf[key], "split": out})

    kind = dict(groups.dtypes)[key]
    return groups.select(key, n, F.lit(0).alias("__one")).groupBy("__one").applyInPandas(lambda pdf: run(pdf.drop(columns="__one")), f"{key} {kind}, split string")


#: Chances of at most 0, 1, 2, ... events of a Poisson variable with mean 1.
POISSON = tuple(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(9))


def bootstrap(df: DataFrame, key: str, value: str, rounds: int, seed: int) -> DataFrame:
    """``round, statistic``: the mean of each Poisson resample, one row a round.

    A row's weight in a round is drawn by a hash of seed, round and key, so no task needs the
    whole column and a retried one draws the same; with a cluster's key all its rows are drawn
    together. Sums are combined before the shuffle.
    """
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col("round").cast("string"), F.col(key).cast("string")).cast("binary")), 1, 8)
    u = F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)
    weight = sum((F.when(u >= p, 1).otherwise(0) for p in POISSON), F.lit(0))
    rows = df.where(F.col(value).isNotNull()).select(F.col(key), F.col(value).cast("double").alias("v"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"))
    return rows.select("round", "v", weight.alias("w")).groupBy("round").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("statistic"))


def spatial_holdout(df: DataFrame, x: str, cell: Column, share: float = 0.2) -> DataFrame:
    """(cell, split): the western share of the cells by mean x validates, the eastern share tests.

    Cells are ranked in one small table, not their rows.
    """
    cells = df.groupBy(cell.alias("cell")).agg(F.avg(x).alias("mx"))
    w = Window.orderBy("mx", "cell")
    i, n = F.row_number().over(w) - 1, F.count(F.lit(1)).over(Window.partitionBy())
    cells = cells.select("cell", i.alias("i"), n.alias("n"))
    cut = F.floor(F.col("n") * share)
    return cells.select("cell", F.when(F.col("i") < cut, "validation").when(F.col("i") >= F.col("n") - cut, "test").otherwise("train").alias("split"))


def farthest_picks(df: DataFrame, keys: list[str], first: list[Column], distance: Callable[[Column], Column], feature: str, tie: str, k: int) -> DataFrame:
    """The first row in order, then the k - 1 rows farthest from it.

    The distance is to the first pick only, so a window value and a rank are enough.
    """
    w = Window.partitionBy(*keys).orderBy(*first)
    seed = F.first_value(feature).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    d = df.withColumn("__n", F.row_number().over(w)).withColumn("__d", F.when(F.col("__n") == 1, F.lit(float("inf"))).otherwise(distance(seed)))
    return top_per_key(d, keys, [F.desc("__d"), F.col(tie)], k).drop("__n", "__d")
