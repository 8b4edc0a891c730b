"""Deduplication, gates and metrics (survey 2.E, 2.I, 2.L, 2.M)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .graph import connected_components


#: Edges that one task decides in order at most.
FEW_EDGES = 1_000_000


def greedy_independent(nodes: DataFrame, edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """Greedy near-duplicate removal in order of id: a row goes if it is near an accepted earlier
    row, and only then (I3, I4, I5).

    ``nodes``: id; ``edges``: early < late. Each round rejects the later neighbours of rows that no
    undecided row comes before, and drops the edges of rejected rows; what is left when there are
    ``few`` edges is decided in order by one task. The result is that of the sequential pass.
    """

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone: set[int] = set()
        for b in batches:  # sorted by late: what is earlier is decided
            for early, late in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if early not in gone:
                    gone.add(late)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(gone), pa.int64())], names=["id"])

    known = nodes.select(F.col("id").alias("early"))
    e = written(edges.select(F.col("early").cast("long"), F.col("late").cast("long")).where("early < late").join(known, "early", "left_semi"), "edges")
    rejected = e.select(F.col("late").alias("id")).limit(0)
    while (count := e.count()) > few:
        heads = e.join(e.select(F.col("late").alias("early")).distinct(), "early", "left_anti")
        gone = written(heads.select(F.col("late").alias("id")).distinct(), "rejected")
        rejected = rejected.unionAll(gone)
        e = written(e.join(gone.toDF("late"), "late", "left_anti").join(gone.toDF("early"), "early", "left_anti").select("early", "late"), "edges")
    if count:
        rejected = rejected.unionAll(e.repartition(1).sortWithinPartitions("late").mapInArrow(in_order, "id long"))
    return nodes.select("id").join(rejected, "id", "left_anti")


def keep_one_of_components(units: DataFrame, near: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows to exclude so that one row of each near component that crosses splits stays.

    units: unit, cls, split (one for each signature class and split); near: a, b (classes within
    the radius, either way round); rows: id, unit, rank. Only units of different splits are linked; of a component
    the row with the least (rank, id) stays. No pair of rows is made: a class has a unit a split.
    """
    x, y = (units.toDF(f"u{s}", f"c{s}", f"s{s}") for s in "xy")
    apart = F.col("sx") != F.col("sy")
    across = near.join(x, F.col("a") == F.col("cx")).join(y, F.col("b") == F.col("cy")).where(apart).select("ux", "uy")
    within = x.join(y, F.col("cx") == F.col("cy")).where(apart & (F.col("ux") < F.col("uy"))).select("ux", "uy")
    found = connected_components(across.unionAll(within), "ux", "uy").select(F.col("node").alias("unit"), "component")
    members = written(rows.join(found, "unit"), "members")
    kept = members.groupBy("component").agg(F.min(F.struct("rank", "id")).alias("keep"))
    return members.join(kept, "component").where(F.col("id") != F.col("keep.id")).select("id")


def issue_log(checks: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """``check, severity, subject`` of every finding: the union of checks (name, severity, rows with
    ``subject``), which stay apart so that one failing check hides no other (L4)."""
    out = None
    for name, severity, rows in checks:
        part = rows.select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.col("subject").cast("string").alias("subject"))
        out = part if out is None else out.unionAll(part)
    return out


def gate_table(actuals: DataFrame, gates: list[tuple[str, str, float, str]]) -> DataFrame:
    """(gate, actual, operator, target, severity, passed) from a one-row table.

    gates: (column, operator, target, severity); a null actual fails.
    """
    ops = {">=": lambda a, t: a >= t, "<=": lambda a, t: a <= t, "=": lambda a, t: a == t}
    rows = [
        F.struct(F.lit(c).alias("gate"), F.col(c).cast("double").alias("actual"), F.lit(op).alias("operator"), F.lit(float(t)).alias("target"), F.lit(sev).alias("severity"), F.coalesce(ops[op](F.col(c).cast("double"), F.lit(float(t))), F.lit(False)).alias("passed"))
        for c, op, t, sev in gates
    ]
    return actuals.select(F.inline(F.array(*rows)))


def leakage(df: DataFrame, group: str, split: str) -> DataFrame:
    """Groups that lie in more than one split."""
    return df.groupBy(group).agg(F.array_sort(F.collect_set(split)).alias("splits")).where(F.size("splits") > 1)


def shares(df: DataFrame, key: str) -> DataFrame:
    """Rows and share of each value of ``key``."""
    c = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = c.agg(F.sum("n").alias("__t"))
    return c.crossJoin(F.broadcast(total)).select(key, "n", (F.col("n") / F.col("__t")).alias("share"))


def ratio(num: Column, den: Column, style: str = "zero") -> Column:
    """The three guards of a ratio: zero, max1 (den at least 1) or null."""
    if style == "max1":
        return num / F.greatest(F.lit(1), den)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0) if style == "zero" else F.lit(None).cast("double"))


def confusion(df: DataFrame, truth: Column, predicted: Column, keys: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 by group."""
    g = df.groupBy(*(keys or [])).agg(F.count_if(truth & predicted).alias("tp"), F.count_if(~truth & predicted).alias("fp"), F.count_if(truth & ~predicted).alias("fn"), F.count_if(~truth & ~predicted).alias("tn"))
    g = g.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return g.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def sweep(df: DataFrame, score: str, truth: Column, thresholds: list[float]) -> DataFrame:
    """The confusion at each threshold; one pass, no copy of the rows (M3)."""
    cells = []
    for t in thresholds:
        hit = F.col(score) >= t
        cells.append(F.struct(F.lit(t).alias("threshold"), F.count_if(truth & hit).alias("tp"), F.count_if(~truth & hit).alias("fp"), F.count_if(truth & ~hit).alias("fn")))
    g = df.agg(F.array(*cells).alias("a")).select(F.inline("a"))
    g = g.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return g.withColumn("f1", F.round(ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), 12))


def pick_threshold(swept: DataFrame) -> DataFrame:
    """The row with the largest (f1, recall, -threshold) (M3)."""
    return swept.orderBy(F.desc("f1"), F.desc("recall"), "threshold").limit(1)


def average_precision(df: DataFrame, score: str, truth: Column, tie: str) -> DataFrame:
    """Area under the monotone precision-recall curve of one class (M4, for ranked retrieval).

    Rows are ranked within ranges of the score, cut at its quantiles; what lies before a range (its
    ranks and hits) and after it (the best precision) comes from a table with a row a range.
    """
    rows = df.select(truth.cast("int").alias("y"), F.col(score).alias("score"), F.col(tie).alias("tie"))
    parts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted(set(rows.agg(F.percentile_approx("score", [i / parts for i in range(1, parts)], 10_000).alias("q")).first().q or []))
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<double>"), lambda c: c > F.col("score")))
    rows = rows.withColumn("bucket", bucket)
    w = Window.partitionBy("bucket").orderBy(F.desc("score"), "tie")
    order = Window.orderBy("bucket")  # of a table with a row a range
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("hits").over(before), F.lit(0)).alias("tp0"), F.sum("hits").over(Window.partitionBy()).alias("all"))
    r = rows.withColumn("k", F.row_number().over(w)).withColumn("tp", F.sum("y").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = r.join(F.broadcast(sizes), "bucket").withColumn("precision", (F.col("tp0") + F.col("tp")) / (F.col("n0") + F.col("k")))
    tops = r.groupBy("bucket").agg(F.max("precision").alias("top"))
    later = tops.select("bucket", F.coalesce(F.max("top").over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0.0)).alias("later"))
    r = r.withColumn("best", F.max("precision").over(w.rowsBetween(0, Window.unboundedFollowing))).where("y = 1").join(F.broadcast(later), "bucket")
    return r.agg(F.round(F.sum(F.greatest("best", "later") / F.col("all")), 9).alias("average_precision"))
