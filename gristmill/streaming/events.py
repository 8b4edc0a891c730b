"""Structured Streaming operators (survey 2.O)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The events below ``path`` as a stream; event time is cast for the watermark."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type, late rows dropped beyond the watermark."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    g = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def session_windows(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Gap sessions of each user."""
    g = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def monotone(steps: DataFrame, key: str = "metric", step: str = "step", value: str = "value") -> DataFrame:
    """Forward a row only if its step is above the last one forwarded for its key (O2, O3).

    A key's rows of a micro-batch meet in one task; ``forwarded`` deals them by step.
    """

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for r in pd.concat(list(batches)).sort_values([step, value]).itertuples():
            s = int(getattr(r, step))
            if last is None or s > last:
                last = s
                out.append((k[0], s, float(getattr(r, value))))
        if last is not None:
            state.update((last,))
        yield pd.DataFrame(out, columns=[key, step, value])

    return steps.groupBy(key).applyInPandasWithState(run, f"{key} string, {step} long, {value} double", "last long", "append", GroupStateTimeout.NoTimeout)


def forwarded(stream: DataFrame, path: str, checkpoint: str, key: str = "metric", step: str = "step", value: str = "value") -> StreamingQuery:
    """``monotone`` for keys of any size (O2, O3): of each step above the key's last one the least value.

    A micro-batch's rows are combined by key and step before they are dealt, and stand in a folder of
    their own; a repeated batch replaces them. The last steps, a row a key, are carried from batch to
    batch. A missing step counts as the lowest one. ``sent`` reads the rows.
    """

    def forward(batch: DataFrame, number: int) -> None:
        spark, at = batch.sparkSession, f"{path}/last/batch={number}"
        rows = batch.groupBy(key, step).agg(F.min(value).alias(value))
        if number:
            earlier = spark.read.schema(rows.schema).parquet(f"{path}/rows/batch={number - 1}").select(key, step)
            if number > 1:
                earlier = earlier.union(spark.read.schema(earlier.schema).parquet(f"{path}/last/batch={number - 1}"))
            last = earlier.groupBy(key).agg(F.max(step).alias(step))
            last.write.mode("overwrite").parquet(at)
            last = spark.read.schema(last.schema).parquet(at).toDF("__key", "__last")
            rows = rows.join(last, F.col(key).eqNullSafe(F.col("__key")) & (F.col(step).isNull() | (F.col(step) <= F.col("__last"))), "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    return stream.writeStream.foreachBatch(forward).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sent(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``forwarded`` has let through so far."""
    return spark.read.parquet(f"{path}/rows").drop("batch")


def parsed_log(lines: DataFrame) -> DataFrame:
    """``metric, step, value`` of complete log lines such as ``step=3 loss=0.25``."""
    pattern = r"^step=(\d+) (\w+)=(-?[0-9.eE+-]+)$"
    hit = lines.where(F.col("value").rlike(pattern))
    get = lambda i: F.regexp_extract("value", pattern, i)
    return hit.select(get(2).alias("metric"), get(1).cast("long").alias("step"), F.expr(f"try_cast(regexp_extract(value, '{pattern}', 3) AS double)".replace("\\", "\\\\")).alias("value")).where("value is not null and not isnan(value)")


def accumulated(stream: DataFrame, keys: list[str], sums: dict[str, Column], path: str, checkpoint: str) -> StreamingQuery:
    """Partial metrics of every micro-batch in a folder of its own (O5); a repeated batch replaces its
    partials. ``total`` adds them up at the end, deleting ``path`` starts anew."""

    def update(batch: DataFrame, number: int) -> None:
        part = batch.groupBy(*keys).agg(*[F.sum(c).alias(k) for k, c in sums.items()])
        part.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def total(spark: SparkSession, keys: list[str], sums: list[str], path: str) -> DataFrame:
    """The metrics over all partials written so far."""
    return spark.read.parquet(path).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def resumable(stream: DataFrame, key: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows whose key is not yet in the sink; replays add nothing."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        try:
            seen = spark.read.parquet(path).select(key)
            fresh = fresh.join(seen, key, "left_anti")
        except Exception as e:  # the sink has no file yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
