import math

import duckdb
import pytest
from pyspark.sql import functions as F

from gristmill import plans
from gristmill.operators import ordering
from gristmill.streaming import events


def drained(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def split_files(spark, sf, path, n=3):
    spark.read.parquet(f"{sf}/events.parquet").orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 400).parquet(path)
    return spark.read.parquet(path)


def test_windows_match_batch(spark, sf, tmp_path):
    batch = split_files(spark, sf, f"{tmp_path}/e")
    got = drained(events.tumbling(events.event_stream(spark, f"{tmp_path}/e"), late="40 days"), "tumbling", "complete")
    want = batch.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), "event_type").count()
    assert {(r.start, r.event_type): r.n for r in got.collect()} == {(r.w.start, r.event_type): r["count"] for r in want.collect()}
    sliding = drained(events.tumbling(events.event_stream(spark, f"{tmp_path}/e"), "2 hours", "1 hour", "40 days"), "sliding", "complete")
    assert sliding.agg(F.sum("n")).first()[0] == 2 * batch.count()


def test_sessions_close_behind_the_watermark(spark, sf, tmp_path):
    batch = split_files(spark, sf, f"{tmp_path}/e")
    got = {(r.user_id, r.start.timestamp()) for r in drained(events.session_windows(events.event_stream(spark, f"{tmp_path}/e"), late="40 days"), "sessions").collect()}
    want = {(r.user_id, r.s) for r in ordering.sessions(batch, "user_id", "ts", 1800, "event_id").select("user_id", F.unix_micros(F.col("session_start").cast("timestamp")).alias("s")).distinct().selectExpr("user_id", "s / 1000000.0 AS s").collect()}
    assert {(u, round(float(s), 3)) for u, s in got} <= {(u, round(float(s), 3)) for u, s in want}


def test_monotone_and_log(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log/1.txt").write_text("step=1 loss=0.5\nnoise\nstep=2 loss=0.4\nstep=2 loss=0.3\nstep=1 acc=0.1\nstep=3 loss=NaN\n")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp_path}/log")
    first = drained(events.monotone(events.parsed_log(lines)), "steps").collect()
    assert sorted((r.metric, r.step) for r in first) == [("acc", 1), ("loss", 1), ("loss", 2)]


BATCHES = [
    [("a", 3, 0.5), ("a", 1, 0.2), ("a", 3, 0.4), ("a", None, 0.7), ("b", 9, math.nan), (None, 4, 1.0)],
    [("a", 3, 0.1), ("a", 5, 0.9), ("a", None, 0.1), ("b", 9, 0.3), ("c", None, 2.0), (None, 2, 0.0), (None, 6, 0.5)],
    [("a", 4, 0.1), ("b", 10, None), ("b", 10, 0.8), ("c", None, 1.0), ("c", 0, 3.0), (None, 6, 0.1)],
    [("a", 5, 0.0), ("a", 6, 0.6), ("c", 0, 1.0), ("c", -1, 1.0)],
]


def one_by_one(batches):
    """Rows in order of batch, step and value; a missing step is the lowest, a missing value the last."""
    last, out = {}, []
    order = lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] is None, r[2] is not None and math.isnan(r[2]), r[2] or 0)
    for batch in batches:
        for k, s, v in sorted(batch, key=order):
            if k not in last or (s is not None and (last[k] is None or s > last[k])):
                last[k] = s
                out.append((k, s, v))
    return out


@pytest.mark.parametrize("limit", ["1", "-1"])
def test_forwarded_over_batches(spark, tmp_path, limit):
    src, out, ck = (f"{tmp_path}/{x}" for x in ("in", "out", "ck"))
    schema = "metric string, step long, value double"
    spark.createDataFrame([], schema).write.parquet(src)

    def run():
        events.forwarded(spark.readStream.schema(schema).parquet(src), out, ck).awaitTermination()
        return sorted(map(repr, map(tuple, events.sent(spark, out).collect())))

    if limit == "1":  # a micro-batch after the other, each of them run again as after a crash before its commit
        assert run() == []
        for n, batch in enumerate(BATCHES, 1):
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
            once = run()
            for f in (f"{n}", f".{n}.crc"):
                (tmp_path / "ck/commits" / f).unlink(missing_ok=True)
            assert run() == once == sorted(map(repr, one_by_one(BATCHES[:n])))
        assert run() == once  # no new rows
    else:
        for batch in BATCHES:
            spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        assert run() == sorted(map(repr, one_by_one([sum(BATCHES, [])])))


def test_forwarded_equals_monotone(spark, tmp_path):
    schema, src = "metric string, step long, value double", f"{tmp_path}/in"
    for n in range(4):
        rows = [(f"m{i % 3}", (i * 7919 + n * 31) % 40 + n * 10, float((i * 31 + n) % 17)) for i in range(200)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    want = drained(events.monotone(stream), "monotone").collect()
    events.forwarded(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert sorted(map(tuple, events.sent(spark, f"{tmp_path}/out").collect())) == sorted(map(tuple, want))


def odd_events(spark, path, one_file):
    rows = [(i, None if i % 11 == 0 else i % 40, None if i % 40 == 7 or i % 13 == 0 else math.nan if i % 40 == 9 or i % 17 == 0 else (i * 7919 % 1000) / 8 - 50) for i in range(2000)]
    spark.createDataFrame(rows, "event_id long, user_id long, value double").coalesce(1 if one_file else 4).write.parquet(f"{path}/parts")
    if one_file:
        next((path / "parts").glob("*.parquet")).rename(path / "events.parquet")
    else:
        (path / "parts").rename(path / "events.parquet")
    return f"'{path}/events.parquet{'' if one_file else '/*.parquet'}'"


@pytest.mark.parametrize("one_file", [True, False])
def test_monotone_steps_of_odd_events(spark, tmp_path, one_file):
    table = odd_events(spark, tmp_path, one_file)
    got = plans.queries()["monotone_steps"](spark, str(tmp_path))
    want = duckdb.sql(f"WITH events AS (FROM {table}) {plans.oracle_sql()['monotone_steps']}").fetchall()
    assert sorted(map(repr, map(tuple, got.select("step", "value").collect()))) == sorted(map(repr, want))
    assert any(r[0] is None for r in want) and any(r[1] is None for r in want) and "nan" in repr(want)


def test_monotone_steps_in_more_than_one_task(spark, sf):
    """All rows are of one metric: dealt by it alone, one task would hold them all."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = plans.queries()["monotone_steps"](spark, sf)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = got.groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < got.count() / 2


def test_resumable_ingest(spark, tmp_path):
    src, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, v string").write.parquet(src)
    for k in (1, 2):  # the second run has a new checkpoint and meets every row again
        stream = spark.readStream.schema("id long, v string").parquet(src)
        events.resumable(stream, "id", sink, f"{tmp_path}/ck{k}").awaitTermination(120)
        spark.createDataFrame([(3, "c"), (1, "a")], "id long, v string").write.mode("append").parquet(src)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [1, 2, 3]
