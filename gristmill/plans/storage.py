"""Queries that write through a sink, read back through a reader, and compare with plain SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality
from ..session import scratch_dir, written
from ..sources import files, sinks
from ..streaming import events as streaming
from ..tables import load
from .curation import query


def _text(df, spark) -> str:
    path = f"{scratch_dir(spark)}/text"
    df.write.text(path)
    return path


@query("SELECT doc_id, lang, source, n_chars::BIGINT AS n_chars FROM documents")
def jsonl_round_trip(spark, d):
    """Rows as canonical JSON lines and strictly back."""
    path = f"{scratch_dir(spark)}/lines"
    sinks.write_jsonl(load(spark, d, "documents").select("doc_id", "lang", "source", F.col("n_chars").cast("long").alias("n_chars")), path, "doc_id")
    return files.jsonl_strict(spark, path, "doc_id long, lang string, source string, n_chars long")


@query("SELECT CASE WHEN doc_id % 50 = 0 THEN 'finding' ELSE 'row' END AS kind, count(*) AS n, sum(CASE WHEN doc_id % 50 = 0 THEN 0 ELSE doc_id END)::BIGINT AS ids FROM documents GROUP BY 1")
def jsonl_findings(spark, d):
    """A2, A3: bad lines become findings, blank ones are skipped."""
    line = F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("{not json "), "doc_id")).when(F.col("doc_id") % 7 == 0, F.concat(F.to_json(F.struct("doc_id")), F.lit("\n"))).otherwise(F.to_json(F.struct("doc_id")))
    rows, bad = files.jsonl_recording(spark, _text(load(spark, d, "documents").select(line), spark), T.StructType([T.StructField("doc_id", T.LongType())]))
    found = rows.select(F.lit("row").alias("kind"), "doc_id").unionAll(bad.select(F.lit("finding"), F.lit(0).cast("long")))
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@query("SELECT n_nationkey::BIGINT AS id, n_name AS name, n_regionkey::BIGINT AS region FROM nation")
def json_document(spark, d):
    """A4: one object in a file of its own."""
    n = load(spark, d, "nation").agg(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("rows"))
    doc = files.json_document(spark, _text(n.select(F.to_json(F.struct("rows"))), spark))
    return doc.select(F.inline("rows")).select(F.col("id").cast("long").alias("id"), "name", F.col("region").cast("long").alias("region"))


@query("SELECT n_nationkey::BIGINT AS id, n_name AS file_name, count(s_suppkey) AS boxes, coalesce(sum(s_suppkey), 0)::BIGINT AS ids FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL")
def detection_document(spark, d):
    """A detection document is written as one object and read as three tables."""
    images = load(spark, d, "nation").select(F.lit(0).alias("k"), F.struct(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("file_name"), F.lit(9).alias("width"), F.lit(9).alias("height")).alias("i"))
    boxes = load(spark, d, "supplier").select(F.lit(0).alias("k"), F.struct(F.col("s_suppkey").cast("long").alias("id"), F.col("s_nationkey").cast("long").alias("image_id"), F.lit(1).alias("category_id"), F.array(*[F.lit(float(x)) for x in range(4)]).alias("bbox")).alias("a"))
    doc = images.groupBy("k").agg(F.collect_list("i").alias("images")).join(boxes.groupBy("k").agg(F.collect_list("a").alias("annotations")), "k")
    doc = doc.select(F.to_json(F.struct("images", "annotations", F.array(F.struct(F.lit(1).alias("id"), F.lit("one").alias("name"))).alias("categories"))))
    found, _, _ = files.coco(spark, _text(doc, spark))
    ids = F.coalesce("annotations", F.array().cast("array<struct<id: bigint, category_id: int, bbox: array<double>>>"))
    return found.select("id", "file_name", F.size(ids).cast("long").alias("boxes"), F.aggregate(ids, F.lit(0).cast("long"), lambda s, x: s + x["id"]).alias("ids"))


@query("SELECT count(*) AS n, count(*) AS places, sum(o_orderkey)::BIGINT AS ids, (SELECT count(DISTINCT o_orderkey) FROM orders) AS keys FROM orders")
def parquet_places(spark, d):
    """Projected rows, each at one (file, row); keys unique; rows as many as pinned."""
    path = f"{d.rstrip('/')}/orders.parquet"
    rows = written(files.parquet_by_position(spark, path, ["o_orderkey"]), "places")
    files.unique_or_fail(rows, "o_orderkey")
    again = files.parquet_by_position(spark, path, ["o_orderkey"], rows.select("file", "row"))
    files.expect_rows(again, rows.count())
    return again.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file", "row").alias("places"), F.sum("o_orderkey").cast("long").alias("ids"), F.countDistinct("o_orderkey").alias("keys"))


@query("SELECT c_custkey::BIGINT AS c_custkey, c_name, c_nationkey::INT AS c_nationkey FROM customer WHERE sha256(c_name) IN (SELECT sha256(c_name) FROM customer WHERE c_custkey % 3 = 0)")
def csv_members(spark, d):
    """Gzip CSV in a code page, filtered by a set of hashes."""
    c = load(spark, d, "customer")
    path = f"{scratch_dir(spark)}/csv"
    c.select("c_custkey", "c_name", "c_nationkey").write.option("header", True).option("compression", "gzip").option("encoding", "ISO-8859-1").csv(path)
    hashes = files.hash_set(spark, _text(c.where("c_custkey % 3 = 0").select(F.upper(F.sha2("c_name", 256))), spark))
    rows = files.csv_table(spark, path, "c_custkey long, c_name string, c_nationkey int", "ISO-8859-1")
    return rows.join(hashes, F.sha2("c_name", 256) == F.col("hash"), "left_semi")


@query("SELECT doc_id::VARCHAR || '.txt' AS member, strlen(coalesce(text, ''))::BIGINT AS size, sha256(coalesce(text, '')) AS sha256 FROM documents")
def archive_round_trip(spark, d):
    """Documents in zip shards of bounded size, and their members again."""
    docs = load(spark, d, "documents").select("doc_id", F.expr("doc_id div 512").alias("part"), F.coalesce("text", F.lit("")).alias("text")).withColumn("size", F.octet_length("text"))
    shards = sinks.byte_shards(docs, "part", "doc_id", "size", 1 << 20)
    named = shards.select(F.concat_ws("-", "part", "shard").alias("shard"), F.concat("doc_id", F.lit(".txt")).alias("member"), "text")
    zips = written(sinks.zip_archives(named, "shard", "member", "text"), "zips")
    return files.members_of(zips.select(F.col("shard").alias("path"), F.col("archive").alias("content"))).select("member", "size", F.sha2("content", 256).alias("sha256"))


@query("""WITH RECURSIVE o AS MATERIALIZED (SELECT source, doc_id, n_chars + 4096 AS need, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
r AS (SELECT source, doc_id, rn, need AS used, 0 AS shard FROM o WHERE rn = 1 UNION ALL
SELECT o.source, o.doc_id, o.rn, CASE WHEN r.used + o.need > 100000 THEN o.need ELSE r.used + o.need END, CASE WHEN r.used + o.need > 100000 THEN r.shard + 1 ELSE r.shard END FROM r JOIN o ON o.source = r.source AND o.rn = r.rn + 1)
SELECT source, doc_id, shard::BIGINT AS shard FROM r""")
def byte_shards(spark, d):
    """Next-fit shard numbers under a byte budget."""
    return sinks.byte_shards(load(spark, d, "documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", 100_000).select("source", "doc_id", "shard")


@query("SELECT sha256(string_agg(r_name, chr(10) ORDER BY r_name) || chr(10)) AS sha256, (sum(strlen(r_name)) + count(*))::BIGINT AS length FROM region")
def file_inventory(spark, d):
    """Files with length and digest; one found by its name."""
    path = _text(load(spark, d, "region").select("r_name").coalesce(1).sortWithinPartitions("r_name"), spark)
    found = files.inventory(spark, path, "part-*").where("length > 0")
    name = found.select(F.element_at(F.split("path", "/"), -1)).first()[0]
    return files.inventory(spark, files.find_unique(spark, path, name)).select("sha256", "length")


@query("SELECT n_nationkey::INT AS feature, 'Point' AS kind, n_nationkey / 2.0 AS lon, -n_regionkey::DOUBLE AS lat FROM nation")
def geojson_points(spark, d):
    """Vertices of features."""
    f = F.struct(F.struct(F.col("n_name").alias("name")).alias("properties"), F.struct(F.lit("Point").alias("type"), F.array(F.col("n_nationkey") / 2.0, -F.col("n_regionkey").cast("double")).alias("coordinates")).alias("geometry"))
    n = load(spark, d, "nation").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", f.alias("f")))).alias("x"))
    doc = n.select(F.to_json(F.struct(F.transform("x", lambda x: x["f"]).alias("features"))))
    return files.geojson_points(spark, _text(doc, spark)).select("feature", "kind", "lon", "lat")


@query("SELECT doc_id, coalesce(CASE toxic WHEN 1 THEN 'reject' WHEN 0 THEN 'accept' END, 'unreviewed') AS decision, count(*) OVER () AS total FROM documents LEFT JOIN labels USING (doc_id) QUALIFY decision = 'accept' AND row_number() OVER (PARTITION BY decision ORDER BY doc_id) BETWEEN 11 AND 30".replace("count(*) OVER ()", "count(*) OVER (PARTITION BY decision)"))
def review_page(spark, d):
    """A page of the cases in a state, and how many there are."""
    reviews = load(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "reject").otherwise("accept").alias("decision"), F.lit(1).alias("reviewed_at"))
    page, total = files.page_of(load(spark, d, "documents").select("doc_id"), reviews, "doc_id", "accept", "doc_id", 10, 20)
    return page.select("doc_id", "decision", F.lit(total).cast("long").alias("total"))


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL")
def cross_tab(spark, d):
    """Counts by keys as CSV."""
    path = f"{scratch_dir(spark)}/tab"
    sinks.cross_tab(load(spark, d, "documents"), ["lang", "source"], path)
    return files.csv_table(spark, path, "lang string, source string, n long")


@query("SELECT count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents")
def json_report(spark, d):
    """B2: a report as one object."""
    path = f"{scratch_dir(spark)}/report"
    sinks.json_report(load(spark, d, "documents").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").cast("long").alias("chars")), path)
    return files.json_document(spark, path).select("n", "chars")


@query("SELECT p_partkey::BIGINT AS p_partkey, p_name FROM part")
def gated_shards(spark, d):
    """A closed gate writes nothing; an open one shards of at most 100 rows, under a receipt."""
    part, top = load(spark, d, "part").select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name"), scratch_dir(spark)
    rows = part.agg(F.count(F.lit(1)).alias("rows"))
    n = rows.first()[0]
    if sinks.publish_if(part, quality.gate_table(rows, [("rows", "=", n + 1, "integrity")]), f"{top}/closed") or not sinks.publish_if(part, quality.gate_table(rows, [("rows", "=", n, "integrity")]), f"{top}/open"):
        raise ValueError("the gate did not decide")
    sinks.write_shards(spark.read.parquet(f"{top}/open"), f"{top}/shards", 100)
    shards = spark.read.parquet(f"{top}/shards")
    if shards.groupBy(F.input_file_name()).count().where("count > 100").count():
        raise ValueError("a shard is too large")
    name = sinks.publish_folder(shards, f"{top}/published", "p_partkey")
    return spark.read.parquet(f"{top}/published/{name}")


@query("SELECT event_type AS metric, event_id AS step, value FROM events WHERE value >= 0 AND event_id % 5 <> 0")
def parsed_log(spark, d):
    """Metrics from complete log lines; others are passed over."""
    e = load(spark, d, "events").where("value >= 0").select(F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("step="), "event_id", F.lit(" broken"))).otherwise(F.concat(F.lit("step="), "event_id", F.lit(" "), "event_type", F.lit("="), F.col("value").cast("string"))))
    return streaming.parsed_log(spark.read.text(_text(e, spark)))


@query("SELECT event_id, user_id, event_type FROM events")
def resumed_ingest(spark, d):
    """A stream that is read twice adds each row once."""
    top = scratch_dir(spark)
    load(spark, d, "events").select("event_id", "user_id", "event_type").repartition(2).write.parquet(f"{top}/in")
    for run in ("one", "two"):
        stream = spark.readStream.schema("event_id long, user_id long, event_type string").parquet(f"{top}/in")
        streaming.resumable(stream, "event_id", f"{top}/out", f"{top}/{run}").awaitTermination()
    return spark.read.parquet(f"{top}/out")


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts)::TIMESTAMP AS start, (max(ts) + INTERVAL 30 MINUTE)::TIMESTAMP AS \"end\", count(*) AS n FROM s GROUP BY user_id, k")
def stream_sessions(spark, d):
    """Event-time sessions."""
    e = load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    got = streaming.session_windows(e)
    return got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
