"""Queries over single operators that other queries show only in part, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, hashing, pixels, policy, text
from ..operators import quality, relational
from ..session import scratch_dir, written
from ..streaming import events as streaming
from ..tables import load
from .curation import DIST, SIGS, class_members, query, signatures


@query(f"WITH RECURSIVE {SIGS}, e AS (SELECT x.id AS a, y.id AS b FROM g x JOIN g y ON x.id % 3 <> y.id % 3 WHERE {DIST} <= 3), r AS (SELECT a AS node, b AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a), k AS (SELECT node, min({{'s': seen % 3, 'id': seen}}) AS best FROM r GROUP BY node) SELECT node AS id FROM k WHERE best.id <> node")
def component_keep_one(spark, d):
    """Of the near rows that splits share one stays in each component, of the first split."""
    s = signatures(spark, d)
    classes = written(relational.signature_classes(s), "classes")
    rows = class_members(s, classes).select("id", "class_id", (F.col("id") % 3).alias("rank"))
    units = written(rows.groupBy("class_id", "rank").agg(F.min("id").alias("unit")).select("unit", "class_id", "rank"), "units")
    near = relational.class_pairs(classes, 3).select("a", "b")
    return quality.keep_one_of_components(units, near, rows.join(units, ["class_id", "rank"]).select("id", "unit", "rank"))


@query(f"WITH {SIGS} SELECT min(id) AS id, count(*) AS copies FROM g JOIN (SELECT doc_id AS id, n_chars, lang, sha256(substr(text, 1, 32)) AS t FROM documents) USING (id) GROUP BY lo, hi, n_chars, lang, t")
def visual_key_dedup(spark, d):
    """I8: rows equal in signature, two sizes and a thumbnail's digest are one."""
    docs = load(spark, d, "documents").select(F.col("doc_id").alias("id"), "n_chars", "lang", F.sha2(F.substring("text", 1, 32), 256).alias("t"))
    return signatures(spark, d).join(docs, "id").groupBy("sig", "n_chars", "lang", "t").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")).select("id", "copies")


@query("SELECT lang, count(*) AS n, sum(toxic)::BIGINT AS toxic, sum((n_chars >= 500)::INT * quality)::BIGINT AS hits FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def accumulated_metrics(spark, d):
    """Metrics that grow batch by batch and are read at the end."""
    top = scratch_dir(spark)
    rows = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id").select("lang", "n_chars", "toxic", "quality")
    rows.repartition(3).write.parquet(f"{top}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{top}/in")
    sums = {"n": F.lit(1), "toxic": F.col("toxic"), "hits": (F.col("n_chars") >= 500).cast("int") * F.col("quality")}
    streaming.accumulated(stream, ["lang"], sums, f"{top}/parts", f"{top}/checkpoint").awaitTermination()
    return streaming.total(spark, ["lang"], list(sums), f"{top}/parts")


@query("SELECT lang, bool_or(n_chars < 100) AS some_short, bool_and(n_chars > 10) AS all_long, count(*) FILTER (source = 'web') AS web FROM documents GROUP BY lang")
def group_flags(spark, d):
    """Any and all by group; a map's value with a default."""
    counts = load(spark, d, "documents").groupBy("lang", F.coalesce("source", F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("n_chars") < 100).alias("short"), F.bool_and(F.col("n_chars") > 10).alias("long"))
    g = counts.groupBy("lang").agg(F.bool_or("short").alias("some_short"), F.bool_and("long").alias("all_long"), F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("m"))
    return g.select("lang", "some_short", "all_long", F.coalesce(F.try_element_at("m", F.lit("web")), F.lit(0).cast("long")).alias("web"))


@query("SELECT doc_id, source, n_chars::BIGINT AS n_chars FROM documents ORDER BY CASE WHEN lang = 'en' THEN 0 WHEN lang = 'de' THEN 1 ELSE 2 END, n_chars DESC, doc_id LIMIT 25")
def first_rows(spark, d):
    """The first rows by a priority, a falling and a rising key."""
    first = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).otherwise(2)
    return load(spark, d, "documents").orderBy(first, F.desc("n_chars"), "doc_id").limit(25).select("doc_id", "source", F.col("n_chars").cast("long").alias("n_chars"))


@query("WITH s AS (SELECT doc_id, ['Train ', 'VAL', 'dev', 'test', 'extra'][doc_id % 5 + 1] AS raw FROM documents), n AS (SELECT doc_id, CASE lower(trim(raw)) WHEN 'val' THEN 'validation' WHEN 'dev' THEN 'validation' ELSE lower(trim(raw)) END AS split FROM s) SELECT doc_id, split, split IN ('train', 'validation', 'test') AS valid FROM n")
def split_names(spark, d):
    """Names by alias, and whether the contract knows them."""
    raw = F.get(F.array(*[F.lit(x) for x in ("Train ", "VAL", "dev", "test", "extra")]), (F.col("doc_id") % 5).cast("int"))
    split = policy.split_name(raw, {"val": "validation", "dev": "validation"})
    return load(spark, d, "documents").select("doc_id", split.alias("split")).withColumn("valid", F.col("split").isin("train", "validation", "test"))


@query("SELECT 'short' AS \"check\", 'quality' AS severity, doc_id::VARCHAR AS subject FROM documents WHERE n_chars < 100 UNION ALL SELECT 'unlabelled', 'info', doc_id::VARCHAR FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'orphan', 'integrity', doc_id::VARCHAR FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def issue_log(spark, d):
    """The findings of several checks in one table."""
    docs, labels = load(spark, d, "documents"), load(spark, d, "labels")
    subject = F.col("doc_id").alias("subject")
    return quality.issue_log([("short", "quality", docs.where("n_chars < 100").select(subject)), ("unlabelled", "info", docs.join(labels, "doc_id", "left_anti").select(subject)), ("orphan", "integrity", labels.join(docs, "doc_id", "left_anti").select(subject))])


@query("SELECT source, doc_id, n_chars::BIGINT AS n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) = 1")
def best_per_source(spark, d):
    """The best row of each key by a rank tuple."""
    return relational.first_by(load(spark, d, "documents").select("source", "doc_id", F.col("n_chars").cast("long").alias("n_chars")), ["source"], [F.desc("n_chars"), F.col("doc_id")])


@query("SELECT sha256(text) AS sha256, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1")
def first_by_content(spark, d):
    """The first row of each content."""
    rows = load(spark, d, "documents").where("text is not null").select(F.sha2("text", 256).alias("sha256"), "doc_id")
    return relational.first_by(rows, ["sha256"], [F.col("doc_id")])


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS collapsed, nfc_normalize(text) AS nfc, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967295.0 AS jitter, regexp_replace(source || '-' || doc_id, '[-#]\d+$', '') AS station, CASE WHEN try_strptime('2024-0' || (doc_id % 10) || '-07', '%Y-%m-%d') IS NOT NULL THEN doc_id % 10 ELSE 0 END AS month FROM documents WHERE NOT regexp_matches(coalesce(text, ''), '[\x1c-\x1f\x85]')")
def text_forms(spark, d):
    """Collapsed and composed text, a station's name, a date, a steady jitter."""
    docs = load(spark, d, "documents").where(~F.coalesce("text", F.lit("")).rlike(r"[\x1c-\x1f\x85]"))
    month = F.month(text.parse_time(F.concat(F.lit("2024-0"), F.col("doc_id") % 10, F.lit("-07")))).cast("long")
    month = F.coalesce(month, F.lit(0).cast("long"))
    return docs.select("doc_id", text.collapse(F.col("text")).alias("collapsed"), text.nfc("text").alias("nfc"), hashing.unit_interval(F.col("doc_id").cast("string")).alias("jitter"), text.strip_number(F.concat_ws("-", "source", "doc_id")).alias("station"), month.alias("month"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'cc-by-4.0' WHEN 1 THEN 'cc0-1.0' WHEN 2 THEN 'apache-2.0' END AS licence, doc_id // 50 AS block, round(0.7 * (n_chars / 1000.0) + 0.3 * greatest(0.0, (doc_id % 3) - 1.0), 9) AS score, round(CASE WHEN doc_id % 5 > 0 THEN 1.0 / (doc_id % 5) ELSE 0 END + 0.5 * (doc_id % 2) + 0.25 * least(doc_id % 9, 4), 9) AS disagreement FROM documents")
def row_labels(spark, d):
    """Licence ids, sequence blocks and two scores."""
    i = F.col("doc_id")
    names = F.get(F.array(*[F.lit(x) for x in ("https://creativecommons.org/licenses/by/4.0/", "CC0", "Apache License 2.0", "none")]), (i % 4).cast("int"))
    score = policy.composite(F.col("n_chars") / F.lit(1000.0), (i % 3) - F.lit(1.0))
    return load(spark, d, "documents").select("doc_id", text.licence_id(names).alias("licence"), policy.block_id(F.concat(F.lit("frame_"), i, F.lit(".jpg")), 50).cast("long").alias("block"), F.round(score, 9).alias("score"), F.round(policy.disagreement(F.lit(1.0), i % 5, i % 2, i % 9), 9).alias("disagreement"))


@query("SELECT n_nationkey::BIGINT AS id, least(640.0 / (400 + 40 * n_nationkey), 640.0 / 700) AS scale, list_sort(list_distinct(list_concat(range(0, greatest(0, 400 + 40 * n_nationkey - 512) + 1, 384), [greatest(0, 400 + 40 * n_nationkey - 512)]))) AS tiles, [10.0, 20.0, 30.0 + n_nationkey, 45.0] AS hull, 256::BIGINT * (n_nationkey % 16) + 16 * 3 + n_regionkey AS cell FROM nation")
def frame_geometry(spark, d):
    """Hulls, scales, tiles and grid codes of frames."""
    n, w = F.col("n_nationkey"), 400 + 40 * F.col("n_nationkey")
    hull = geometry.union_box(F.array(F.array(F.lit(10.0), F.lit(30.0), F.lit(5.0), F.lit(35.0)), F.array(F.lit(20.0), F.lit(20.0), 20.0 + n, F.lit(10.0))))
    tiles = F.array_sort(geometry.tile_starts(w, 512, 384).cast("array<bigint>"))
    return load(spark, d, "nation").select(n.cast("long").alias("id"), geometry.letterbox(w, F.lit(700), 640).alias("scale"), tiles.alias("tiles"), hull.alias("hull"), geometry.fold16(F.array(n % 16, F.lit(3), F.col("n_regionkey")).cast("array<bigint>")).alias("cell"))


_PIXEL = "least(255, greatest(0, floor((x::DOUBLE + 1) * 127.5)))::INT"


@query(f"SELECT vec_id, sha256(unhex('0000000800000008' || array_to_string(list_transform(embedding, lambda x: repeat(printf('%02x', {_PIXEL}), 3)), ''))) AS pixels FROM embeddings")
def pixel_digests(spark, d):
    """Q3: digests of decoded pixels; a vector stands for an image of 8 x 8 grey pixels."""
    return _images(spark, d).select("vec_id", "m.pixels")


@query()
def image_hashes(spark, d):
    """Q1, Q2, Q4, Q5: hashes and measures of the same images; held to plain loops by a test."""
    return _images(spark, d).select("vec_id", "m.dhash", "m.phash", "m.thumbnail", "m.brightness", "m.contrast", "m.edges")


def _images(spark, d):
    level = lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 1) * 127.5))).cast("int")
    raw = F.unhex(F.array_join(F.transform("embedding", lambda x: F.repeat(F.lpad(F.hex(level(x)), 2, "0"), F.lit(3))), ""))
    return load(spark, d, "embeddings").select("vec_id", pixels.image_marks(F.lit(8), F.lit(8), raw).alias("m"))


@query("SELECT DISTINCT step, max(v) AS value FROM (SELECT user_id AS step, first_value(value) OVER (PARTITION BY user_id ORDER BY value) AS v FROM events) GROUP BY step")
def monotone_steps(spark, d):
    """O2: of the rows of one step the first is forwarded, in rising order of steps."""
    top = scratch_dir(spark)
    load(spark, d, "events").select(F.lit("m").alias("metric"), F.col("user_id").cast("long").alias("step"), "value").write.parquet(f"{top}/in")
    stream = spark.readStream.schema("metric string, step long, value double").parquet(f"{top}/in")  # all files are one micro-batch
    streaming.forwarded(stream, f"{top}/out", f"{top}/c").awaitTermination()
    return streaming.sent(spark, f"{top}/out").select("step", "value")
