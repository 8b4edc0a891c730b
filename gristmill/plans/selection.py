"""Queries over the selection, reconciliation and retrieval operators, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sql
from ..operators import ordering, search, selection
from ..tables import load
from .curation import query, vector_size


@query("WITH n AS (SELECT lang, n_chars < 1000 AS short, source, count(*) AS n FROM documents GROUP BY ALL), o AS (SELECT lang, count(DISTINCT short) AS o FROM n GROUP BY lang), r AS (SELECT lang, short, sum(sqrt(n)) AS r FROM n GROUP BY ALL) SELECT lang, short, source, n, round(CASE lang WHEN 'en' THEN 0.5 WHEN 'de' THEN 0.3 ELSE 0 END / o * sqrt(n) / r, 9) AS mass FROM n JOIN o USING (lang) JOIN r USING (lang, short)")
def sampling_mass(spark, d):
    """Role target, shared over origins, over sources by the root of their size."""
    docs = load(spark, d, "documents").select("lang", (F.col("n_chars") < 1000).alias("short"), "source")
    return selection.sampling_mass(docs, "lang", "short", "source", {"en": 0.5, "de": 0.3}).withColumn("mass", F.round("mass", 9))


@query("SELECT doc_id, CASE WHEN bool_or(quality = 1) AND bool_or(toxic = 1) THEN 'conflict' WHEN bool_or(quality = 1) THEN 'accepted' WHEN bool_or(toxic = 1) THEN 'rejected' ELSE 'needs_review' END AS state FROM labels GROUP BY doc_id")
def reconciled_labels(spark, d):
    """Accept and reject evidence; a low quality mark alone is a weak reason."""
    lab = load(spark, d, "labels")
    mark = lambda c, v, r: F.struct(F.when(c, v).alias("verdict"), F.lit(r).alias("reason"))
    marks = F.array(mark(F.col("quality") == 1, "accept", "quality"), mark(F.col("toxic") == 1, "reject", "toxic"), mark(F.col("quality") == 0, "reject", "weak"))
    return selection.reconciled(lab.select("doc_id", F.inline(marks)), "doc_id", ["weak"])


@query("SELECT n_nationkey AS name FROM nation WHERE n_regionkey IN (SELECT n_regionkey FROM nation WHERE n_nationkey IN (0, 2))")
def region_closure(spark, d):
    """Names reached through shared sets."""
    nation = load(spark, d, "nation")
    links = nation.select(F.col("n_regionkey").alias("set_id"), F.col("n_nationkey").alias("name"))
    return selection.closure(links.where("name in (0, 2)"), links)


@query("SELECT source AS component, CASE WHEN max(toxic) = 1 AND min(toxic) = 1 THEN 'quarantine' WHEN max(toxic) = 0 THEN 'clean' ELSE 'train' END AS split FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source HAVING count(DISTINCT toxic) <= 1")
def locked_sources(spark, d):
    """A source takes the one state that its labelled members have."""
    members = load(spark, d, "documents").select(F.col("source").alias("component"), F.col("doc_id").alias("name"))
    locks = load(spark, d, "labels").select(F.col("doc_id").alias("name"), F.when(F.col("toxic") == 1, "quarantine").otherwise("clean").alias("split"))
    return selection.locked_split(members, locks, F.lit("train"))[0]


@query("WITH c AS (SELECT floor((c_custkey * 37 % 1000) / 100.0)::BIGINT * 100 + floor((c_custkey * 91 % 1000) / 100.0)::BIGINT AS cell, avg(c_custkey * 37 % 1000) AS mx FROM customer GROUP BY 1), r AS (SELECT cell, row_number() OVER (ORDER BY mx, cell) - 1 AS i, count(*) OVER () AS n FROM c) SELECT cell, CASE WHEN i < floor(n * 0.2) THEN 'validation' WHEN i >= n - floor(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r")
def spatial_holdout(spark, d):
    """Grid cells, west validates and east tests."""
    c = load(spark, d, "customer").select((F.col("c_custkey") * 37 % 1000).alias("x"), (F.col("c_custkey") * 91 % 1000).alias("y"))
    return ordering.spatial_holdout(c, "x", F.floor(F.col("x") / 100) * 100 + F.floor(F.col("y") / 100))


@query("WITH s AS (SELECT q.vec_id AS a, q.label = r.label AS hit, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 9) DESC, r.vec_id) AS rank FROM embeddings q JOIN embeddings r ON q.vec_id % 20 = 0 AND r.vec_id <> q.vec_id), f AS (SELECT a, min(rank) FILTER (hit) AS first FROM s GROUP BY a) SELECT count(*) AS queries, round(avg((first <= 1)::INT), 9) AS recall_1, round(avg((first <= 5)::INT), 9) AS recall_5, round(avg(first), 9) AS mean_rank, quantile_disc(first, 0.5)::BIGINT AS median_rank FROM f")
def retrieval_metrics(spark, d):
    """Rank of the first right neighbour; the median is the lower middle."""
    e = load(spark, d, "embeddings")
    q, r = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"), F.col("label").alias("la")), e.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y"), F.col("label").alias("lb"))
    first = search.first_hit_rank(q, r, vector_size(e))
    return first.agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg((F.col("first") <= 1).cast("int")), 9).alias("recall_1"), F.round(F.avg((F.col("first") <= 5).cast("int")), 9).alias("recall_5"), F.round(F.avg("first"), 9).alias("mean_rank"), F.percentile_approx("first", 0.5, 1_000_000).cast("long").alias("median_rank"))


@query("SELECT event_type, count(*) AS n, round(avg((value > 50)::INT), 9) AS share, CASE WHEN avg((value > 50)::INT) >= 0.5 THEN 'PASS' WHEN avg((value > 50)::INT) >= 0.1 THEN 'PARTIAL' ELSE 'FAIL' END AS verdict FROM events GROUP BY event_type")
def event_verdicts(spark, d):
    """A verdict ladder over shares."""
    share = F.avg((F.col("value") > 50).cast("int"))
    g = load(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(share, 9).alias("share"))
    return g.withColumn("verdict", F.when(F.col("share") >= 0.5, "PASS").when(F.col("share") >= 0.1, "PARTIAL").otherwise("FAIL"))


@query()
def paired_events(spark, d):
    """One-to-one pairs of two event types within five minutes; greedy, held to literal rows by a test."""
    e = load(spark, d, "events").select("user_id", "event_type", F.col("event_id").alias("id"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    kinds = F.when(F.pmod(F.xxhash64("event_type"), F.lit(2)) == 0, "a").otherwise("b")
    e = e.withColumn("kind", kinds).drop("event_type")
    return selection.nearest_in_time(e.where("kind = 'a'").drop("kind"), e.where("kind = 'b'").drop("kind"), "user_id", 300.0)


@query("""WITH RECURSIVE c AS (SELECT list({'s': lang, 'n': n}) AS l FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)),
r AS (SELECT 0 AS i, l FROM c UNION ALL
SELECT i + 1, list_transform(l, lambda x: CASE WHEN x.s = t.s THEN {'s': x.s, 'n': x.n - greatest(1, ceil((x.n - 0.3::DOUBLE * total) / (1 - 0.3::DOUBLE)))::BIGINT} ELSE x END) FROM
(SELECT i, l, list_sum(list_transform(l, lambda x: x.n)) AS total, list_sort(list_transform(l, lambda x: {'n': x.n, 's': x.s}), 'DESC')[1] AS t FROM r) WHERE t.n > 0.3::DOUBLE * total AND len(l) > 1),
q AS (SELECT unnest(l) AS u FROM (SELECT l FROM r ORDER BY i DESC LIMIT 1))
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) AS k FROM documents) d JOIN q ON d.lang = u.s WHERE k <= u.n""")
def capped_sources(spark, d):
    """No language above a share."""
    docs = load(spark, d, "documents").select("doc_id", "lang").where("lang is not null")
    return selection.capped_share(docs, "lang", [F.sha2(F.col("doc_id").cast("string"), 256), F.col("doc_id")], 0.3)


@query("SELECT ('0x' || substr(sha256(lower(trim(regexp_replace(url, '\\s+', ' ', 'g')))), 1, 8))::BIGINT % 97 AS bucket, count(*) AS n FROM pages GROUP BY 1")
def sql_functions(spark, d):
    """P5, K1: the registered SQL functions in a SQL query."""
    sql.register(spark)
    load(spark, d, "pages").createOrReplaceTempView("gristmill_pages")
    return spark.sql("SELECT hash_bucket(match_key(url), 97) AS bucket, count(*) AS n FROM gristmill_pages GROUP BY 1")
