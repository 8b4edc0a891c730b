"""Queries over documents, labels, benchmark and embeddings, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import graph, ordering, quality, relational, search
from ..session import written
from ..tables import load

#: Runs of a benchmark that are sent to all tasks at most: 8 bytes each.
BROADCAST_RUNS = 2_000_000
QUERIES: dict = {}
SQL: dict[str, str] = {}
KEY = r"lower(trim(regexp_replace(text, '\s+', ' ', 'g')))"
BUCKET = "('0x' || substr(sha256('seed:' || source), 1, 8))::BIGINT % 10000"
SPLIT = f"CASE WHEN {BUCKET} < 7000 THEN 'train' WHEN {BUCKET} < 8500 THEN 'validation' ELSE 'test' END"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents")


def clean_split(spark: SparkSession, d: str) -> DataFrame:
    """Exact dedup (smallest id stays), benchmark texts removed, split by source."""
    docs = _docs(spark, d).select("doc_id", "lang", "source", F.sha2(text.match_key(F.col("text")), 256).alias("h"))
    best = docs.groupBy("h").agg(F.min(F.struct("doc_id", "lang", "source")).alias("r")).select("h", "r.*")
    bench = load(spark, d, "benchmark").select(F.sha2(text.match_key(F.col("text")), 256).alias("h")).distinct()
    return best.join(bench, "h", "left_anti").withColumn("split", hashing.split_bucket(F.col("source")))


CLEAN = f"""WITH d AS (SELECT doc_id, lang, source, sha256({KEY}) AS h FROM documents),
b AS (SELECT h, min(doc_id) AS doc_id FROM d GROUP BY h),
k AS (SELECT d.* FROM b JOIN d USING (h, doc_id) WHERE h NOT IN (SELECT sha256({KEY}) FROM benchmark)),
s AS (SELECT *, {SPLIT} AS split FROM k)"""


@query(f"{CLEAN} SELECT split, source, lang, count(*) AS n FROM s GROUP BY ALL")
def leakage_free_split(spark, d):
    """The flagship profile of the leakage-free corpus."""
    return clean_split(spark, d).groupBy("split", "source", "lang").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{CLEAN}, a AS (SELECT count(*) AS rows, count(DISTINCT h) AS hashes, (SELECT count(*) FROM (SELECT source FROM s GROUP BY source HAVING count(DISTINCT split) > 1)) AS leaks, count(DISTINCT split) AS splits FROM s)
SELECT 'rows' AS gate, rows::DOUBLE AS actual, '>=' AS operator, 100.0::DOUBLE AS target, 'quality' AS severity, rows >= 100 AS passed FROM a
UNION ALL SELECT 'leaks', leaks, '=', 0, 'integrity', leaks = 0 FROM a UNION ALL SELECT 'splits', splits, '=', 3, 'quality', splits = 3 FROM a""")
def split_gates(spark, d):
    """Gates recomputed from the rows."""
    rows = clean_split(spark, d)
    one = rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("split").alias("splits"))
    leaks = quality.leakage(rows, "source", "split").agg(F.count(F.lit(1)).alias("leaks"))
    return quality.gate_table(one.crossJoin(F.broadcast(leaks)), [("rows", ">=", 100, "quality"), ("leaks", "=", 0, "integrity"), ("splits", "=", 3, "quality")])


@query(f"SELECT sha256({KEY}) AS k, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark, d):
    """Groups of equal normalised texts."""
    g = _docs(spark, d).groupBy(F.sha2(text.match_key(F.col("text")), 256).alias("k"))
    return g.agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT doc_id, CASE WHEN n_chars < 100 THEN 'short' WHEN lang IS NULL THEN 'no_language' WHEN text LIKE '%!!%' THEN 'shouting' END AS reason, list_sort(list_filter([CASE WHEN n_chars < 100 THEN 'short' END, CASE WHEN text LIKE '%!!%' THEN 'shouting' END, CASE WHEN lang <> 'en' THEN 'foreign' END], lambda x: x IS NOT NULL)) AS reasons FROM documents")
def exclusion_reasons(spark, d):
    """The first reason, and all of them."""
    shout, short = F.col("text").contains("!!"), F.col("n_chars") < 100
    return _docs(spark, d).select(
        "doc_id",
        relational.first_reason([("short", short), ("no_language", F.col("lang").isNull()), ("shouting", shout)]).alias("reason"),
        relational.all_reasons([("short", short), ("shouting", shout), ("foreign", F.col("lang") != "en")]).alias("reasons"),
    )


@query("SELECT coalesce(CASE WHEN n_chars < 100 THEN 'short' WHEN text LIKE '%!!%' THEN 'shouting' END, 'kept') AS reason, count(*) AS n FROM documents GROUP BY 1")
def reason_counts(spark, d):
    """Rows by the first failing predicate."""
    r = relational.first_reason([("short", F.col("n_chars") < 100), ("shouting", F.col("text").contains("!!"))])
    return _docs(spark, d).groupBy(F.coalesce(r, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, source, grouping(lang)::BIGINT AS gl, grouping(source)::BIGINT AS gs, count(*) AS n, count(DISTINCT text) AS texts, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY GROUPING SETS ((lang, source), (lang), (source), ())")
def corpus_profile(spark, d):
    """Counts with marginals in one pass."""
    df = _docs(spark, d)
    return df.groupingSets([["lang", "source"], ["lang"], ["source"], []], "lang", "source").agg(F.grouping("lang").cast("long").alias("gl"), F.grouping("source").cast("long").alias("gs"), F.count(F.lit(1)).alias("n"), F.countDistinct("text").alias("texts"), F.sum("n_chars").alias("chars"))


@query("SELECT lang, min(n_chars) AS lo, max(n_chars) AS hi, round(avg(n_chars), 6) AS mean, round(stddev_pop(n_chars), 6) AS sd, round(quantile_cont(n_chars, 0.05), 6) AS p05, round(quantile_cont(n_chars, 0.5), 6) AS p50, round(quantile_cont(n_chars, 0.95), 6) AS p95, count(*) FILTER (n_chars < 100) AS tiny FROM documents GROUP BY lang")
def length_statistics(spark, d):
    """Exact moments and percentiles."""
    p = lambda q: F.round(F.percentile("n_chars", F.lit(q)), 6)
    return _docs(spark, d).groupBy("lang").agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"), F.round(F.avg("n_chars"), 6).alias("mean"), F.round(F.stddev_pop("n_chars"), 6).alias("sd"), p(0.05).alias("p05"), p(0.5).alias("p50"), p(0.95).alias("p95"), F.count_if(F.col("n_chars") < 100).alias("tiny"))


@query("WITH m AS (SELECT median(n_chars) AS m FROM documents), a AS (SELECT median(abs(n_chars - m)) AS mad FROM documents, m) SELECT round(greatest(quantile_cont(n_chars, 0.99), any_value(m) + 3 * any_value(mad)), 6) AS threshold FROM documents, m, a")
def outlier_threshold(spark, d):
    """max(quantile, median + k * MAD)."""
    df = _docs(spark, d).select("n_chars")
    m = df.agg(F.median("n_chars").alias("m"))
    both = df.crossJoin(F.broadcast(m))
    return both.agg(F.round(F.greatest(F.percentile("n_chars", F.lit(0.99)), F.first("m") + 3 * F.median(F.abs(F.col("n_chars") - F.col("m")))), 6).alias("threshold"))


@query("WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source) SELECT source, n, round(n / (SELECT sum(n) FROM c), 9) AS share FROM c")
def source_shares(spark, d):
    """Shares by source."""
    return quality.shares(_docs(spark, d), "source").withColumn("share", F.round("share", 9))


@query("SELECT lang, sha256(string_agg(h, chr(10) ORDER BY h)) AS digest FROM (SELECT lang, sha256(doc_id::VARCHAR) AS h FROM documents) GROUP BY lang")
def selection_digest(spark, d):
    """A digest of the sorted members."""
    return _docs(spark, d).select("lang", F.sha2(F.col("doc_id").cast("string"), 256).alias("h")).groupBy("lang").agg(hashing.ordered_digest(F.col("h")).alias("digest"))


@query(f"SELECT doc_id, {SPLIT} AS k1, CASE WHEN u < 0.65 THEN 'train' WHEN u < 0.8 THEN 'validation' ELSE 'test' END AS k3, CASE b % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END AS k4 FROM (SELECT *, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT AS b, b / 4294967295.0 AS u FROM documents)")
def hash_splits(spark, d):
    """K1, K3, K4, K6: the split hashes side by side."""
    k = F.col("doc_id").cast("string")
    return _docs(spark, d).select("doc_id", hashing.split_bucket(F.col("source")).alias("k1"), hashing.unit_split(k).alias("k3"), hashing.mod10_split(k).alias("k4"))


@query("SELECT doc_id, list_reduce(list_concat([0::BIGINT], list_transform(range(32), lambda i: ('0x' || substr(sha256(doc_id::VARCHAR), (i * 2 + 1)::BIGINT, 2))::BIGINT)), lambda a, x: (a * 256 + x) % 10000) AS bucket FROM documents")
def wide_hash_bucket(spark, d):
    """K5: the 256-bit hash modulo 10000."""
    return _docs(spark, d).select("doc_id", hashing.sha256_mod(F.col("doc_id").cast("string")).alias("bucket"))


@query()
def blake_bucket(spark, d):
    """K2: blake2b buckets; DuckDB has no blake2b, a test holds them to hashlib."""
    return _docs(spark, d).select("doc_id", hashing.blake2b_mod100(F.col("doc_id").cast("string")).alias("bucket"))


@query("WITH g AS (SELECT source, row_number() OVER (ORDER BY sha256(source), source) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents)) SELECT source, CASE WHEN i < floor(n * 0.8) THEN 'train' WHEN i < floor(n * 0.9) THEN 'validation' ELSE 'test' END AS split FROM g")
def rank_split(spark, d):
    """K7: groups cut by hash rank."""
    return ordering.rank_split(_docs(spark, d), "source")


@query("""WITH RECURSIVE g AS MATERIALIZED (SELECT source, n, row_number() OVER (ORDER BY n DESC, source) AS i FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)),
r AS (SELECT 0::BIGINT AS i, NULL::VARCHAR AS source, NULL::VARCHAR AS split, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c UNION ALL
SELECT i, source, s, a + CASE WHEN s = 'train' THEN n ELSE 0 END, b + CASE WHEN s = 'validation' THEN n ELSE 0 END, c + CASE WHEN s = 'test' THEN n ELSE 0 END FROM
(SELECT g.i, g.source, g.n, r.a, r.b, r.c, CASE WHEN r.a / 0.7::DOUBLE <= r.b / 0.15::DOUBLE AND r.a / 0.7::DOUBLE <= r.c / 0.15::DOUBLE THEN 'train' WHEN r.b / 0.15::DOUBLE <= r.c / 0.15::DOUBLE THEN 'validation' ELSE 'test' END AS s FROM r JOIN g ON g.i = r.i + 1))
SELECT source, split FROM r WHERE i > 0""")
def greedy_split(spark, d):
    """Largest group first into the split with the least filled share."""
    g = _docs(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return ordering.greedy_fill(g, "source", "n", {"train": 0.7, "validation": 0.15, "test": 0.15})


@query("SELECT lang, doc_id, rank FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256('pick:' || doc_id), doc_id) AS rank FROM documents) WHERE rank <= CASE lang WHEN 'en' THEN 20 WHEN 'de' THEN 10 ELSE 5 END")
def quota_by_language(spark, d):
    """The first rows of each bucket in hash order, quotas by bucket."""
    quota = F.when(F.col("lang") == "en", 20).when(F.col("lang") == "de", 10).otherwise(5)
    return ordering.top_per_key(_docs(spark, d).select("lang", "doc_id"), ["lang"], [F.sha2(F.concat(F.lit("pick:"), F.col("doc_id")), 256), F.col("doc_id")], quota)


@query("SELECT source, doc_id, i FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) - 1 AS i FROM documents) ORDER BY i, source LIMIT 50")
def round_robin_sources(spark, d):
    """One of each group in turn."""
    return ordering.round_robin(_docs(spark, d).select("source", "doc_id", "n_chars"), "source", [F.desc("n_chars"), F.col("doc_id")], 50).select("source", "doc_id", "i")


@query("WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source), q AS (SELECT source, n, unnest(range(1, least(n, 40) + 1)) AS q FROM c), r AS (SELECT source, row_number() OVER (ORDER BY CASE WHEN q = 1 THEN 0 ELSE 1 END, n / q DESC, source) AS k FROM q) SELECT source, count(*) AS quota FROM r WHERE k <= 40 GROUP BY source")
def seat_quota(spark, d):
    """Seats by highest averages, one each first."""
    return ordering.proportional_quota(_docs(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n")), "source", "n", 40)


@query("SELECT doc_id, copy::BIGINT AS copy FROM (SELECT doc_id, unnest(range(0, CASE WHEN toxic = 1 THEN 3 ELSE 1 END)) AS copy FROM labels)")
def oversampled(spark, d):
    """Extra copies of rare rows."""
    return ordering.repeated(load(spark, d, "labels").select("doc_id", "toxic"), F.when(F.col("toxic") == 1, 2).otherwise(0)).select("doc_id", F.col("copy").cast("long").alias("copy"))


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, l.doc_id IS NOT NULL AS labelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def labelled_documents(spark, d):
    """Left lookup with its misses."""
    lab = load(spark, d, "labels").withColumn("labelled", F.lit(True))
    return _docs(spark, d).select("doc_id").join(lab, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"), F.coalesce("labelled", F.lit(False)).alias("labelled"))


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_right' WHEN d.doc_id IS NULL THEN 'missing_left' END AS issue FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR d.doc_id IS NULL")
def bijection_issues(spark, d):
    """Both-way match of two manifests."""
    return relational.bijection(_docs(spark, d).select("doc_id"), load(spark, d, "labels").select("doc_id"), "doc_id", [])


@query("SELECT coalesce(d.doc_id, o.doc_id) AS doc_id, d.source, coalesce(o.lang, d.lang) AS lang, o.doc_id IS NOT NULL AS overlaid FROM documents d FULL JOIN (SELECT doc_id + 500 AS doc_id, 'q' || quality AS lang FROM labels) o ON d.doc_id = o.doc_id")
def overlay_upsert(spark, d):
    """Overlay values win, new rows are appended."""
    over = load(spark, d, "labels").select((F.col("doc_id") + 500).alias("doc_id"), F.concat(F.lit("q"), "quality").alias("lang"))
    return relational.overlay(_docs(spark, d).select("doc_id", "source", "lang"), over, "doc_id", ["lang"])


@query("WITH f AS (SELECT doc_id, quality FROM labels WHERE toxic = 0), s AS (SELECT lang, source, max(n_chars)::INT AS quality FROM documents WHERE n_chars > 2000 GROUP BY ALL) SELECT d.doc_id, d.lang, d.source, coalesce(f.quality, s.quality, -1) AS quality, CASE WHEN f.quality IS NOT NULL THEN 'first' WHEN s.quality IS NOT NULL THEN 'second' ELSE 'none' END AS matched_by FROM documents d LEFT JOIN f USING (doc_id) LEFT JOIN s ON d.lang = s.lang AND d.source = s.source")
def fallback_match(spark, d):
    """By id, else by two other fields."""
    docs = _docs(spark, d).select("doc_id", "lang", "source", "n_chars")
    second = docs.where("n_chars > 2000").groupBy("lang", "source").agg(F.max("n_chars").cast("int").alias("quality"))
    return relational.two_key_lookup(docs.drop("n_chars"), load(spark, d, "labels").where("toxic = 0"), second, "doc_id", ["lang", "source"], "quality").withColumn("quality", F.coalesce("quality", F.lit(-1)))


_RUNS = "(SELECT {id}, unnest(list_transform(range(1, greatest(len(w) - 6, 1)), lambda i: array_to_string(w[i:i + 7], ' '))) AS r FROM (SELECT {id}, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table}))"


@query(f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM {_RUNS.format(id='doc_id', table='documents')} WHERE r IN (SELECT r FROM {_RUNS.format(id='item_id', table='benchmark')}))")
def benchmark_containment(spark, d):
    """Documents that share no run of eight words with a benchmark text.

    Runs meet by hash in a semi join: the benchmark's are counted, and sent to the documents if they
    are few enough, so that the documents' runs need no shuffle.
    """

    def runs(df: DataFrame, key: str) -> DataFrame:
        words = df.select(key, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w")).where(F.size("w") >= 8)
        return words.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 7), lambda i: F.xxhash64(F.slice("w", i, 8)))).alias("r"))

    held = written(runs(load(spark, d, "benchmark"), "item_id").select("r").distinct(), "runs")
    held = F.broadcast(held) if held.count() <= BROADCAST_RUNS else held
    hit = runs(_docs(spark, d), "doc_id").join(held, "r", "left_semi").select("doc_id").distinct()
    return _docs(spark, d).select("doc_id").join(hit, "doc_id", "left_anti")


def signatures(spark, d):
    return written(hashing.simhash(_docs(spark, d), "doc_id", "text"), "signatures")  # used on both sides of joins


_HALF = lambda a, b: " + ".join(f"CASE WHEN sum(CASE WHEN (h >> {i}) & 1 = 1 THEN 1 ELSE -1 END) > 0 THEN {1 << (i - a)}::BIGINT ELSE 0 END" for i in range(a, b))
SIGS = f"w AS (SELECT doc_id AS id, ('0x' || substr(md5(unnest(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))), 1, 16))::UBIGINT AS h FROM documents), g AS (SELECT id, {_HALF(0, 32)} AS lo, {_HALF(32, 64)} AS hi FROM w GROUP BY id)"
DIST = "(bit_count(xor(x.lo, y.lo)) + bit_count(xor(x.hi, y.hi)))"


#: Classes of equal signatures: their least id and their rows.
CLASSES = f"{SIGS}, c AS (SELECT lo, hi, min(id) AS id, count(*) AS n FROM g GROUP BY lo, hi)"


@query(f"WITH {CLASSES} SELECT x.id AS a, y.id AS b, x.n AS n_a, y.n AS n_b, {DIST}::INT AS distance FROM c x JOIN c y ON x.id < y.id WHERE {DIST} <= 3")
def near_signature_pairs(spark, d):
    """Pairs of signature classes within a Hamming radius."""
    return class_pairs(written(relational.signature_classes(signatures(spark, d)), "classes"), 3)


def class_pairs(classes: DataFrame, radius: int) -> DataFrame:
    return with_sizes(relational.class_pairs(classes, radius), classes)


def with_sizes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    size = classes.select("id", "n")
    return pairs.join(size.toDF("a", "n_a"), "a").join(size.toDF("b", "n_b"), "b").select("a", "b", "n_a", "n_b", "distance")


def class_members(sigs: DataFrame, classes: DataFrame) -> DataFrame:
    """``id, class_id, copies`` of every row."""
    return sigs.join(classes.select("sig", F.col("id").alias("class_id"), F.col("n").alias("copies")), "sig").select("id", "class_id", "copies")


@query(f"WITH {SIGS} SELECT id, min(id) OVER (PARTITION BY lo, hi) AS class_id, count(*) OVER (PARTITION BY lo, hi) AS copies FROM g")
def signature_members(spark, d):
    """The class of every signature, which with the pairs of classes says all near rows."""
    s = signatures(spark, d)
    return class_members(s, relational.signature_classes(s))


BENCH_SIGS = SIGS.replace("doc_id", "item_id").replace("documents", "benchmark").replace("w AS", "bw AS").replace("g AS", "bg AS").replace("FROM w", "FROM bw")


@query(f"WITH {SIGS}, {BENCH_SIGS}, p AS (SELECT x.id AS a, y.id AS b, {DIST}::INT AS distance FROM bg x, g y) SELECT a, (min({{'d': distance, 'b': b}})).b AS b, min(distance) AS distance FROM p GROUP BY a")
def nearest_signatures(spark, d):
    """The nearest document of each benchmark text, ties to the smaller id."""
    bench = hashing.simhash(load(spark, d, "benchmark"), "item_id", "text")
    return search.nearest_signature(bench, hashing.simhash(_docs(spark, d), "doc_id", "text"))


@query(f"WITH RECURSIVE {SIGS}, e AS (SELECT x.id AS a, y.id AS b FROM g x JOIN g y ON x.id <> y.id WHERE {DIST} <= 3), r AS (SELECT a AS node, b AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a) SELECT node, least(node, min(seen)) AS component FROM r GROUP BY node")
def signature_components(spark, d):
    """Connected components of the near pairs; components of classes, then their members."""
    s = signatures(spark, d)
    classes = written(relational.signature_classes(s), "classes")
    found = graph.connected_components(class_pairs(classes, 3), "a", "b").select(F.col("node").alias("class_id"), "component")
    rows = class_members(s, classes).join(found, "class_id", "left").where("copies > 1 or component is not null")
    return rows.select(F.col("id").alias("node"), F.coalesce("component", "class_id").alias("component"))


@query(f"""WITH RECURSIVE {CLASSES}, o AS MATERIALIZED (SELECT id, lo, hi, row_number() OVER (ORDER BY id) AS i FROM c),
r AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS id, false AS ok, []::STRUCT(lo BIGINT, hi BIGINT)[] AS kept UNION ALL
SELECT i, id, ok, CASE WHEN ok THEN list_append(kept, {{'lo': lo, 'hi': hi}}) ELSE kept END FROM
(SELECT o.*, r.kept, len(list_filter(r.kept, lambda k: bit_count(xor(k.lo, o.lo)) + bit_count(xor(k.hi, o.hi)) <= 3)) = 0 AS ok FROM r JOIN o ON o.i = r.i + 1))
SELECT id FROM r WHERE ok""")
def greedy_signature_dedup(spark, d):
    """Order-dependent greedy dedup. Of equal signatures only the first can stay, so the
    pass runs over classes."""
    classes = written(relational.signature_classes(signatures(spark, d)), "classes")
    pairs = relational.class_pairs(classes, 3)
    return quality.greedy_independent(classes.select("id"), pairs.select(F.col("a").alias("early"), F.col("b").alias("late")))


@query(f"WITH {SIGS}, p AS (SELECT x.id AS a, y.id AS b, x.id % 3 AS sa, y.id % 3 AS sb FROM g x JOIN g y ON x.id < y.id AND x.id % 3 <> y.id % 3 WHERE {DIST} <= 3) SELECT DISTINCT CASE WHEN sa <> sb AND sa < sb THEN b ELSE a END AS id FROM p")
def cross_split_rejects(spark, d):
    """Of each cross-split near pair the one in the later split goes: a row goes if the
    first split among its own and its near classes is before its own split."""
    s = signatures(spark, d)
    classes = written(relational.signature_classes(s), "classes")
    rows = class_members(s, classes).select("id", "class_id", (F.col("id") % 3).alias("s"))
    own = rows.groupBy("class_id").agg(F.min("s").alias("s"))
    p = relational.class_pairs(classes, 3)
    near = p.select(F.col("a").alias("class_id"), F.col("b").alias("other")).union(p.select("b", "a"))
    first = near.join(own.toDF("other", "s"), "other").select("class_id", "s").union(own).groupBy("class_id").agg(F.min("s").alias("first"))
    return rows.join(first, "class_id").where("first < s").select("id")


@query("SELECT a, b, rank FROM (SELECT q.vec_id AS a, r.vec_id AS b, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 9) DESC, r.vec_id) AS rank FROM embeddings q JOIN embeddings r ON q.vec_id % 20 = 0 AND r.vec_id <> q.vec_id) WHERE rank <= 5")
def similarity_top_k(spark, d):
    """The five largest dot products of each query against all rows."""
    e = load(spark, d, "embeddings")
    q, r = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("a"), F.col("embedding").alias("x")), e.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return search.dot_top_k(q, r, 5, vector_size(e))


def vector_size(e: DataFrame) -> int:
    return (e.where("embedding is not null").select(F.size("embedding")).first() or [0])[0]


@query("SELECT lang, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall FROM (SELECT lang, quality = 1 AS t, n_chars >= 500 AS p FROM documents JOIN labels USING (doc_id)) GROUP BY lang")
def metrics_by_language(spark, d):
    """A length baseline against the quality label."""
    j = _docs(spark, d).join(load(spark, d, "labels"), "doc_id")
    c = quality.confusion(j, F.col("quality") == 1, F.col("n_chars") >= 500, ["lang"])
    return c.select("lang", "tp", "fp", "fn", "tn", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


_LIMITS = [100.0, 200.0, 400.0, 800.0, 1600.0, 3200.0]


@query("WITH j AS (SELECT quality = 1 AS y, n_chars FROM documents JOIN labels USING (doc_id)), t AS (SELECT unnest([100.0, 200.0, 400.0, 800.0, 1600.0, 3200.0])::DOUBLE AS threshold), c AS (SELECT threshold, count(*) FILTER (y AND n_chars >= threshold) AS tp, count(*) FILTER (NOT y AND n_chars >= threshold) AS fp, count(*) FILTER (y AND n_chars < threshold) AS fn FROM j, t GROUP BY threshold), m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM c) SELECT threshold, tp, fp, fn, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 9) AS f1 FROM m ORDER BY round(coalesce(2 * p * r / nullif(p + r, 0), 0), 12) DESC, r DESC, threshold LIMIT 1")
def best_threshold(spark, d):
    """M3: the threshold with the best (f1, recall, -threshold)."""
    j = _docs(spark, d).join(load(spark, d, "labels"), "doc_id")
    return quality.pick_threshold(quality.sweep(j, "n_chars", F.col("quality") == 1, _LIMITS)).select("threshold", "tp", "fp", "fn", F.round("f1", 9).alias("f1"))


@query("WITH j AS (SELECT doc_id, n_chars, quality AS y FROM documents JOIN labels USING (doc_id)), r AS (SELECT *, row_number() OVER w AS k, sum(y) OVER (w ROWS UNBOUNDED PRECEDING) AS tp, sum(y) OVER () AS total FROM j WINDOW w AS (ORDER BY n_chars DESC, doc_id)), b AS (SELECT *, max(tp / k) OVER (ORDER BY n_chars DESC, doc_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS best FROM r) SELECT round(sum(best / total), 9) AS average_precision FROM b WHERE y = 1")
def average_precision(spark, d):
    """M4: average precision of the length score."""
    j = _docs(spark, d).join(load(spark, d, "labels"), "doc_id")
    return quality.average_precision(j, "n_chars", F.col("quality") == 1, "doc_id")


_U = "('0x' || substr(md5('7:' || r || ':' || doc_id), 1, 8))::BIGINT / 4294967296.0"
_WEIGHT = " + ".join(f"(u >= {p!r})::INT" for p in ordering.POISSON)


@query(f"WITH u AS (SELECT r, quality::DOUBLE AS v, {_U} AS u FROM labels, (SELECT unnest(range(200)) AS r) WHERE quality IS NOT NULL), s AS (SELECT r, sum(v * ({_WEIGHT})) / sum({_WEIGHT}) AS s FROM u GROUP BY r) SELECT round(quantile_cont(s, 0.025), 9) AS low, round(quantile_cont(s, 0.975), 9) AS high FROM s")
def bootstrap_interval(spark, d):
    """Percentile interval of the mean quality over Poisson resamples."""
    b = ordering.bootstrap(load(spark, d, "labels"), "doc_id", "quality", 200, 7)
    p = lambda q: F.round(F.percentile("statistic", F.lit(q)), 9)
    return b.agg(p(0.025).alias("low"), p(0.975).alias("high"))
