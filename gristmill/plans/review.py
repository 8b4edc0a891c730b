"""Queries over row policies, quotas, receipts, coverage and baselines, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, hashing, policy, signals
from ..operators import audit, near, ordering, quality, relational, selection
from ..session import written
from ..tables import load
from .curation import BUCKET, CLASSES, DIST, SIGS, SPLIT, query, signatures, with_sizes

_PATH = "regexp_replace(url, '^[a-z]+://[^/]*/?', '')"


def _path():
    return F.regexp_replace("url", "^[a-z]+://[^/]*/?", "")


@query(f"SELECT page_id, coalesce(NOT starts_with(p, '/') AND NOT contains(p, chr(92)) AND NOT list_contains(string_split(p, '/'), '..') AND p <> '', false) AS safe, CASE WHEN contains(url, 'utm_') OR contains(url, '.org') THEN 1 ELSE 0 END AS ground FROM (SELECT *, {_PATH} AS p FROM pages)")
def page_paths(spark, d):
    """Safe relative paths, and membership in either of two sets."""
    ground = F.contains("url", F.lit("utm_")) | F.contains("url", F.lit(".org"))
    return load(spark, d, "pages").select("page_id", policy.safe_path(_path()).alias("safe"), F.when(ground, 1).otherwise(0).alias("ground"))


@query("SELECT l_discount * 10 BETWEEN 0 AND 1 AND l_tax * 20 BETWEEN 0 AND 1 AS inside, coalesce(CASE WHEN l_returnflag = 'R' THEN false END, l_quantity > 10) AND l_linestatus IN ('O') AS admitted, CASE WHEN l_returnflag = 'N' THEN 'negative' WHEN l_quantity < 5 THEN 'abstention' WHEN l_discount > 0.05 THEN 'presence' ELSE 'positive' END AS role, CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity >= 40 THEN 'contextual' ELSE 'mixed' END AS size, CASE WHEN 300 - l_linenumber * 150 <= -300 THEN 'pre' WHEN 300 - l_linenumber * 150 <= 0 THEN 'ambiguous' ELSE 'post' END AS time_role, count(*) AS n FROM lineitem GROUP BY ALL")
def row_policies(spark, d):
    """Verdicts of single rows, counted."""
    point = F.struct((F.col("l_discount") * 10).alias("x"), (F.col("l_tax") * 20).alias("y"))
    rows = load(spark, d, "lineitem").select(
        policy.in_unit_square(F.array(point)).alias("inside"),
        policy.admitted(F.when(F.col("l_returnflag") == "R", F.lit(False)), F.col("l_quantity") > 10, F.col("l_linestatus"), ["O"]).alias("admitted"),
        policy.supervision_role(F.col("l_returnflag") == "N", F.when(F.col("l_quantity") < 5, "low"), F.col("l_discount") > 0.05).alias("role"),
        selection.size_class(F.array("l_quantity"), 10.0, 40.0).alias("size"),
        selection.offset_role(300 - F.col("l_linenumber") * 150).alias("time_role"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT array_to_string(list_sort(list_distinct(list(CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END))), ',') AS labels, l_orderkey FROM lineitem GROUP BY l_orderkey")
def class_sets(spark, d):
    """The set of classes of an order as sorted names."""
    orders = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set((F.col("l_linenumber") % 2).cast("int")).alias("c"))
    return orders.select("l_orderkey", F.array_join(policy.class_labels(F.col("c"), ["even", "odd"]), ",").alias("labels"))


@query("SELECT array_to_string(list_filter([CASE WHEN lang = 'en' OR regexp_matches(text, '(^|[^a-z])dic') THEN 'a' END, CASE WHEN regexp_matches(text, '@') THEN 'b' END, CASE WHEN lang IN ('de', 'fr') THEN 'c' END], lambda x: x IS NOT NULL), ',') AS labels, count(*) AS n FROM documents GROUP BY 1")
def context_labels(spark, d):
    """Labels by setting or by pattern."""
    terms = {"a": (["en"], "(^|[^a-z])dic"), "b": ([], "@"), "c": (["de", "fr"], "(?!)")}
    labels = F.array_join(policy.context_labels(F.col("lang"), F.col("text"), terms), ",")
    return load(spark, d, "documents").groupBy(labels.alias("labels")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH f AS (SELECT DISTINCT lang || '-' || source AS name FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) SELECT doc_id FROM documents WHERE coalesce(source NOT IN (SELECT name FROM f), true) AND coalesce(lang || '-' || source NOT IN (SELECT name FROM f), true)")
def alias_exclusion(spark, d):
    """Rows none of whose names is frozen."""
    docs = load(spark, d, "documents").select("doc_id", "source", F.concat_ws("-", "lang", "source").alias("pair"))
    frozen = docs.join(load(spark, d, "labels").where("toxic = 1").select("doc_id"), "doc_id", "left_semi").select(F.col("pair").alias("name")).distinct()
    rows = docs.select("doc_id", F.array_compact(F.array("source", "pair")).alias("aliases"))
    return relational.alias_anti(rows, "doc_id", "aliases", frozen, "name").select("doc_id")


_TURNED = "(bit_count(xor(x.lo, y.hi)) + bit_count(xor(x.hi, y.lo)))"


@query(f"WITH {CLASSES} SELECT x.id AS a, y.id AS b, x.n AS n_a, y.n AS n_b, least({DIST}, {_TURNED})::INT AS distance FROM c x JOIN c y ON x.id < y.id WHERE least({DIST}, {_TURNED}) <= 4")
def mirrored_pairs(spark, d):
    """Near signature classes, mirrored ones (here: halves swapped) included. Mirroring both sides
    changes no distance, so signatures meet signatures and, as second ones, mirrors."""
    plain = written(relational.signature_classes(signatures(spark, d)), "classes")
    turned = F.shiftleft("sig", 32).bitwiseOR(F.shiftrightunsigned("sig", 32))
    sides = F.array(F.struct(F.col("sig"), F.lit(near.FIRST | near.SECOND).alias("side")), F.struct(turned.alias("sig"), F.lit(near.SECOND).alias("side")))
    p = near.near_signatures(plain.select("id", F.inline(sides)), 4).groupBy("a", "b").agg(F.min("distance").alias("distance"))
    return with_sizes(p, plain)


@query(f"WITH {SIGS}, n AS (SELECT doc_id AS id, length(text) AS c, len(string_split(text, ' ')) AS w FROM documents), k AS (SELECT lo, hi, c, w, min(id) AS id, count(*) AS n FROM g JOIN n USING (id) GROUP BY ALL) SELECT x.id AS a, y.id AS b, x.n AS n_a, y.n AS n_b FROM k x JOIN k y ON x.id < y.id WHERE {DIST} <= 3 AND (abs(x.c - y.c) + abs(x.w - y.w)) / 2 <= 20")
def near_pairs_confirmed(spark, d):
    """Near classes of signature and second feature, confirmed by the feature's mean difference.

    Both are compared at once: one signature may have many lengths, and few of its pairs are confirmed.
    """
    feature = {"c": F.length("text"), "w": F.size(F.split("text", " "))}
    s = hashing.simhash(load(spark, d, "documents"), "doc_id", "text", *[v.alias(k) for k, v in feature.items()])
    k = written(relational.signature_classes(s, [*feature]), "classes")
    return with_sizes(relational.class_pairs(k, 3, [*feature], 20), k).drop("distance")


@query("SELECT conv_id * 1000 + turn // 2 AS pair_key, min(conv_id * 1000 + turn) FILTER (role = 'user')::VARCHAR AS \"user\", min(conv_id * 1000 + turn) FILTER (role = 'assistant')::VARCHAR AS assistant, count(DISTINCT role) FILTER (role IN ('user', 'assistant')) = 2 AS complete FROM conversations GROUP BY 1")
def turn_pairs(spark, d):
    """Two kinds of rows under one key, orphans kept."""
    c = load(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "conv_id", "turn")
    p = relational.pairs_by_key(c, F.expr("conv_id * 1000 + turn div 2"), "role", ("user", "assistant"))
    return p.withColumns({k: F.col(k).cast("string") for k in ("user", "assistant")})


@query()
def box_matches(spark, d):
    """Greedy matches of predictions to boxes by image and class; sequential, held to literal rows by a test."""
    l = load(spark, d, "lineitem")  # noqa: E741
    box = lambda shift: F.array(F.col("l_quantity") + shift, F.col("l_linenumber") * 5.0, F.lit(20.0), F.lit(20.0))
    cls, t = (F.col("l_linenumber") % 2).alias("cls"), F.col("l_linenumber").cast("long")
    truth = l.select(F.col("l_orderkey").alias("image"), cls, t.alias("t"), box(0.0).alias("box"))
    return selection.match_boxes(truth, l.select(F.col("l_orderkey").alias("image"), cls, t.alias("p"), F.col("l_discount").alias("score"), box(3.0).alias("box")), 0.5)


@query(f"""WITH RECURSIVE {SIGS}, o AS MATERIALIZED (SELECT doc_id, source, -n_chars AS "order", lo, hi, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS i FROM documents JOIN g ON g.id = doc_id),
r AS (SELECT doc_id, source, "order", i, [{{'lo': lo, 'hi': hi}}] AS kept, true AS admitted FROM o WHERE i = 1 UNION ALL
SELECT doc_id, source, "order", i, CASE WHEN ok THEN list_append(kept, {{'lo': lo, 'hi': hi}}) ELSE kept END, ok FROM
(SELECT o.*, r.kept, len(r.kept) < 8 AND len(list_filter(r.kept, lambda k: bit_count(xor(k.lo, o.lo)) + bit_count(xor(k.hi, o.hi)) <= 3)) = 0 AS ok FROM r JOIN o ON o.source IS NOT DISTINCT FROM r.source AND o.i = r.i + 1))
SELECT doc_id, source, "order" FROM r WHERE admitted""")
def admitted_documents(spark, d):
    """Longest first by source, near signatures skipped, a cap."""
    docs = load(spark, d, "documents").select("doc_id", "source", (-F.col("n_chars")).alias("order"))
    rows = docs.join(signatures(spark, d).withColumnRenamed("id", "doc_id"), "doc_id")
    return selection.admitted(rows, "source", ["order", "doc_id"], "sig", 3, 8).select("doc_id", "source", "order")


@query("WITH p AS (SELECT event_id, user_id, first_value(value) OVER w AS v0, value, row_number() OVER w AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY (i = 1) DESC, abs(value - v0) DESC, event_id) AS rank FROM p QUALIFY rank <= 3")
def farthest_events(spark, d):
    """The first event of a user and the two farthest from it."""
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "value")
    return ordering.farthest_picks(e, ["user_id"], [F.col("ts"), F.col("event_id")], lambda s: F.abs(F.col("value") - s), "value", "event_id", 3).select("event_id", "user_id", "rank")


@query("SELECT doc_id, CASE WHEN quality IS NULL AND toxic IS NULL THEN 'missing' WHEN quality <> 1 - toxic THEN 'conflict' ELSE 'agreed' END AS state, CASE WHEN quality <> 1 - toxic THEN NULL ELSE coalesce(quality, 1 - toxic)::VARCHAR END AS value FROM documents LEFT JOIN labels USING (doc_id)")
def field_agreement(spark, d):
    """Two fields that should say the same."""
    j = load(spark, d, "documents").select("doc_id").join(load(spark, d, "labels"), "doc_id", "left")
    return j.select("doc_id", selection.agreed(F.col("quality"), 1 - F.col("toxic")).alias("s")).select("doc_id", "s.state", F.col("s.value").cast("string").alias("value"))


@query("SELECT l_orderkey, count(*) FILTER (l_linenumber % 3 < 2 AND l_quantity / 40 <= 1) AS n FROM lineitem GROUP BY 1")
def parsed_boxes(spark, d):
    """Lines of class and unit box parsed from text; bad ones are left out."""
    line = F.concat_ws(" ", (F.col("l_linenumber") % 3).cast("string"), F.col("l_discount").cast("string"), F.col("l_tax").cast("string"), (F.col("l_quantity") / 40).cast("string"), F.lit("0.1"))
    files = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(line), "\n").alias("t"))
    return files.select("l_orderkey", F.size(selection.yolo_boxes(F.col("t"), 2)).cast("long").alias("n"))


@query("""WITH e AS (SELECT event_id, event_type AS s, user_id % 7 AS c, strftime(ts, '%Y-%m-%d') AS g, ts FROM events),
n AS (SELECT s, c, count(*) AS n FROM e GROUP BY ALL), sn AS (SELECT s, sum(n)::BIGINT AS n FROM n GROUP BY s),
sq AS (SELECT s, count(*) AS b FROM (SELECT s, q FROM (SELECT s, n, unnest(range(1, least(n, 200) + 1)) AS q FROM sn) ORDER BY q > 1, n / q DESC, s LIMIT 200) GROUP BY s),
cq AS (SELECT s, c, count(*) AS k FROM (SELECT s, c, b, row_number() OVER (PARTITION BY s ORDER BY q > 1, n / q DESC, c) AS r FROM (SELECT s, c, n, b, unnest(range(1, least(n, b) + 1)) AS q FROM n JOIN sq USING (s))) WHERE r <= b GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY s, c, g ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY s, c, g) AS m, min(ts) OVER (PARTITION BY s, c, g) AS f FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY s, c, g ORDER BY abs(i - (m - 1) / 2), i) AS mid, dense_rank() OVER (PARTITION BY s, c ORDER BY f, g) - 1 AS ep FROM p),
a AS (SELECT s, c, count(DISTINCT g) AS all_ FROM e GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY s, c ORDER BY mid, ep) AS turn FROM o)
SELECT event_id FROM r JOIN cq USING (s, c) JOIN a USING (s, c) WHERE CASE WHEN k < all_ THEN mid = 1 AND list_contains(list_transform(range(0, k), lambda j: ((2 * j + 1) * all_) // (2 * k)), ep) ELSE turn <= k END""")
def strata_cap(spark, d):
    """Split quota, camera quota, spread over episodes, middle first."""
    e = load(spark, d, "events").select("event_id", F.col("event_type").alias("s"), (F.col("user_id") % 7).alias("c"), F.date_format("ts", "yyyy-MM-dd").alias("g"), "ts")
    return audit.strata_cap(e, "s", "c", "g", "ts", "event_id", 200).where("selected").select("event_id")


@query(f"""WITH t AS (SELECT doc_id, lang, {SPLIT} AS s FROM documents), p AS (SELECT *, row_number() OVER (PARTITION BY s, lang ORDER BY doc_id) AS i FROM t),
f AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY i, lang) AS r FROM p), k AS (SELECT doc_id FROM f WHERE r <= CASE s WHEN 'train' THEN 112 WHEN 'validation' THEN 24 ELSE 24 END),
z AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM t WHERE doc_id NOT IN (SELECT doc_id FROM k)),
y AS (SELECT doc_id, row_number() OVER (ORDER BY i, lang) AS r FROM z)
SELECT doc_id FROM k UNION ALL SELECT doc_id FROM y WHERE r <= 160 - (SELECT count(*) FROM k)""")
def balanced_documents(spark, d):
    """160 documents by split ratio, languages in turn, refilled."""
    docs = load(spark, d, "documents").select("doc_id", "lang", hashing.split_bucket(F.col("source")).alias("split"))
    return audit.balanced_by_split(docs, "doc_id", "split", "lang", {"train": 0.7, "validation": 0.15, "test": 0.15}, 160).select("doc_id")


@query("SELECT r_regionkey AS region, n_nationkey AS nation, row_number() OVER (ORDER BY (n_nationkey - r_regionkey + 25) % 25, r_regionkey) - 1 AS place FROM region, nation")
def variation_cases(spark, d):
    """Every pair once, by diagonals."""
    a, b = load(spark, d, "region").select(F.col("r_regionkey").alias("i")), load(spark, d, "nation").select(F.col("n_nationkey").alias("j"))
    return audit.diagonal_pairs(a, b, 25).select(F.col("i").alias("region"), F.col("j").alias("nation"), (F.col("diagonal") * 5 + F.col("i")).cast("long").alias("place"))


@query("SELECT item_id AS old, row_number() OVER (ORDER BY md5(item_id::VARCHAR), item_id) + (SELECT max(doc_id) FROM documents) AS new FROM benchmark")
def appended_ids(spark, d):
    """H3: ids of an appended set behind those of the base."""
    return audit.renumbered(load(spark, d, "documents"), load(spark, d, "benchmark").withColumnRenamed("item_id", "doc_id"), "doc_id")


@query(f"""WITH x AS (SELECT doc_id + CASE WHEN doc_id % 10 = 3 THEN 1000000000 ELSE 0 END AS doc_id, CASE WHEN quality = 0 THEN 'toxic' END AS reason, CASE WHEN doc_id % 10 = 7 THEN 'other' ELSE source END AS grp FROM labels JOIN documents USING (doc_id) WHERE toxic = 1)
SELECT x.doc_id, CASE WHEN d.doc_id IS NULL THEN 'missing' WHEN {SPLIT.replace('source', 'd.source')} <> 'train' THEN 'not_train' WHEN reason IS NULL THEN 'no_reason' WHEN grp IS DISTINCT FROM d.source THEN 'group_changed' END AS issue FROM x LEFT JOIN documents d ON d.doc_id = x.doc_id WHERE issue IS NOT NULL""")
def exclusion_issues(spark, d):
    """Decisions that name no training row, lack a reason or changed their group."""
    docs = load(spark, d, "documents").select("doc_id", "source", hashing.split_bucket(F.col("source")).alias("split"))
    x = load(spark, d, "labels").where("toxic = 1").join(docs, "doc_id")
    x = x.select((F.col("doc_id") + F.when(F.col("doc_id") % 10 == 3, 1000000000).otherwise(0)).alias("doc_id"), F.when(F.col("quality") == 0, "toxic").alias("reason"), F.when(F.col("doc_id") % 10 == 7, "other").otherwise(F.col("source")).alias("source"))
    return audit.exclusion_issues(docs, x, "doc_id", "split", "source", "reason")


@query("SELECT CASE WHEN h = 'thther.example.org' AND regexp_matches(p, '(^|/)[0-9]+$') THEN 'mirror' WHEN contains(lower(h), 'blog.') THEN 'blog' WHEN contains(lower(h), 'www') THEN 'web' ELSE h END AS family, count(*) AS n FROM (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS h, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS p FROM pages) GROUP BY 1")
def source_families(spark, d):
    """Mirrors by file name, then tokens, else the source itself."""
    host, path = F.regexp_extract("url", "://([^/?#]*)", 1), F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)
    kind = policy.family(host, path, [("thther.example.org", "[0-9]+", "mirror")], [("blog.", "blog"), ("www", "web")])
    return load(spark, d, "pages").groupBy(kind.alias("family")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH b AS (SELECT t AS target, l_returnflag AS cls, l_quantity * 8 * s AS sw, l_linenumber * 30 * s AS sh FROM (SELECT *, least(t / 1280.0::DOUBLE, t / 720.0::DOUBLE) AS s FROM lineitem, (SELECT unnest([320, 640]) AS t))) SELECT target, cls, count(*) AS n, round(avg(sw), 6) AS mean_width, round(avg(sh), 6) AS mean_height, round(min(least(sw, sh)), 6) AS least_side, count(*) FILTER (least(sw, sh) < 32) AS n_small FROM b GROUP BY GROUPING SETS ((target, cls), (target))")
def object_sizes(spark, d):
    """Box sizes by target size and class, with totals."""
    b = load(spark, d, "lineitem").select(F.col("l_returnflag").alias("cls"), F.lit(1280.0).alias("width"), F.lit(720.0).alias("height"), (F.col("l_quantity") * 8).alias("w"), (F.col("l_linenumber") * 30).alias("h"))
    return audit.object_sizes(b, [320, 640])


_HAV = "2 * 6371000 * asin(least(1, sqrt(pow(sin(radians({y} - lat) / 2), 2) + cos(radians(lat)) * cos(radians({y})) * pow(sin(radians({x} - lon) / 2), 2))))"


@query(f"WITH g AS (SELECT c_nationkey, min(x) AS west, max(x) AS east, min(y) AS south, max(y) AS north, count(*) AS n FROM (SELECT c_nationkey, c_custkey * 37 % 3600 / 10 - 180 AS x, c_custkey * 91 % 1600 / 10 - 80 AS y FROM customer) GROUP BY 1), m AS (SELECT *, (west + east) / 2 AS lon, (south + north) / 2 AS lat FROM g) SELECT c_nationkey, n, round(lon, 6) AS lon, round(lat, 6) AS lat, round(greatest({_HAV.format(x='west', y='south')}, {_HAV.format(x='west', y='north')}, {_HAV.format(x='east', y='south')}, {_HAV.format(x='east', y='north')}), 3) AS radius_m FROM m")
def nation_extents(spark, d):
    """Bounds, centre and radius of groups of points."""
    c = load(spark, d, "customer").select("c_nationkey", (F.col("c_custkey") * 37 % 3600 / 10 - 180).alias("x"), (F.col("c_custkey") * 91 % 1600 / 10 - 80).alias("y"))
    return audit.extents(c, ["c_nationkey"], "x", "y").select("c_nationkey", "n", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.round("radius_m", 3).alias("radius_m"))


@query("WITH j AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) SELECT unnest(['rows', 'good', 'toxic', 'unlabelled', 'short', 'mixed']) AS measure, unnest([count(*), count(*) FILTER (quality = 1), count(*) FILTER (toxic = 1), count(*) FILTER (quality IS NULL), count(*) FILTER (length(text) < 500), count(*) FILTER (quality = 1 AND toxic = 1)]) AS value FROM j")
def corpus_coverage(spark, d):
    """One pass of counts over all rows."""
    j = load(spark, d, "documents").select("doc_id", "text").join(load(spark, d, "labels"), "doc_id", "left")
    q, t = F.col("quality"), F.col("toxic")
    return audit.coverage(j, {"good": q == 1, "toxic": t == 1, "unlabelled": q.isNull(), "short": F.length("text") < 500, "mixed": (q == 1) & (t == 1)})


@query("SELECT event_id, (value > 50) AND (coalesce(lag(value > 50) OVER w, false) OR coalesce(lead(value > 50) OVER w, false)) AS consensus, sum((value > 50)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) >= 3 AS voted FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def event_votes(spark, d):
    """flags held up by their neighbours."""
    e, order, flag = load(spark, d, "events"), [F.col("ts"), F.col("event_id")], F.col("value") > 50
    return e.select("event_id", audit.neighbour_consensus(e, ["user_id"], order, flag).alias("consensus"), audit.temporal_vote(["user_id"], order, flag, 2, 3).alias("voted"))


@query("SELECT vec_id, 24 AS place, 1.0::DOUBLE AS score FROM embeddings")
def signal_offsets(spark, d):
    """a part of a signal is found where it was cut."""
    e = load(spark, d, "embeddings").select("vec_id", signals.contained_offset(F.col("embedding"), F.slice("embedding", 25, 16)).alias("s"))
    return e.select("vec_id", "s.place", F.round("s.score", 6).alias("score"))


@query("SELECT doc_id, CASE WHEN source <= 'src5' THEN 'train' ELSE 'test' END AS split, used FROM (SELECT *, sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS used FROM documents) WHERE used <= 20000")
def budgeted_documents(spark, d):
    """A fixed split by range; rows of a source until its characters are spent."""
    docs = load(spark, d, "documents").select("doc_id", "source", F.length("text").cast("long").alias("size"))
    kept = audit.within_budget(docs, ["source"], [F.col("doc_id")], "size", 20000)
    return kept.select("doc_id", F.when(F.col("source") <= "src5", "train").otherwise("test").alias("split"), "used")


_PART = "('0x' || substr(h, {}, 15))::BIGINT::HUGEINT"


@query(f"WITH t AS (SELECT 'documents' AS name, sha256(concat_ws(chr(31), coalesce(doc_id::VARCHAR, chr(0)), coalesce(lang, chr(0)), coalesce(source, chr(0)))) AS h FROM documents UNION ALL SELECT 'labels', sha256(concat_ws(chr(31), doc_id::VARCHAR, quality::VARCHAR, toxic::VARCHAR)) FROM labels), s AS (SELECT name, count(*) AS rows, sum({_PART.format(1)}) AS a, sum({_PART.format(16)}) AS b FROM t GROUP BY name) SELECT name, rows, sha256(concat_ws(':', rows::VARCHAR, a::VARCHAR, b::VARCHAR)) AS digest FROM s")
def table_receipts(spark, d):
    """Checksums of tables, the same in any order."""
    docs = audit.receipt(load(spark, d, "documents"), ["doc_id", "lang", "source"]).withColumn("name", F.lit("documents"))
    return docs.unionByName(audit.receipt(load(spark, d, "labels"), ["doc_id", "quality", "toxic"]).withColumn("name", F.lit("labels")))


@query("WITH d AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE text IS NOT NULL), b AS (SELECT sha256(text) AS h FROM benchmark), a AS (SELECT (SELECT count(*) FROM b) AS items, (SELECT count(*) FROM b WHERE h IN (SELECT h FROM d)) AS train_overlap, (SELECT count(*) - count(DISTINCT h) FROM b) AS repeated) SELECT unnest(['items', 'train_overlap', 'repeated']) AS gate, unnest([items, train_overlap, repeated])::DOUBLE AS actual, unnest(['>=', '<=', '<=']) AS operator, unnest([40.0, 0.0, 0.0])::DOUBLE AS target, unnest(['error', 'error', 'warning']) AS severity, unnest([items >= 40, train_overlap <= 0, repeated <= 0]) AS passed FROM a")
def evaluation_gates(spark, d):
    """The gates of an evaluation set, given as data."""
    h = F.sha2("text", 256).alias("h")
    b = load(spark, d, "benchmark").select(h)
    seen = b.join(load(spark, d, "documents").select(h), "h", "left_semi").agg(F.count(F.lit(1)).alias("train_overlap"))
    actual = b.agg(F.count(F.lit(1)).alias("items"), (F.count(F.lit(1)) - F.countDistinct("h")).alias("repeated")).crossJoin(F.broadcast(seen))  # one row each
    gates = '[{"column": "items", "operator": ">=", "target": 40}, {"column": "train_overlap", "operator": "<=", "target": 0}, {"column": "repeated", "operator": "<=", "target": 0, "severity": "warning"}]'
    return quality.gate_table(actual, audit.gates_from(gates))


@query("SELECT count(*) AS rows, count(*) AS stated, 1::BIGINT AS stated_kinds, count(*) AS derived, count(DISTINCT o_orderdate) AS derived_kinds, 'dataset_constant_export_metadata' AS classification FROM orders")
def date_classification(spark, d):
    """A date that never varies beside dates that do."""
    return audit.date_class(load(spark, d, "orders"), F.lit("2024-01-01"), F.col("o_orderdate"))


@query(f"SELECT CASE WHEN list_has_any(string_split(lower(p), '/'), ['es', 'cache']) THEN 'rebuildable_cache' WHEN page_id % 11 = 0 THEN 'active_local' WHEN page_id % 7 = 0 THEN 'remote_available' ELSE 'unknown' END AS kind, count(*) AS n FROM (SELECT page_id, {_PATH} AS p FROM pages) GROUP BY 1")
def artifact_classes(spark, d):
    """What a path is, by the first rule that holds."""
    kind = policy.artifact_class(_path(), F.col("page_id") % 11 == 0, F.col("page_id") % 7 == 0, ["es", "cache"], [".onnx"], [".parquet"])
    return load(spark, d, "pages").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, round(avg((value <= 50)::INT), 6) AS within_50, round(avg((value <= 100)::INT), 6) AS within_100 FROM events GROUP BY 1")
def error_distances(spark, d):
    """M2, M9: mean, quantiles and shares within limits."""
    m = audit.distances(load(spark, d, "events"), ["event_type"], "value", [0.5, 0.9], [50, 100])
    return m.select("event_type", "n", *[F.round(c, 6).alias(c) for c in m.columns[2:]])


@query(f"WITH t AS (SELECT lang, source, {BUCKET} < 7000 AS train FROM documents), c AS (SELECT lang, source, count(*) AS n FROM t WHERE train AND source IS NOT NULL GROUP BY ALL), p AS (SELECT lang, arg_min(source, (-n, source)) AS prior FROM c GROUP BY lang) SELECT lang, prior, count(*) AS n FROM t JOIN p USING (lang) WHERE NOT train GROUP BY ALL")
def prior_baseline(spark, d):
    """The most frequent training source of a language, and the held-out rows that it answers for."""
    t = load(spark, d, "documents").select("lang", "source", (hashing.split_bucket(F.col("source")) == "train").alias("train"))
    prior = audit.majority(t.where("train"), ["lang"], "source")
    return t.where("NOT train").join(prior, "lang").groupBy("lang", "prior").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, n, ceil(n / 16)::BIGINT AS batches, ceil(ceil(n / 16) / 4)::BIGINT AS steps, (ceil(ceil(n / 16) / 4) * 3)::BIGINT AS all_steps, ceil(ceil(n / 16) / 4) * 3 <= 12 AS allowed FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)")
def training_plans(spark, d):
    """Batches and steps from row counts."""
    n = load(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return n.select("lang", "n", policy.training_plan(F.col("n"), 16, 4, 3, 12).alias("p")).select("lang", "n", "p.*")


_F = "sqrt(600::DOUBLE)"


@query(f"WITH c AS (SELECT c_custkey, (c_custkey * 37 % 100) / 10 - 5 AS x, (c_custkey * 91 % 100) / 10 - 5 AS y, (c_custkey % 30) / 10 AS z FROM customer), r AS (SELECT c_custkey, ((x + 10) * 10 + (y + 10) * 20 + (z - 10) * -10) / {_F} AS depth, ((x + 10) * 20 - (y + 10) * 10) / sqrt(500::DOUBLE) AS r, ((x + 10) * -10 + (y + 10) * -20 + (z - 10) * -50) / sqrt(3000::DOUBLE) AS dn FROM c) SELECT c_custkey, round(CASE WHEN depth > 0 THEN 800 * r / depth + 640 END, 6) AS u, round(CASE WHEN depth > 0 THEN 800 * dn / depth + 360 END, 6) AS v, round(depth, 6) AS depth FROM r")
def projected_points(spark, d):
    """Points seen by a pinhole camera at (-10, -10, 10) that looks along (10, 20, -10)."""
    k = F.col("c_custkey")
    point = [(k * 37 % 100) / 10 - 5, (k * 91 % 100) / 10 - 5, (k % 30) / 10]
    p = geometry.project(point, [F.lit(-10.0), F.lit(-10.0), F.lit(10.0)], [F.lit(0.0), F.lit(10.0), F.lit(0.0)], 800.0, 1280, 720)
    return load(spark, d, "customer").select(k, p.alias("p")).select(k, F.round("p.u", 6).alias("u"), F.round("p.v", 6).alias("v"), F.round("p.depth", 6).alias("depth"))


@query("SELECT conv_id, turn, CASE WHEN len(string_split(text, ', ')) <= 3 THEN len(list_filter(string_split(text, ', '), lambda s: trim(s) <> '')) + len(string_split(text, ', ')) - 1 ELSE -1 END AS n FROM conversations")
def message_parts(spark, d):
    """Texts and attachments of a prompt; -1 where their numbers differ."""
    n = F.size(F.split("text", ", ")) - 1
    files = F.slice(F.array(F.lit("a.png"), F.lit("b.png")), F.lit(1), F.least(n, F.lit(2)))
    content = policy.message_content(F.col("text"), files, ", ")
    return load(spark, d, "conversations").select("conv_id", "turn", F.when(content.isNotNull(), F.size(content)).otherwise(-1).cast("long").alias("n"))


@query("SELECT event_id, least(greatest(coalesce(CASE WHEN event_id % 3 = 0 THEN value END, 0), least(pow(2, event_id % 9), 60)), 60)::DOUBLE AS delay FROM events")
def retry_delays(spark, d):
    """The stated delay or the backoff, whichever is longer, within a limit."""
    header = F.when(F.col("event_id") % 3 == 0, F.col("value").cast("string")).when(F.col("event_id") % 3 == 1, "soon")
    return load(spark, d, "events").select("event_id", policy.retry_delay(header, F.col("event_id") % 9, 60.0).alias("delay"))


@query("SELECT l_returnflag, sum(round(l_extendedprice, 2)::DECIMAL(18, 2))::VARCHAR AS price FROM lineitem GROUP BY 1")
def decimal_totals(spark, d):
    """Exact decimal sums as plain strings."""
    price = F.round("l_extendedprice", 2).cast("decimal(18,2)")
    return load(spark, d, "lineitem").groupBy("l_returnflag").agg(F.sum(price).cast("string").alias("price"))


@query("SELECT user_id, array_to_string(list_sort(list_distinct(['u/' || user_id] || list('e/' || event_type))), ',') AS paths FROM events GROUP BY user_id")
def harvested_paths(spark, d):
    """C20: all values of fields that end in _relpath, at any depth."""
    e = load(spark, d, "events").groupBy("user_id").agg(F.collect_set(F.struct(F.concat(F.lit("e/"), "event_type").alias("mask_relpath"), F.length("event_type").alias("n"))).alias("views"))
    e = e.select("user_id", F.struct(F.concat(F.lit("u/"), "user_id").alias("image_relpath"), "views").alias("nested"))
    return e.select("user_id", F.array_join(policy.harvested(e.schema, "_relpath"), ",").alias("paths"))


@query("SELECT event_id, user_id, event_type FROM events WHERE user_id = 13 OR event_type = 'error'")
def pushed_filter(spark, d):
    """A disjunction of constants that reaches the scan's row-group statistics."""
    return load(spark, d, "events").select("event_id", "user_id", "event_type").where("user_id = 13 OR event_type = 'error'")


@query("SELECT event_id, CASE event_type WHEN 'error' THEN value * 2 WHEN 'signup' THEN 1 END AS target FROM events")
def profile_targets(spark, d):
    """The expression registered for a row's profile."""
    registry = {"error": F.col("value") * 2, "signup": F.lit(1.0)}
    return load(spark, d, "events").select("event_id", audit.dispatched(F.col("event_type"), registry).alias("target"))


@query("WITH r AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS i FROM events) SELECT user_id, event_type, event_id, array_to_string(list_filter([CASE WHEN value IS NULL OR value < 10 THEN 'low' END, CASE WHEN event_type = 'error' THEN 'error' END], lambda x: x IS NOT NULL).list_sort(), ',') AS reasons FROM r WHERE i = 1")
def first_seen(spark, d):
    """The first landed row of each id, with what stands against it."""
    e = load(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    rules = [("low", F.coalesce(F.col("value") < 10, F.lit(True))), ("error", F.col("event_type") == "error")]
    return audit.first_seen(e, "user_id", ["event_type", "event_id"], rules).select("user_id", "event_type", "event_id", F.array_join("reasons", ",").alias("reasons"))
