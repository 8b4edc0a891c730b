"""URL filter by a path-template tree (operator 2); built-in column functions only.

Rules decide first. What no rule fits is judged by its template: per host the path segments make a
tree, in which segments of high cardinality become wildcards, level by level as deep as paths
branch; sibling branches whose sub-templates are distributed alike are merged, from the deepest
level up; and a template is blocked where the smoothed share of blocked among rule-labelled urls
is high.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Stands for "the path ends here" among the children of a node; no segment holds it.
END = "\x00"
#: A wildcard; a segment that is just this character counts as one.
ANY = "*"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does.

    ``rules``: (verdict, "host/path"). A rule fits its host and all subdomains if the url's path
    starts with the rule's. They are compiled into one expression: keep them to some hundreds.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(set(rules), key=lambda r: (len(r[1]), r[1], r[0])):
        h, cut, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(cut + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    """The segments after the first slash; none for an empty path, an empty one for ``/``."""
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(path, "^/", ""), "/"))


def generalise(paths: DataFrame, max_kinds: int, min_share: float, min_rows: int) -> DataFrame:
    """``paths`` (host, path, segs, n, ...) with their templates ``g``, an array of labels.

    Below a node with more than ``max_kinds`` children those with less than ``min_share`` of its
    rows, or fewer than ``min_rows``, become wildcards. Level by level, since a wildcard joins the
    subtrees below it; a node with a single path left keeps the rest of it. Each level is written,
    so that the next one starts from a table; there are as many as the deepest branching.
    """
    state, done, k = paths.withColumn("g", F.array().cast("array<string>")), [], 0
    columns = [*paths.columns, "g"]
    while True:
        state = state.withColumn("s", F.coalesce(F.get("segs", F.lit(k)), F.lit(END)))
        child = state.groupBy("host", "g", "s").agg(F.sum("n").alias("cn"), F.count(F.lit(1)).alias("cp"))
        node = child.groupBy("host", "g").agg(F.count(F.lit(1)).alias("kinds"), F.sum("cn").alias("total"), F.sum("cp").alias("paths"))
        rare = (F.col("cn") < min_share * F.col("total")) | (F.col("cn") < min_rows)
        vary = (F.col("kinds") > max_kinds) & rare & (F.col("s") != END)
        named = child.join(node, ["host", "g"]).select("host", "g", "s", F.when(vary, ANY).otherwise(F.col("s")).alias("label"), "paths")
        named = written(named, f"named{k}")  # else the join below would keep all rows of a node together
        over = (F.col("paths") == 1) | (F.col("s") == END)
        rest = F.when(F.size("segs") > k, F.slice("segs", k + 1, F.greatest(F.size("segs") - k, F.lit(0)))).otherwise(F.array().cast("array<string>"))
        g = F.concat("g", F.when(over, rest).otherwise(F.array("label")))
        state = written(state.join(named, ["host", "g", "s"]).select(*paths.columns, g.alias("g"), over.alias("over")), f"level{k}")
        done.append(state.where("over").select(columns))
        state = state.where("not over").select(columns)
        if state.isEmpty():
            break
        k += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionAll(d)
    return out


def critical(df: Column, z: float) -> Column:
    """About the chi-square value that ``df`` degrees of freedom exceed as rarely as a normal one exceeds ``z``."""
    c = F.lit(2.0) / (9 * df)
    return F.when(df > 0, df * F.pow(1 - c + z * F.sqrt(c), 3)).otherwise(F.lit(0.0))


def merge(leaf: DataFrame, z: float, effect: float, overlap: float) -> DataFrame:
    """``leaf`` (host, g, n, ...) with merged labels ``m``: similar sibling branches bear one label.

    From the deepest level up, the branches of a node are compared by how their rows spread over
    their sub-templates, in which similar branches below already are one. Two are alike if the
    spreads share ``overlap`` of their mass, and a chi-square test of homogeneity at ``z`` does not
    tell them apart or, in large branches, their difference is less than ``effect`` (w). A branch
    with a larger one alike joins the largest such that has no larger one itself. A node has 50
    named branches or few more, so its pairs are bounded.
    """
    out = leaf.withColumn("m", F.col("g"))
    levels = leaf.where("size(g) > 0").select("host", "g", F.explode(F.sequence(F.lit(0), F.size("g") - 1)).alias("k"))
    nodes = levels.groupBy("k", "host", F.slice("g", 1, F.col("k")).alias("up")).agg(F.min(F.get("g", F.col("k"))).alias("one"), F.max(F.get("g", F.col("k"))).alias("other"))
    branching = [r.k for r in nodes.where("one <> other").select("k").distinct().collect()]  # at most the depth
    for k in sorted(branching, reverse=True):
        up, key = F.slice("m", 1, k), ["host", "up"]
        here = out.where(F.size("m") > k).select("host", up.alias("up"), F.get("m", F.lit(k)).alias("b"), F.slice("m", k + 2, F.greatest(F.size("m") - k - 1, F.lit(0))).alias("sub"), "n")
        spread = here.groupBy(*key, "b", "sub").agg(F.sum("n").alias("c"))
        total = spread.groupBy(*key, "b").agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("kinds"))
        several = total.groupBy(*key).agg(F.count(F.lit(1)).alias("branches")).where("branches > 1").select(*key)
        spread = written(spread.join(total, [*key, "b"]).join(several, key), f"spread{k}")
        x, y = (spread.select(*key, "sub", *[F.col(c).alias(f"{c}_{side}") for c in ("b", "c", "t", "kinds")]) for side in "xy")
        both = x.join(y, [*key, "sub"]).where("b_x < b_y")
        tx, ty, cx, cy = (F.col(c).cast("double") for c in ("t_x", "t_y", "c_x", "c_y"))
        gap = F.pow(F.sqrt(ty / tx) * cx - F.sqrt(tx / ty) * cy, 2) / (cx + cy)
        pair = both.groupBy(*key, "b_x", "b_y", "t_x", "t_y", "kinds_x", "kinds_y").agg(
            F.count(F.lit(1)).alias("same"), F.sum(gap).alias("gap"), F.sum("c_x").alias("in_x"), F.sum("c_y").alias("in_y"), F.sum(F.least(cx / tx, cy / ty)).alias("mass")
        )
        chi = F.col("gap") + ty / tx * (tx - F.col("in_x")) + tx / ty * (ty - F.col("in_y"))
        chi, df = F.round(chi, 6), F.col("kinds_x") + F.col("kinds_y") - F.col("same") - 1
        alike = pair.where((F.round("mass", 6) >= overlap) & ((chi <= critical(df, z)) | (chi <= effect * effect * (tx + ty))))
        size = lambda side: F.struct(F.col(f"t_{side}").alias("t"), F.col(f"b_{side}").alias("b"))
        larger = alike.select(*key, F.least(size("x"), size("y")).alias("low"), F.greatest(size("x"), size("y")).alias("high"))
        larger = written(larger.select(*key, F.col("low.b").alias("b"), "high"), f"alike{k}")
        led = larger.select(*key, F.col("b").alias("led")).distinct()
        joins = larger.join(led, (larger["host"] == led["host"]) & (larger["up"] == led["up"]) & (larger["high.b"] == led["led"]), "left_anti")
        joins = joins.groupBy(*key, "b").agg(F.max("high").alias("high")).select(F.col("host").alias("jh"), F.col("up").alias("ju"), F.col("b").alias("jb"), F.col("high.b").alias("into"))
        j = out.join(joins, (F.col("host") == F.col("jh")) & (up == F.col("ju")) & (F.get("m", F.lit(k)) == F.col("jb")), "left")
        m = F.when(F.col("into").isNotNull(), F.concat(up, F.array("into"), F.slice("m", k + 2, F.greatest(F.size("m") - k - 1, F.lit(0))))).otherwise(F.col("m"))
        out = written(j.withColumn("m", m).select(*leaf.columns, "m"), f"merged{k}")
    return out


def _p(blocked: Column, labelled: Column, prior: Column | float, alpha: float) -> Column:
    return (blocked + alpha * prior) / (labelled + alpha)


def judge(merged: DataFrame, alpha: float, z: float) -> DataFrame:
    """(host, g, purity): smoothed share of blocked rows of each template.

    Evidence is smoothed in steps: template <- templates merged with it <- its first branch <- same
    template on all hosts <- all rows. A template whose own labels differ from the merged ones by
    more than ``z`` standard errors stands by itself.
    """
    sums = lambda t, tag: [F.sum("lab").alias(f"lab_{tag}"), F.sum("blk").alias(f"blk_{tag}")]
    world = merged.agg(_p(F.sum("blk"), F.sum("lab"), 0.5, alpha).alias("p_all"))
    same = merged.groupBy("g").agg(*sums(merged, "s"))
    group = merged.groupBy("host", "m").agg(*sums(merged, "g"))
    first = F.coalesce(F.get("m", F.lit(0)), F.lit(END)).alias("b0")
    merged = merged.select("*", first)
    branch = merged.groupBy("host", "b0").agg(*sums(merged, "b"))
    all_of = merged.join(same, "g").join(group, ["host", "m"]).join(branch, ["host", "b0"]).crossJoin(F.broadcast(world))  # world: one row
    p, q = F.try_divide("blk", "lab"), F.try_divide("blk_g", "lab_g")
    error = F.sqrt(q * (1 - q) * (F.try_divide(F.lit(1), F.col("lab")) + F.try_divide(F.lit(1), F.col("lab_g"))))
    alike = (F.col("lab") == 0) | (F.abs(p - q) <= z * error)
    lab_g, blk_g = (F.when(alike, F.col(f"{c}_g")).otherwise(F.col(c)) for c in ("lab", "blk"))
    prior = _p(F.col("blk_b"), F.col("lab_b"), _p(F.col("blk_s"), F.col("lab_s"), F.col("p_all"), alpha), alpha)
    purity = _p(F.col("blk"), F.col("lab"), _p(blk_g, lab_g, prior, alpha), alpha)
    return all_of.select("host", "g", "m", purity.alias("purity"))


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    max_kinds: int = 12,
    min_share: float = 0.02,
    min_rows: int = 3,
    alpha: float = 4.0,
    z: float = 1.96,
    effect: float = 0.1,
    overlap: float = 0.5,
    block_at: float = 0.5,
) -> DataFrame:
    """Judge every url: ``page_id, host, path, rule, verdict, template, merged, purity``.

    ``rule`` is the longest rule that fits and decides, else null; ``template`` is the host and the
    path with wildcards, ``merged`` the template after similar branches became one. A null url or
    one without ``://`` has empty host and path, no rule, and is judged as the empty host's
    template. Rows are returned one for one, repeated ones too; an empty table gives none; other
    columns are not read. The tree is built from counts per (host, path), so a host with most of
    the rows is pre-aggregated; the one join of rows with templates has unique keys on the tree's
    side. Whole paths are read, whatever their depth.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    counts = [F.count(F.lit(1)).alias("n"), F.count("ruled").alias("lab"), F.count_if(F.col("ruled") == "block").alias("blk")]
    paths = rows.groupBy("host", "path").agg(*counts).withColumn("segs", segments(F.col("path")))
    paths = written(generalise(written(paths, "paths"), max_kinds, min_share, min_rows).select("host", "path", "g", "n", "lab", "blk"), "templates")
    leaf = written(paths.groupBy("host", "g").agg(*[F.sum(c).alias(c) for c in ("n", "lab", "blk")]), "leaf")
    judged = written(judge(merge(leaf, z, effect, overlap), alpha, z), "judged")
    shown = lambda c: F.concat("host", F.when(F.size(c) > 0, F.concat(F.lit("/"), F.array_join(c, "/"))).otherwise(F.lit("")))
    judged = paths.select("host", "path", "g").join(judged, ["host", "g"]).select("host", "path", shown("g").alias("template"), shown("m").alias("merged"), "purity")
    own = F.when(F.col("purity") >= block_at, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(judged, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template", "merged", "purity")
