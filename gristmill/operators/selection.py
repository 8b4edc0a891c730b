"""Matching, greedy selection, closures and reconciliation (survey 2.C, 2.D, 2.E, 2.G, 2.J, 2.K, 2.L)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


def nearest_in_time(left: DataFrame, right: DataFrame, key: str, most_s: float) -> DataFrame:
    """One-to-one pairs within ``most_s`` seconds, greedy by (gap, left id, right id).

    ``left``, ``right``: key, id, t (seconds). Candidates come from an equi-join on the key and
    time buckets; the greedy choice is sequential within a key.
    """
    size = max(most_s, 1e-9)
    cell = F.floor(F.col("t") / size)
    a = left.select(key, F.col("id").alias("a"), F.col("t").alias("ta"), cell.alias("cell"))
    b = right.select(key, F.col("id").alias("b"), F.col("t").alias("tb"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    pairs = a.join(b, [key, "cell"]).select(key, "a", "b", F.abs(F.col("ta") - F.col("tb")).alias("gap")).where(F.col("gap") <= most_s)

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        used_a, used_b, out = set(), set(), []
        for r in pdf.sort_values(["gap", "a", "b"]).itertuples(index=False):
            if r.a not in used_a and r.b not in used_b:
                used_a.add(r.a)
                used_b.add(r.b)
                out.append(r)
        return pd.DataFrame(out, columns=pdf.columns)

    return pairs.groupBy(key).applyInPandas(match, pairs.schema)


def match_boxes(truth: DataFrame, predictions: DataFrame, least: float) -> DataFrame:
    """Per image and class, predictions by falling score take the best free box with IoU >= least.

    truth: image, cls, box id ``t``, box; predictions: image, cls, ``p``, score, box. Returns
    image, p, t, iou for the pairs.
    """
    a = predictions.groupBy("image", "cls").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "p", "box"))).alias("ps"))
    b = truth.groupBy("image", "cls").agg(F.sort_array(F.collect_list(F.struct("t", "box"))).alias("ts"))

    def run(batches):
        for pdf in batches:
            out = []
            for image, ps, ts in zip(pdf["image"], pdf["ps"], pdf["ts"], strict=True):
                free = {t["t"]: t["box"] for t in ts}
                for p in ps:
                    best = max(((_iou(p["box"], box), -t) for t, box in free.items()), default=(0.0, 0))
                    if best[0] >= least:
                        out.append((image, p["p"], -best[1], best[0]))
                        del free[-best[1]]
            yield pd.DataFrame(out, columns=["image", "p", "t", "iou"])

    return a.join(b, ["image", "cls"]).select("image", "ps", "ts").mapInPandas(run, "image long, p long, t long, iou double")


def _iou(a, b) -> float:
    w = max(0.0, min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]))
    h = max(0.0, min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]))
    union = a[2] * a[3] + b[2] * b[3] - w * h
    return w * h / union if union > 0 else 0.0


def admitted(candidates: DataFrame, group: str, order: list[str], sig: str, radius: int, cap: int) -> DataFrame:
    """Rows of each group in order, skipping near signatures of admitted ones, up to a cap."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        kept, sigs = [], np.zeros(0, dtype=np.uint64)
        for i, s in enumerate(pdf[sig].to_numpy(np.int64).view(np.uint64)):
            if len(kept) == cap:
                break
            if not len(sigs) or np.bitwise_count(sigs ^ s).min() > radius:
                kept.append(i)
                sigs = np.append(sigs, s)
        return pdf.iloc[kept]

    return candidates.groupBy(group).applyInPandas(run, candidates.schema)


def capped_share(df: DataFrame, group: str, order: list[Column], most: float, max_rounds: int = 10_000) -> DataFrame:
    """Remove rows of the largest group, last in order first, until no group exceeds the share.

    The loop runs over counts alone, one number a group; the rows are cut once at the end.
    """
    counts = {r[0]: r[1] for r in df.groupBy(group).count().collect()}  # one row a group, by contract few
    for _ in range(max_rounds):
        total = sum(counts.values())
        top = max(counts, key=lambda k: (counts[k], str(k)), default=None)
        if top is None or counts[top] <= most * total or len(counts) == 1:
            break
        counts[top] -= max(1, int(np.ceil((counts[top] - most * total) / (1 - most))))
    else:
        raise RuntimeError(f"no group's share settled below {most} in {max_rounds} rounds")
    from .ordering import top_per_key

    quota = df.sparkSession.createDataFrame(list(counts.items()), f"{group} {dict(df.dtypes)[group]}, __k long")
    return top_per_key(df.join(quota, group), [group], order, F.col("__k")).drop("__k", "rank")


def negative_budget(base: int, positives: int, negatives: int, share: float = 0.12) -> int:
    """Negatives that may be added so that they stay within ``share``."""
    return max(0, int(np.floor((share * (base + positives) - (1 - share) * negatives) / (1 - share))))


def closure(seed: DataFrame, links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Names reached from ``seed`` (name) by binding sets ``links`` (set_id, name): a set that meets the
    reached names adds all of its own, until nothing is added (J4, J5, K15)."""
    reached = written(seed.select("name").distinct(), "reached")
    n = reached.count()
    for _ in range(max_rounds):
        hit = links.join(reached, "name", "left_semi").select("set_id").distinct()
        reached = written(links.join(hit, "set_id", "left_semi").select("name").union(reached).distinct(), "reached")
        m = reached.count()
        if m == n:
            return reached
        n = m
    raise RuntimeError("the closure did not settle")


def locked_split(members: DataFrame, locks: DataFrame, fallback: Column) -> tuple[DataFrame, DataFrame]:
    """(component splits, conflicts): a component takes the one split its locked members have, else
    ``fallback`` of its ``component``; two locks are a conflict (K14).

    members: component, name; locks: name, split.
    """
    found = members.join(locks, "name", "left").groupBy("component").agg(F.array_sort(F.collect_set("split")).alias("locks"))
    split = F.when(F.size("locks") == 1, F.get("locks", 0)).otherwise(fallback)
    return found.where(F.size("locks") <= 1).select("component", split.alias("split")), found.where(F.size("locks") > 1)


def agreed(*columns: Column) -> Column:
    """(value, state): ``agreed`` if all present values are equal, ``missing`` without any, else
    ``conflict`` (L13, J8)."""
    values = F.array_distinct(F.array_compact(F.array(*columns)))
    state = F.when(F.size(values) == 0, "missing").when(F.size(values) == 1, "agreed").otherwise("conflict")
    return F.struct(F.when(F.size(values) == 1, F.get(values, 0)).alias("value"), state.alias("state"))


def reconciled(evidence: DataFrame, key: str, weak: list[str]) -> DataFrame:
    """accepted, rejected, conflict or needs_review from accept and reject evidence; weak reasons
    do not reject (L15). evidence: key, verdict, reason."""
    yes = F.coalesce(F.bool_or(F.col("verdict") == "accept"), F.lit(False))
    no = F.coalesce(F.bool_or((F.col("verdict") == "reject") & ~F.coalesce(F.col("reason").isin(weak), F.lit(False))), F.lit(False))
    state = F.when(yes & no, "conflict").when(yes, "accepted").when(no, "rejected").otherwise("needs_review")
    return evidence.groupBy(key).agg(state.alias("state"))


def sampling_mass(df: DataFrame, role: str, origin: str, source: str, targets: dict[str, float]) -> DataFrame:
    """(role, origin, source, n, mass): role target, shared over origins, over sources by sqrt(n)."""
    n = df.groupBy(role, origin, source).agg(F.count(F.lit(1)).alias("n"))
    origins = n.groupBy(role).agg(F.countDistinct(origin).alias("__o"))
    roots = n.groupBy(role, origin).agg(F.sum(F.sqrt("n")).alias("__r"))
    goal = F.lit(0.0)
    for k, v in targets.items():
        goal = F.when(F.col(role) == k, F.lit(v)).otherwise(goal)
    j = n.join(origins, role).join(roots, [role, origin])
    return j.select(role, origin, source, "n", (goal / F.col("__o") * F.sqrt("n") / F.col("__r")).alias("mass"))


def yolo_boxes(text: Column, classes: int) -> Column:
    """Boxes of ``class x y w h`` lines in unit coordinates; lines that break a rule are left out."""
    parts = F.transform(F.split(text, "\n"), lambda s: F.transform(F.split(F.trim(s), r"\s+"), lambda v: v.try_cast("double")))
    good = F.filter(parts, lambda p: (F.size(p) == 5) & F.forall(p, lambda v: v.isNotNull() & ~F.isnan(v)) & (F.get(p, 0) >= 0) & (F.get(p, 0) < classes) & F.forall(F.slice(p, 2, 4), lambda v: (v >= 0) & (v <= 1)))
    return F.transform(good, lambda p: F.struct(F.get(p, 0).cast("int").alias("cls"), F.slice(p, 2, 4).alias("box")))


def size_class(areas: Column, small: float, large: float) -> Column:
    """none, small, contextual or mixed by the least and largest box area."""
    return F.when(F.size(areas) == 0, "none").when(F.array_max(areas) < small, "small").when(F.array_min(areas) >= large, "contextual").otherwise("mixed")


def offset_role(seconds: Column) -> Column:
    """pre up to -300 s, ambiguous up to 0, then post (C17)."""
    return F.when(seconds <= -300, "pre").when(seconds <= 0, "ambiguous").otherwise("post")
