"""A stated query set against all rows, in blocks (survey 2.D, 2.F).

Queries are shared with the tasks a block at a time, so a broadcast has a fixed size; every task
passes its rows once a block and keeps what each query needs: its nearest, its best k, a count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import top_per_key

#: Queries of a block, and rows compared with a block at a time.
QUERIES, ROWS = 4096, 1024


def in_blocks(queries: DataFrame, key: str, one: Callable[[list], DataFrame], empty: DataFrame) -> DataFrame:
    """The union of ``one(rows of a block of queries)`` over all blocks, ``empty`` without any."""
    blocks = -(-queries.count() // QUERIES)
    out = empty
    for i in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == i).orderBy(key).collect()
        if rows:
            out = out.unionAll(one(rows))
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def nearest_signature(queries: DataFrame, reference: DataFrame, id_col: str = "id", sig_col: str = "sig") -> DataFrame:
    """Per query the reference with the least distance, ties to the smaller id."""
    ref = reference.select(F.col(id_col).cast("long").alias("b"), F.col(sig_col).alias("sb")).where("b is not null and sb is not null")
    schema = "a long, distance int, b long"

    def one(rows: list) -> DataFrame:
        shared = ref.sparkSession.sparkContext.broadcast(np.array([(r[0], r[1]) for r in rows], dtype=np.int64))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a, sa = shared.value[:, 0], shared.value[:, 1].copy().view(np.uint64)
            far, best = np.full(len(a), 65, dtype=np.int64), np.zeros(len(a), dtype=np.int64)
            for c in _chunks(batches):
                b, sb = (c.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                order = np.argsort(b, kind="stable")  # the first of equally near ones has the least id
                d = np.bitwise_count(sa[:, None] ^ sb[order].view(np.uint64)[None, :]).astype(np.int64)
                at = d.argmin(axis=1)
                low, who = d[np.arange(len(a)), at], b[order][at]
                better = (low < far) | ((low == far) & (who < best))
                far, best = np.where(better, low, far), np.where(better, who, best)
            seen = far < 65
            yield pa.RecordBatch.from_arrays([pa.array(a[seen]), pa.array(far[seen].astype(np.int32)), pa.array(best[seen])], names=["a", "distance", "b"])

        return ref.mapInArrow(run, schema)

    found = in_blocks(queries.select(F.col(id_col).cast("long").alias("a"), sig_col).where(F.col(sig_col).isNotNull()), "a", one, ref.sparkSession.createDataFrame([], schema))
    near = found.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("m"))
    return near.select("a", F.col("m.b").alias("b"), F.col("m.distance").alias("distance"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _usable(rows: DataFrame, vec: str, width: int) -> DataFrame:
    return rows.where((F.size(vec) == width) & ~F.exists(vec, lambda x: x.isNull()))


def dot_top_k(queries: DataFrame, reference: DataFrame, k: int, width: int) -> DataFrame:
    """``a, b, rank``: the k references with the largest dot products, ties to the smaller id.

    queries: a, x; reference: b, y; vectors of ``width`` numbers, others take no part. A row does
    not meet itself (a = b). Products are rounded to 9 places.
    """
    ref = _usable(reference.select(F.col("b").cast("long"), "y").where("b is not null"), "y", width)
    schema = "a long, b long, score double"

    def one(rows: list) -> DataFrame:
        shared = ref.sparkSession.sparkContext.broadcast((np.array([r.a for r in rows]), np.array([r.x for r in rows], dtype=np.float64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a, x = shared.value
            held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            floor = np.full(len(a), -np.inf)
            for c in _chunks(batches):
                b = c.column(0).to_numpy(zero_copy_only=False)
                s = np.round(x @ _matrix(c.column(1), width).T, 9)
                s[a[:, None] == b[None, :]] = -np.inf
                q, at = np.nonzero((s >= floor[:, None]) & (s > -np.inf))
                held = [np.concatenate(p) for p in zip(held, (q, b[at], s[q, at]), strict=True)]
                order = np.lexsort((held[1], -held[2], held[0]))
                held = [p[order] for p in held]
                first = np.searchsorted(held[0], held[0])
                keep = np.arange(len(first)) - first < k
                held = [p[keep] for p in held]
                full = np.bincount(held[0], minlength=len(a)) == k
                last = np.searchsorted(held[0], np.arange(len(a)), "right") - 1
                floor = np.where(full, held[2][np.maximum(last, 0)] if len(held[0]) else floor, -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(a[held[0]]), pa.array(held[1]), pa.array(held[2])], names=["a", "b", "score"])

        return ref.mapInArrow(run, schema)

    queries = _usable(queries.select(F.col("a").cast("long"), "x").where("a is not null"), "x", width)
    found = in_blocks(queries, "a", one, ref.sparkSession.createDataFrame([], schema))
    return top_per_key(found, ["a"], [F.desc("score"), F.col("b")], k).select("a", "b", "rank")


def first_hit_rank(queries: DataFrame, reference: DataFrame, width: int) -> DataFrame:
    """``a, first``: the rank among all references, by falling dot product and id, of the first with
    the query's label (F14, M10); null if none has it.

    queries: a, x, la; reference: b, y, lb. Nothing is ranked: the best right one is looked up, then
    those before it are counted.
    """
    ref = _usable(reference.select(F.col("b").cast("long"), "y", F.col("lb").cast("string")).where("b is not null"), "y", width)
    queries = _usable(queries.select(F.col("a").cast("long"), "x", F.col("la").cast("string")).where("a is not null"), "x", width)
    spark = ref.sparkSession

    def pass_over(rows: list, best: dict | None) -> DataFrame:
        given = [(best or {}).get(r.a, (np.inf, 0)) for r in rows]
        shared = spark.sparkContext.broadcast((np.array([r.a for r in rows]), np.array([r.x for r in rows], dtype=np.float64), np.array([r.la or "" for r in rows]), np.array([g[0] for g in given]), np.array([g[1] for g in given], dtype=np.int64)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a, x, la, top, who = shared.value
            score, at_b, count = np.full(len(a), -np.inf), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
            for c in _chunks(batches):
                b = c.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(b, kind="stable")
                s = np.round(x @ _matrix(c.column(1), width).T, 9)[:, order]
                b, lb = b[order], np.array(c.column(2).to_pylist(), dtype=object)[order]
                s[a[:, None] == b[None, :]] = -np.inf
                if best is None:
                    s[la[:, None].astype(object) != lb[None, :]] = -np.inf
                    at = s.argmax(axis=1)
                    low, got = s[np.arange(len(a)), at], b[at]
                    better = (low > score) | ((low == score) & (low > -np.inf) & (got < at_b))
                    score, at_b = np.where(better, low, score), np.where(better, got, at_b)
                else:
                    count += ((s > top[:, None]) | ((s == top[:, None]) & (b[None, :] < who[:, None]))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(score), pa.array(at_b), pa.array(count)], names=["a", "score", "b", "n"])

        return ref.mapInArrow(run, "a long, score double, b long, n long")

    def one(rows: list) -> DataFrame:
        top = pass_over(rows, None).where(F.col("score") > float("-inf")).groupBy("a").agg(F.min(F.struct((-F.col("score")).alias("s"), "b")).alias("m"))
        best = {r.a: (-r.m.s, r.m.b) for r in top.collect()}  # a block of queries at most
        counts = pass_over(rows, best).groupBy("a").agg(F.sum("n").alias("n"))
        found = spark.createDataFrame([(r.a, r.a in best) for r in rows], "a long, has boolean")
        return found.join(counts, "a", "left").select("a", F.when(F.col("has"), F.coalesce("n", F.lit(0)) + 1).alias("first"))

    return in_blocks(queries, "a", one, spark.createDataFrame([], "a long, first long"))
