"""Dense vectors: normalisation and exact top-k by blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.session import ship_package

BLOCK = 4096


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """Vector of length one; a zero vector stays zero."""
    n = norm(v)
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def top_k(queries: DataFrame, corpus: DataFrame, key: str, vector: str, k: int = 10, normalize: bool = True, skip_self: bool = True) -> DataFrame:
    """Exact ``k`` nearest rows of ``corpus`` for every query: ``(query_id, hit_id, rank, score)``.

    Queries are a stated set; they are read in blocks of BLOCK vectors, and each block is multiplied with every corpus
    batch. Each task keeps only its own best ``k`` per query, so k rows per query and task are shuffled.
    """
    ship_package(corpus.sparkSession)
    spark = corpus.sparkSession
    size = lambda x: np.linalg.norm(x, axis=1, keepdims=True) if normalize else 1.0
    blocks, ids, rows = [], [], []
    for r in queries.select(F.col(key).cast("bigint"), vector).where(F.col(vector).isNotNull()).toLocalIterator():
        ids.append(r[0])
        rows.append(r[1])
        if len(ids) == BLOCK:
            blocks.append((np.array(ids), np.array(rows, dtype=np.float64)))
            ids, rows = [], []
    if ids:
        blocks.append((np.array(ids), np.array(rows, dtype=np.float64)))
    schema = "query_id bigint, hit_id bigint, score double"
    out = None
    for q_ids, q in blocks:
        sent = spark.sparkContext.broadcast((q_ids, q / np.maximum(size(q), 1e-300)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            q_ids, q = sent.value
            best_s = np.full((len(q), k), -np.inf)
            best_i = np.full((len(q), k), -1, np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                i = batch.column(0).to_numpy()
                v = np.array(batch.column(1).to_pylist(), dtype=np.float64)
                s = q @ (v / np.maximum(size(v), 1e-300)).T
                if skip_self:
                    s[q_ids[:, None] == i[None, :]] = -np.inf
                all_s = np.concatenate([best_s, s], axis=1)
                all_i = np.concatenate([best_i, np.broadcast_to(i, s.shape)], axis=1)
                order = np.lexsort((all_i, -np.round(all_s, 9)), axis=1)[:, :k]
                best_s, best_i = np.take_along_axis(all_s, order, 1), np.take_along_axis(all_i, order, 1)
            keep = np.isfinite(best_s)
            rows = np.nonzero(keep)
            yield pa.record_batch({"query_id": q_ids[rows[0]], "hit_id": best_i[keep], "score": best_s[keep]})

        part = corpus.select(F.col(key).cast("bigint").alias("id"), vector).where(F.col(vector).isNotNull()).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query_id bigint, hit_id bigint, rank int, score double")
    best = out.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.round("score", 9)).alias("s"), "hit_id"))), 1, k).alias("b"))
    return best.select("query_id", F.posexplode("b").alias("r", "x")).select("query_id", F.col("x.hit_id").alias("hit_id"), (F.col("r") + 1).alias("rank"), F.round(-F.col("x.s"), 4).alias("score"))
