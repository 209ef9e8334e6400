"""Nearest neighbours by a block matrix join with int8 products.

Queries and candidates are dealt into groups of bounded size; each pair of groups is one tile and
one task's work at a time. In a tile the unit vectors are quantised to int8 and multiplied as a
matrix; the quantisation errors of the two vectors bound how far a product can be from the true
cosine, so a candidate survives where its upper bound reaches the k-th best lower bound of the
query. Only survivors are recomputed, in double precision on the original vectors. The best k of
each tile are merged per query by an ordered window, which drops the others before the shuffle.

No candidate within the true best k is lost, so recall is 1.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows with a null id; vectors are compared with those of their own length only. Rows with
one id count once, with the smallest vector. Ties go to the smaller id; a query with fewer
candidates than k gets them all. Extra columns are passed over.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

QUERY_ROWS = 2048
CANDIDATE_ROWS = 8192
EXACT_SUM = 1 << 24


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit vectors, their scales, and the length of what the codes leave out."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, error


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows: float32 holds the sums of short vectors without rounding."""
    wide = np.float32 if 127 * 127 * a.shape[1] < EXACT_SUM else np.float64
    return (a.astype(wide) @ b.astype(wide).T).astype(np.float64)


def tile(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, cosine) of the best ``k`` candidates of every query in one tile."""
    q_norm, c_norm = (np.sqrt((v * v).sum(axis=1)) for v in (queries, vectors))
    q_codes, q_scale, q_error = quantise(queries / q_norm[:, None])
    c_codes, c_scale, c_error = quantise(vectors / c_norm[:, None])
    near = products(q_codes, c_codes) * q_scale[:, None] * c_scale[None, :]
    # |<x, y> - <x', y'>| <= |x - x'| |y| + |x'| |y - y'|, with |y| = 1 and |x'| <= 1 + |x - x'|.
    bound = q_error[:, None] + (1 + q_error)[:, None] * c_error[None, :] + 1e-9
    own = query_ids[:, None] == ids[None, :]
    lower = np.where(own, -np.inf, near - bound)
    least = np.full(len(queries), -np.inf)
    if lower.shape[1] > k:
        least = np.partition(lower, -k, axis=1)[:, -k]
    survives = (near + bound >= least[:, None]) & ~own
    out_q, out_c, out_s = [], [], []
    for i in range(len(queries)):
        left = np.flatnonzero(survives[i])
        score = (vectors[left] * queries[i]).sum(axis=1) / (c_norm[left] * q_norm[i])
        best = np.lexsort((ids[left], -score))[:k]
        out_q.append(np.full(len(best), query_ids[i]))
        out_c.append(ids[left][best])
        out_s.append(score[best])
    return tuple(
        np.concatenate(part) if part else np.empty(0, kind)
        for part, kind in ((out_q, np.int64), (out_c, np.int64), (out_s, np.float64)))


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("v").combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(
        table.num_rows, -1)


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part, one per id."""
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")
    ).filter(
        F.col("id").isNotNull() & v.isNotNull() & sound & F.exists(v, lambda x: x != 0)
    ).groupBy("id").agg(F.min("v").alias("v"))


def nearest(
    vectors: DataFrame, asks: Column, k: int = 5, id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest cosine for every row that ``asks``
    (a condition on ``id``)."""
    rows = stored(usable(vectors, id_column, vector).withColumn("size", F.size("v")), "vectors")
    counts = rows.agg(F.count("*").alias("all"), F.count_if(asks).alias("asked")).first()
    columns = max(1, math.ceil(counts["all"] / CANDIDATE_ROWS))
    lines = max(1, math.ceil(counts["asked"] / QUERY_ROWS))
    own = F.xxhash64("id").bitwiseAND(F.lit((1 << 40) - 1))
    queries = rows.filter(asks).select(
        "id", "v", "size", (own % lines).cast("int").alias("line"),
        F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("block"))
    candidates = rows.select(
        "id", "v", "size", F.explode(F.sequence(F.lit(0), F.lit(lines - 1))).alias("line"),
        (own % columns).cast("int").alias("block"))

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        if asked.num_rows and held.num_rows:
            found = tile(
                asked.column("id").to_numpy(), _matrix(asked),
                held.column("id").to_numpy(), _matrix(held), k)
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    keys = ("size", "line", "block")
    best = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
