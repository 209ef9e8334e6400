"""Exact k-means on integer vectors, assigned by shallot search.

Components become floor(scale * x), so that distances, sums and centroids are integers and a run gives
the same result however the vectors are dealt out. Every vector carries its centroid, the centroid that
was second nearest, and two bounds: no more than ``upper`` from the first, no less than ``lower``
from any other. Centroids move between rounds; the bounds give way by as much. Then:

1. where ``upper`` stays below ``lower``, or below half the way to the centroid's nearest neighbour,
   nothing can have changed; nor where that holds once ``upper`` is measured anew;
2. else the remembered second centroid is measured as well, and the search starts from the closer of
   the two, along its neighbours sorted by distance from it;
3. a neighbour farther from the start than the vector is, plus the vector's second-best distance so
   far, cannot come in: the ball ends there, and it shrinks with every better second found;
4. neighbours inside are compared by their squared distances in integers, ties to the smaller number.

Bounds are in floating point with a margin, and only ever spare work. Tasks add up which vectors came
and went, by centroid; only those sums, k rows of components, meet on the driver each round. The state
is written to the shared folder every round and the round before it removed.

Defined results: vectors that are null, of another length, hold null or non-finite components, or
components of ``LIMIT`` or more after scaling (their distances would not fit into 64 bits) take no
part. Rows with a null id do, but start no centroid while others can. Repeated rows are vectors of their
own. With fewer vectors than centroids there are as many centroids as vectors. Extra columns are passed
over.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, stored

LIMIT = 1 << 27
MARGIN = 1e-6
STATE = "id long, v array<int>, cluster int, second int, upper double, lower double, before int"


def usable(
    vectors: DataFrame, dims: int, scale: int, id_column: str, vector: str,
) -> DataFrame:
    """(id, v) of the vectors that take part, as integers."""
    v = F.col("v")
    bound = LIMIT / scale
    sound = F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < bound), F.lit(False)))
    return vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")
    ).filter((F.size(v) == dims) & sound).select(
        "id", F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v"))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


class Geometry:
    """What a round needs to know about the centroids."""

    def __init__(self, centroids: np.ndarray, moved: np.ndarray):
        k = len(centroids)
        self.centroids, self.moved = centroids, moved
        self.apart = np.sqrt(np.stack([squared(centroids, c) for c in centroids]).astype(float))
        np.fill_diagonal(self.apart, -1)
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        np.fill_diagonal(self.apart, 0)
        self.half = self.apart[np.arange(k), self.order[:, 1]] / 2 if k > 1 else np.zeros(k)
        most = np.tile(moved, (k, 1))
        np.fill_diagonal(most, 0)
        self.others_moved = most.max(axis=1)


def assign(vectors: np.ndarray, state: tuple, g: Geometry) -> tuple[tuple, int]:
    """The state (centroid, second, upper, lower) after the centroids moved, and how many distances
    were measured."""
    cluster, second, upper, lower = (np.array(s) for s in state)
    k, c = len(g.centroids), g.centroids
    if k == 1:
        return (cluster, second, np.zeros(len(vectors)), lower), 0
    upper += g.moved[cluster]
    lower -= g.others_moved[cluster]
    rows = np.flatnonzero(upper >= np.maximum(lower, g.half[cluster]) - MARGIN)
    best_d = squared(vectors[rows], c[cluster[rows]])
    upper[rows] = np.sqrt(best_d)
    left = upper[rows] >= np.maximum(lower[rows], g.half[cluster[rows]]) - MARGIN
    measured = len(rows)
    rows, best_d = rows[left], best_d[left]
    best, next_ = cluster[rows], second[rows]
    next_d = squared(vectors[rows], c[next_])
    measured += len(rows)
    swap = (next_d < best_d) | ((next_d == best_d) & (next_ < best))
    best, next_ = np.where(swap, next_, best), np.where(swap, best, next_)
    best_d, next_d = np.where(swap, next_d, best_d), np.where(swap, best_d, next_d)
    start, known, reach = best.copy(), next_.copy(), np.sqrt(best_d)
    active = np.arange(len(rows))
    for t in range(1, k):
        j = g.order[start[active], t]
        ball = (reach[active] + np.sqrt(next_d[active])) * (1 + 1e-12) + MARGIN
        inside = g.apart[start[active], j] <= ball
        active, j = active[inside], j[inside]
        if not len(active):
            break
        fresh = j != known[active]
        at, j = active[fresh], j[fresh]
        d = squared(vectors[rows[at]], c[j])
        measured += len(at)
        first = (d < best_d[at]) | ((d == best_d[at]) & (j < best[at]))
        other = ~first & ((d < next_d[at]) | ((d == next_d[at]) & (j < next_[at])))
        to = at[first]
        next_[to], next_d[to] = best[to], best_d[to]
        best[to], best_d[to] = j[first], d[first]
        to = at[other]
        next_[to], next_d[to] = j[other], d[other]
    cluster[rows], second[rows] = best, next_
    upper[rows], lower[rows] = np.sqrt(best_d), np.sqrt(next_d)
    return (cluster, second, upper, lower), measured


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _round(state: DataFrame, g: Geometry, dims: int) -> DataFrame:
    names = [f.split()[0] for f in STATE.split(", ")]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            of = {name: batch.column(name) for name in names}
            old = tuple(of[n].to_numpy(zero_copy_only=False) for n in ("cluster", "second", "upper", "lower"))
            new, _ = assign(_matrix(of["v"], dims), old, g)
            came_from = of["cluster"] if (of["upper"][0].as_py() != float("inf")) else pa.array(
                np.full(batch.num_rows, -1, np.int32))
            yield pa.RecordBatch.from_arrays([
                of["id"], of["v"], pa.array(new[0].astype(np.int32)), pa.array(new[1].astype(np.int32)),
                pa.array(new[2]), pa.array(new[3]), came_from], names)

    return state.mapInArrow(run, STATE)


def _changes(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """By how much the counts and componentwise sums of the centroids changed in the last round."""
    def run(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"), dims)
            for name, sign in (("cluster", 1), ("before", -1)):
                at = batch.column(name).to_numpy()
                for c in range(k):
                    here = at == c
                    sums[c] += sign * v[here].sum(axis=0)
                    counts[c] += sign * np.count_nonzero(here)
        full = np.column_stack([counts, sums])
        c, d = np.nonzero(full)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c), pa.array(d), pa.array(full[c, d])], ["cluster", "part", "total"])

    changed = state.filter("cluster <> before").select("v", "cluster", "before")
    found = changed.mapInArrow(run, "cluster long, part long, total long").groupBy(
        "cluster", "part").agg(F.sum("total").alias("total")).collect()
    full = np.zeros((k, dims + 1), object)
    for r in found:
        full[r["cluster"], r["part"]] = r["total"]
    return full[:, 0], full[:, 1:]


def seeded(rows: DataFrame, k: int, order: Column) -> np.ndarray:
    """The first ``k`` vectors by ``order``; ties by components, null ids last."""
    first = rows.orderBy(F.asc_nulls_last(order), "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024,
    seed: int = 3, id_column: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``) of every
    vector that takes part, after ``rounds`` rounds and a last assignment."""
    rows = stored(usable(vectors, dims, scale, id_column, vector), "vectors")
    spark = vectors.sparkSession
    centroids = seeded(rows, k, F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    k = len(centroids)
    out = f"{id_column} long, cluster int, distance long"
    final = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not k:
        return spark.createDataFrame([], f"{out}, {final.removeprefix('cluster int, ')}")
    state = rows.select(
        "id", "v", F.lit(0).alias("cluster"), F.lit(min(1, k - 1)).alias("second"),
        F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"), F.lit(-1).alias("before"))
    counts, sums, moved = np.zeros(k, object), np.zeros((k, dims), object), np.zeros(k)
    for done in range(rounds + 1):
        new = stored(_round(state, Geometry(centroids, moved), dims), "assigned")
        discard(state if done else rows)
        state = new
        if done < rounds:
            n, s = _changes(state, k, dims)
            counts, sums = counts + n, sums + s
            old, centroids = centroids, centroids.copy()
            for c in np.flatnonzero(counts > 0):
                centroids[c] = [int(x) // int(counts[c]) for x in sums[c]]
            moved = np.sqrt(squared(centroids, old).astype(float)) * (1 + 1e-12)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                at = batch.column("cluster").to_numpy()
                d = squared(_matrix(batch.column("v"), dims), centroids[at])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("cluster"), pa.array(d)],
                    [id_column, "cluster", "distance"])

    found = stored(state.select("id", "v", "cluster").mapInArrow(run, out), "distances")
    discard(state)
    totals = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())
    named = spark.createDataFrame([
        (c, totals.get(c, 0), sum(totals.values()),
         hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c in range(k)], final)
    # One row for each of the k centroids.
    return found.join(F.broadcast(named), "cluster").select(
        id_column, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
