"""Centroid clustering with the threshold algorithm.

Vectors are integers, so every sum and distance is exact. Each dimension keeps the centroids sorted by their value there.
For a vector the lists are walked outward from its own value, one entry of every list per step; a centroid met for the
first time gets its exact distance, and the walk ends when the squared gaps at the frontiers add up to strictly more than
the best distance so far: no centroid that was not met can be as near. Strictly, so that equal distances are all seen and
the smaller number wins.

Every round is one pass: tasks assign their vectors and return a sum per centroid and dimension. The driver holds the
centroids and those sums (clusters x dimensions numbers), nothing of the vectors.

Defined results: vectors that are null, have another length, or hold a null or non-finite component are left out; with
fewer kept vectors than clusters each is a centroid; a null id hashes as an empty number; equal ids are ordered by their
vectors; an empty table gives no rows. Components beyond 2**62 count as that, and a distance or inertia beyond the range
of a long is given as the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled

FAR = 1 << 62
LONGEST = (1 << 63) - 1
#: Below this size of components int64 holds 64 squared gaps.
SMALL = 1 << 27
#: Vectors looked at in one vectorised step.
STEP = 2048
SUMS = "cluster int, dim int, amount decimal(38,0), members long"


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance, by the threshold algorithm."""
    n, dims = vectors.shape
    k = len(centroids)
    largest = max((int(np.abs(x).max()) for x in (vectors, centroids) if x.size), default=0)
    if largest >= SMALL:  # Python's integers keep such distances exact
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    order = np.argsort(centroids, axis=0, kind="stable")
    ranked = np.take_along_axis(centroids, order, 0)
    columns = np.arange(dims)
    above = np.stack([np.searchsorted(ranked[:, d], vectors[:, d]) for d in columns], 1)
    below = above - 1
    best = np.full(n, (FAR * 4) ** 2 * dims if vectors.dtype == object else LONGEST, vectors.dtype)
    number = np.full(n, k, np.int64)
    met = np.zeros((n, k), bool)
    walking = np.arange(n)
    while len(walking):
        v, up, down = vectors[walking], above[walking], below[walking]
        gap_up = ranked[np.minimum(up, k - 1), columns] - v
        gap_down = v - ranked[np.maximum(down, 0), columns]
        go_down = (down >= 0) & ((up >= k) | (gap_down <= gap_up))
        gap = np.where(go_down, gap_down, gap_up)
        entry = order[np.where(go_down, down, up), columns]
        above[walking], below[walking] = np.where(go_down, up, up + 1), np.where(go_down, down - 1, down)
        new = np.zeros((len(walking), k), bool)
        new[np.arange(len(walking))[:, None], entry] = True
        new &= ~met[walking]
        met[walking] |= new
        for c in range(k):
            rows = walking[new[:, c]]
            if len(rows):
                away = vectors[rows] - centroids[c]
                distance = (away * away).sum(1)
                better = (distance < best[rows]) | ((distance == best[rows]) & (c < number[rows]))
                best[rows[better]], number[rows[better]] = distance[better], c
        frontier = (gap * gap).sum(1)
        walking = walking[(frontier <= best[walking]) & ~met[walking].all(1)]
    return number, best


def vector_blocks(column: pa.Array, dims: int) -> Iterator[tuple[int, int, np.ndarray]]:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    for a in range(0, len(flat), STEP):
        yield a, min(a + STEP, len(flat)), flat[a:a + STEP]


def quantised(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id, vector`` of the kept rows: ``floor(scale * x)`` of every component as a long."""
    wide = F.col(vector_col).cast("array<double>")
    real = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(wide, lambda x: F.greatest(F.least(F.floor(x * F.lit(float(scale))), F.lit(FAR)), F.lit(-FAR)).cast("long"))
    return vectors.filter((F.size(vector_col) == dims) & real).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("vector"))


def first_centroids(kept: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose seeded id hashes lowest, in that order."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(draw.alias("draw"), "vector").orderBy("draw", "vector").limit(clusters).collect()
    return np.array([r["vector"] for r in rows], np.int64)


def cluster_sums(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per cluster and dimension the sum of its vectors' components; a task returns one row of each."""
    k, dims = centroids.shape

    def run(batches):
        sums, members = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for batch in batches:
            for _, _, block in vector_blocks(batch.column(0), dims):
                number, _ = nearest(block, centroids)
                exact = block if np.abs(block).max(initial=0) < SMALL else block.astype(object)
                for c in np.unique(number):
                    mine = number == c
                    sums[c] += exact[mine].sum(0).astype(object)
                    members[c] += int(mine.sum())
        used = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
            pa.array([Decimal(int(x)) for c in used for x in sums[c]], pa.decimal128(38, 0)),
            pa.array(np.repeat(members[used], dims), pa.int64()),
        ], ["cluster", "dim", "amount", "members"])

    return kept.select("vector").mapInArrow(run, SUMS).groupBy("cluster", "dim").agg(
        F.sum("amount").cast("decimal(38,0)").alias("amount"), F.sum("members").alias("members"),
    )


def moved(centroids: np.ndarray, sums: list) -> np.ndarray:
    """Every centroid with members at the floor of their mean; the others stay."""
    out = centroids.copy()
    for row in sums:
        out[row["cluster"], row["dim"]] = int(row["amount"]) // row["members"]
    return out


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every kept vector."""
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for a, b, block in vector_blocks(batch.column(1), dims):
                number, distance = nearest(block, centroids)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(number, pa.int32()),
                    pa.array([min(int(x), LONGEST) for x in distance], pa.int64()),
                ], ["vec_id", "cluster", "distance"])

    return kept.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    A round that moves no centroid ends the search, as all later ones would repeat it.
    """
    spark = vectors.sparkSession
    kept = settled(quantised(vectors, id_col, vector_col, dims, scale), "vectors")
    centroids = first_centroids(kept, clusters, seed)
    schema = "of_cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        empty = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty.join(spark.createDataFrame([], schema), F.col("cluster") == F.col("of_cluster")).drop("of_cluster")
    for _ in range(rounds):
        before, centroids = centroids, moved(centroids, cluster_sums(kept, centroids).collect())
        if (before == centroids).all():
            break
    found = settled(assigned(kept, centroids), "vector-clusters")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    whole = min(sum(int(r["sum"]) for r in inertia), LONGEST)
    shown = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    facts = [(r["cluster"], min(int(r["sum"]), LONGEST), whole, shown[r["cluster"]]) for r in inertia]
    # one row per cluster: the table cannot outgrow the number of clusters
    return found.join(F.broadcast(spark.createDataFrame(facts, schema)), F.col("cluster") == F.col("of_cluster")).drop("of_cluster")
