"""Spherical K-Means for all K and all starts at once, and the cosine silhouette from cluster sums.

The centroids of every model (K from ``k_min`` to ``k_max``, several starts each) are stacked to one matrix. A pass over the
vectors multiplies each Arrow batch with it once, takes the nearest centroid per model and returns sums per centroid, so
one round of all models costs one scan; the number of scans is that of one model. Silhouettes of all chosen models are one
more scan: the mean cosine distance of a vector to a cluster follows from the cluster's sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS, TOLERANCE = 20, 1e-4
#: Rows from which first centroids are drawn; a documented bound, as everything after them uses all rows.
INIT_ROWS = 4096
#: Vectors multiplied at once.
BLOCK = 1024


@dataclass(frozen=True)
class Spherical:
    """A fitted model: unit centroids, and the sum of 1 - cosine over all rows."""

    centres: np.ndarray
    cost: float

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 - the name that fitted Spark models have
        return list(self.centres)


def blocks(column: pa.Array):
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(column), -1)
    for a in range(0, len(rows), BLOCK):
        yield rows[a:a + BLOCK]


def first_centroids(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ by cosine distance on a sample of unit vectors."""
    chosen = [int(rng.integers(len(sample)))]
    nearest = 1 - sample @ sample[chosen[0]]
    for _ in range(k - 1):
        weight = np.clip(nearest, 0, None) ** 2
        weight[chosen] = 0
        total = weight.sum()
        spare = [i for i in range(len(sample)) if i not in chosen] if not total else None
        pick = int(rng.choice(len(sample), p=weight / total)) if total else int(spare[0] if spare else chosen[-1])
        chosen.append(pick)
        nearest = np.minimum(nearest, 1 - sample @ sample[pick])
    return sample[chosen].copy()


def centroid_sums(vectors: DataFrame, stacked: np.ndarray, ends: Sequence[int]) -> dict[int, tuple[np.ndarray, int, float]]:
    """Per centroid of every model: sum of its vectors, their number, and their summed cosine distance. One scan.

    What comes back is one row per centroid, whatever the number of vectors.
    """
    starts = [0, *ends[:-1]]

    def run(batches):
        sums, members, costs = np.zeros_like(stacked), np.zeros(len(stacked), np.int64), np.zeros(len(stacked))
        for batch in batches:
            for x in blocks(batch.column(0)):
                cosines = x @ stacked.T
                mine = np.zeros((len(x), len(stacked)))
                rows = np.arange(len(x))
                for a, b in zip(starts, ends):
                    best = a + cosines[:, a:b].argmax(1)
                    mine[rows, best] = 1.0
                    costs += np.bincount(best, 1 - cosines[rows, best], len(stacked))
                sums += mine.T @ x
                members += mine.sum(0).astype(np.int64)
        used = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array(list(sums[used]), pa.list_(pa.float64())), pa.array(members[used]), pa.array(costs[used]),
        ], ["centroid", "total", "members", "cost"])

    found = vectors.mapInArrow(run, "centroid int, total array<double>, members long, cost double").groupBy("centroid").agg(
        vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"), F.sum("members").alias("members"), F.sum("cost").alias("cost"),
    )
    return {r["centroid"]: (np.array(r["total"]), r["members"], r["cost"]) for r in found.collect()}


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def fit_all(vectors: DataFrame, ks: Sequence[int], starts: int, seed: int, rounds: int = ROUNDS) -> dict[tuple[int, int], Spherical]:
    """Models by (K, start) for a frame whose one column holds unit vectors as ``array<double>``.

    First centroids are drawn from the ``INIT_ROWS`` rows with the smallest hash. A model whose centroids have come to rest
    leaves the scan; a cluster that loses all rows keeps its centroid.
    """
    [name] = vectors.columns
    sample = np.array([r[0] for r in vectors.orderBy(F.xxhash64(name), name).limit(INIT_ROWS).collect()])
    now = {(k, s): first_centroids(sample, k, np.random.default_rng([seed, k, s])) for k in ks for s in range(starts)}
    done: dict[tuple[int, int], Spherical] = {}
    for turn in range(rounds + 1):
        active = [m for m in now if m not in done]
        if not active:
            break
        ends = np.cumsum([m[0] for m in active]).tolist()
        found = centroid_sums(vectors, np.concatenate([now[m] for m in active]), ends)
        for model, end in zip(active, ends):
            first = end - model[0]
            cost = sum(found[c][2] for c in range(first, end) if c in found)
            old = now[model]
            new = np.array([unit(found[c][0]) if c in found else old[c - first] for c in range(first, end)])
            if turn == rounds or np.abs(new - old).max() < TOLERANCE:
                done[model] = Spherical(old, cost)
            else:
                now[model] = new
    return done


def silhouettes(vectors: DataFrame, models: dict[int, np.ndarray]) -> dict[int, float]:
    """Mean cosine silhouette of each model; two scans for all of them. A row alone in its cluster counts 0."""
    names = list(models)
    stacked = np.concatenate([models[n] for n in names])
    ends = np.cumsum([len(models[n]) for n in names]).tolist()
    found = centroid_sums(vectors, stacked, ends)
    dims = stacked.shape[1]
    sums = np.array([found[c][0] if c in found else np.zeros(dims) for c in range(len(stacked))])
    members = np.array([found[c][1] if c in found else 0 for c in range(len(stacked))], float)
    starts = [0, *ends[:-1]]

    def run(batches):
        total, rows_seen = np.zeros(len(names)), 0
        for batch in batches:
            for x in blocks(batch.column(0)):
                cosines, rows = x @ stacked.T, np.arange(len(x))
                rows_seen += len(x)
                for m, (a, b) in enumerate(zip(starts, ends)):
                    own, size = cosines[:, a:b].argmax(1), members[a:b]
                    away = 1 - (x @ sums[a:b].T) / np.maximum(size, 1)
                    mine = away[rows, own] * size[own] / np.maximum(size[own] - 1, 1)
                    away[:, size == 0] = np.inf
                    away[rows, own] = np.inf
                    other = away.min(1)
                    good = (size[own] > 1) & np.isfinite(other)
                    top = np.maximum(mine, other)
                    value = np.divide(other - mine, top, out=np.zeros(len(x)), where=good & (top > 0))
                    total[m] += value.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(names)), pa.int32()), pa.array(total), pa.array([rows_seen] * len(names), pa.int64())], ["model", "total", "n"])

    out = vectors.mapInArrow(run, "model int, total double, n long").groupBy("model").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("s"))
    return {names[r["model"]]: float(r["s"] or 0.0) for r in out.collect()}
