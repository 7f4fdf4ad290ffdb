"""Clustering by centroids, the nearest found by the threshold algorithm (operator 13).

For each dimension the centroids are sorted by their value there. From a vector's value the lists of all dimensions are
walked outward at the same pace, one centroid a step in each. A centroid met for the first time gets its exact squared
distance. The squared gaps at the frontiers sum up to a bound: no unseen centroid is nearer. A vector is done when that
sum strictly exceeds its best distance (strictly, so that a smaller number at the same distance is still found) or when
all centroids have been seen. The walk from a value is the same for all vectors of a batch that have it, so it is made
once for each distinct value.

Components are integers, so distances, sums and the floors of means are exact and don't depend on partitions. Rounds
read the stored vectors; each partition gives one row of sums for each centroid, which are added within tasks and then
by the driver: k rows of each of a few tasks, at any size.

Defined cases: rows whose vector is null, has another length or a null or non-finite component are left out; a null
id starts no centroid but is assigned; with fewer vectors than centroids there are as many centroids as vectors with
an id; without any, every vector's cluster is null; repeated rows count as often as they stand there, as starts too;
a distance or inertia beyond a long is null. Only the id and the vector are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.shared import mapped, stored, tasks_to_sum

DIMENSIONS, CLUSTERS, ROUNDS, SEED, SCALE = 64, 40, 5, 2, 256
#: Within these bounds the sums of a partition and squared distances fit into 64 bits.
_SAFE = 2**26
_BATCH = 2048


def whole_vectors(table: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and v: the components as floor(scale * x), exact integers held in doubles."""
    vector = F.col("embedding").cast("array<double>")
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x * scale) < float("inf")))
    floored = F.transform(vector, lambda x: F.rint(x * scale) - (F.rint(x * scale) > x * scale).cast("double"))
    return table.where((F.size("embedding") == dimensions) & good).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), floored.alias("v")
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Integers of the vectors: 64 bits if that is safe, else Python's own."""
    flat = np.asarray(batch["v"].flatten()).reshape(len(batch), -1)
    if not len(flat) or np.abs(flat).max(initial=0) < _SAFE:
        return flat.astype(np.int64)
    return np.array([[int(x) for x in row] for row in flat.tolist()], object)


def starts(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The k vectors with the smallest sha256 of "seed:id", in that order; among equal ids by components."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id IS NOT NULL").select("v", hashed.alias("h")).orderBy("h", "v").limit(k)
    return [[int(x) for x in row["v"]] for row in first.collect()]


class Walks:
    """The sorted centroid lists of all dimensions."""

    def __init__(self, centroids: list[list[int]]):
        big = max((abs(x) for c in centroids for x in c), default=0) >= _SAFE
        self.centroids = np.array(centroids, object if big else np.int64)
        self.order = np.argsort(self.centroids, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(self.centroids, self.order.T, axis=0).T

    def outward(self, d: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value, in its dimension: the centroids as the two frontiers meet them, and their squared gaps."""
        k = len(self.centroids)
        right = (self.sorted[d] < values[:, None]).sum(axis=1)
        left = right - 1
        met = np.empty((len(values), k), np.int64)
        gaps = np.empty((len(values), k), np.result_type(self.sorted, values))
        for step in range(k):
            low = values - self.sorted[d, np.maximum(left, 0)]
            high = self.sorted[d, np.minimum(right, k - 1)] - values
            down = (right >= k) | ((left >= 0) & (low <= high))
            met[:, step] = self.order[d, np.where(down, left, right)]
            gaps[:, step] = np.where(down, low, high) ** 2
            left, right = left - down, right + ~down
        return met, gaps

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector: its nearest centroid (the smaller number of equals) and the squared distance."""
        n, k = len(vectors), len(self.centroids)
        kind = np.result_type(vectors, self.centroids)
        lists, dimensions, values = np.empty(vectors.shape, np.int64), [], []
        for d in range(vectors.shape[1]):
            own, place = np.unique(vectors[:, d], return_inverse=True)
            lists[:, d] = place + sum(map(len, values))
            values.append(own)
            dimensions.append(np.full(len(own), d))
        met, gaps = self.outward(np.concatenate(dimensions), np.concatenate(values))
        cluster, best = np.full(n, k, np.int64), np.full(n, -1, kind)
        seen, active = np.zeros((n, k), bool), np.arange(n)
        for step in range(k):
            walked = lists[active]
            new = np.zeros((len(active), k), bool)
            np.put_along_axis(new, met[walked, step], True, axis=1)
            new &= ~seen[active]
            seen[active] |= new
            at, number = np.nonzero(new)
            apart = vectors[active[at]] - self.centroids[number]
            exact = (apart * apart).sum(axis=1)
            # The nearest new one of each vector: numbers ascend, so the first of equals is the smaller.
            firsts = np.flatnonzero(np.diff(at, prepend=-1))
            least = np.minimum.reduceat(exact, firsts) if len(firsts) else exact
            is_least = exact == np.repeat(least, np.diff(firsts, append=len(at)))
            hits = np.flatnonzero(is_least)
            hits = hits[np.diff(at[hits], prepend=-1) > 0]
            who, distance, which = active[at[hits]], exact[hits], number[hits]
            better = (cluster[who] == k) | (distance < best[who]) | ((distance == best[who]) & (which < cluster[who]))
            best[who[better]], cluster[who[better]] = distance[better], which[better]
            frontier = gaps[walked, step].sum(axis=1)
            active = active[~((frontier > best[active]) | seen[active].all(axis=1))]
            if not len(active):
                break
        return cluster, best


def _assigned(batches: Iterator[pa.RecordBatch], walks: Walks) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        if len(batch):
            vectors = _matrix(batch)
            yield batch, vectors, *walks.nearest(vectors)


_SUMS = "cluster int, n bigint, s string"


def _sum_rows(sums: dict[int, tuple[int, list[int]]]) -> pa.RecordBatch:
    rows = [(c, n, ",".join(map(str, s))) for c, (n, s) in sums.items()]
    columns = zip(*rows, strict=True) if rows else [[]] * 3
    types = pa.int32(), pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["cluster", "n", "s"])


def _add(sums: dict[int, tuple[int, list[int]]], cluster: int, n: int, values: list[int]) -> None:
    before = sums.get(cluster)
    sums[cluster] = (n, values) if before is None else (before[0] + n, [a + b for a, b in zip(before[1], values, strict=True)])


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The floors of the means of the centroids' vectors; a centroid without any stays."""
    walks = Walks(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, list[int]]] = {}
        for _, own, cluster, _ in _assigned(batches, walks):
            for c in np.unique(cluster).tolist():
                mine = own[cluster == c]
                _add(sums, c, len(mine), [int(x) for x in mine.sum(axis=0)])
        yield _sum_rows(sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                _add(sums, row["cluster"], row["n"], [int(x) for x in row["s"].split(",")])
        yield _sum_rows(sums)

    partials = mapped(vectors, partial, _SUMS, _BATCH)
    rows = mapped(partials.repartition(tasks_to_sum(vectors.sparkSession)), total, _SUMS).collect()
    sums: dict[int, tuple[int, list[int]]] = {}
    for row in rows:
        _add(sums, row["cluster"], row["n"], [int(x) for x in row["s"].split(",")])
    return [[x // sums[c][0] for x in sums[c][1]] if c in sums else old for c, old in enumerate(centroids)]


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    centroids = starts(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids)
    return centroids


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance (squared; null beyond a long)."""
    if not centroids:
        return vectors.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance"))
    walks = Walks(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, best in _assigned(batches, walks):
            distance = pa.array([x if x < 2**63 else None for x in best.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(cluster, pa.int32()), distance], names=["vec_id", "cluster", "distance"]
            )

    return mapped(vectors, assign, "vec_id bigint, cluster int, distance bigint", _BATCH)


def clustered(
    table: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that is kept."""
    spark = table.sparkSession
    vectors = stored(whole_vectors(table, dimensions, scale))
    centroids = fit(vectors, k, rounds, seed)
    rows = stored(assigned(vectors, centroids))
    sums = rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"), F.count_if(F.col("distance").isNull()).alias("lost")
    )
    known = {r["cluster"]: None if r["lost"] else int(r["sum"]) for r in sums.collect()}
    inertia = None if None in known.values() else sum(known.values())
    found = [
        (
            c,
            *(x if x is not None and x < 2**63 else None for x in (known.get(c), inertia)),
            hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest(),
        )
        for c, centroid in enumerate(centroids)
    ]
    # One row for each centroid: their number is a parameter.
    clusters = spark.createDataFrame(found, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(clusters), "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
