"""Centroid clustering of integer vectors with a table of distances to fixed pivots (LAESA).

The distances of every vector to a few fixed pivots are computed once and stored beside it. In each round the distances
of the centroids to the pivots are computed, and the triangle inequality bounds the distance of a vector to a centroid
from below by the largest difference of their distances to one pivot. Centroids are tried in the order of that bound; those whose
bound exceeds the nearest distance found are left out, the others get their exact integer distance. So every vector is
at its nearest centroid in exact arithmetic.

Tasks add up their vectors by cluster; what leaves a task in a round are the sums of each cluster and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize

#: Components are multiplied by this before rounding down.
SCALE = 1024
#: Sums leave a task in digits of this base, so they are exact at any size.
BASE = 10**17
#: Distances to pivots are stored as 32-bit floats; bounds give way by this share of the distances they come from.
SLACK = 1e-6


def usable(embedding: Column, size: int) -> Column:
    """Whether a vector has exactly `size` components, none of them null or not finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(embedding) == size) & finite, F.lit(False))


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 x) as 64-bit integers; as Python integers where one of them is beyond 2^62."""
    with np.errstate(over="ignore"):
        scaled = np.floor(np.asarray(x, np.float64) * SCALE)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    whole = [int(np.floor(v * SCALE)) if abs(v) < 2.0**52 else int(v) * SCALE for v in np.asarray(x, np.float64).ravel().tolist()]
    return np.array(whole, object).reshape(scaled.shape)


def _narrow(q: np.ndarray) -> np.ndarray:
    """Rows whose squared distances to one another fit 64 bits: components below 2^27 for 64 components."""
    limit = int((2**62 / max(q.shape[1], 1)) ** 0.5 / 2)
    return np.abs(q).max(axis=1, initial=0) < limit


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return (difference * difference).sum(axis=-1)


def pivot_distances(q: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of vectors to the pivots as 32-bit floats; infinite where they are too large for bounds."""
    out = np.full((len(q), len(pivots)), np.inf, np.float32)
    exact = np.flatnonzero(_narrow(q).astype(bool))
    for i, pivot in enumerate(pivots):
        if len(exact) and _narrow(pivot[None])[0]:
            out[exact, i] = np.sqrt(_squares(q[exact].astype(np.int64), pivot.astype(np.int64)).astype(np.float64))
    return out


def lower_bounds(table: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Lower bounds (vectors, centroids) of distances from both sides' distances to the pivots; 0 where one is unknown."""
    bounds = np.zeros((len(table), len(centres)))
    with np.errstate(invalid="ignore"):
        for i in range(table.shape[1]):
            a, b = table[:, i, None].astype(np.float64), centres[None, :, i].astype(np.float64)
            bound = np.abs(a - b) - SLACK * (a + b) - 1e-9
            np.maximum(bounds, np.where(np.isfinite(bound), bound, 0.0), out=bounds)
    return bounds


def nearest(q: np.ndarray, table: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (ties: the smaller number), the squared distance, and how many were computed."""
    n, k = len(q), len(centroids)
    small = bool(_narrow(centroids).all() and _narrow(q).all())
    q, centroids = (x.astype(np.int64 if small else object) for x in (q, centroids))
    bounds = lower_bounds(table, centres) if small else np.zeros((n, k))
    order, rows = np.argsort(bounds, axis=1, kind="stable"), np.arange(n)
    chosen = order[:, 0]
    best, computed = _squares(q, centroids[chosen]), n
    for place in range(1, k):
        tried = order[:, place]
        left = np.flatnonzero(bounds[rows, tried] ** 2 <= best.astype(np.float64) * (1 + SLACK)) if small else rows
        if not len(left):
            break
        distance = _squares(q[left], centroids[tried[left]])
        computed += len(left)
        better = (distance < best[left]) | ((distance == best[left]) & (tried[left] < chosen[left]))
        moved = left[better.astype(bool)]
        best[moved], chosen[moved] = distance[better.astype(bool)], tried[moved]
    return chosen, best, computed


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """Digits of a whole number in BASE, with its sign."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value or not place:
        value, digit = divmod(value, BASE)
        yield place, sign * digit
        place += 1


def _means(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray, size: int) -> np.ndarray:
    """Centroids after one round: exact floors of the means of their vectors; those without vectors stay."""
    centres = pivot_distances(centroids, pivots)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), size + 1), object)
        for batch in batches:
            q = integers(_matrix(batch.column("x"), size))
            chosen, _, _ = nearest(q, _matrix(batch.column("p"), len(pivots)), centroids, centres)
            for c in np.unique(chosen).tolist():
                mine = q[chosen == c]
                # Halves of the numbers, so that a batch cannot overflow.
                low, high = (mine & 0xFFFFFFFF, mine >> 32) if mine.dtype != object else (mine, mine * 0)
                sums[c, :size] += low.sum(axis=0).astype(object) + high.sum(axis=0).astype(object) * (1 << 32)
                sums[c, size] += len(mine)
        rows = [(c, d, place, digit) for c in range(len(centroids)) for d in range(size + 1) if sums[c, size] for place, digit in _digits(int(sums[c, d]))]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["c", "d", "place", "digit"])

    parts = stored.select("x", "p").mapInArrow(add, "c int, d int, place int, digit bigint")
    totals = np.zeros((len(centroids), size + 1), object)
    # One row for each centroid, component and digit.
    for r in parts.groupBy("c", "d", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("s")).collect():
        totals[r.c, r.d] += int(r.s) * BASE**r.place
    after = centroids.astype(object)
    for c in np.flatnonzero(totals[:, size] > 0).tolist():
        after[c] = [int(t) // int(totals[c, size]) for t in totals[c, :size]]
    return after


def _labelled(stored: DataFrame, key: str, kind: str, centroids: np.ndarray, pivots: np.ndarray, size: int) -> DataFrame:
    centres = pivot_distances(centroids, pivots)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, best, _ = nearest(integers(_matrix(batch.column("x"), size)), _matrix(batch.column("p"), len(pivots)), centroids, centres)
            distance = pa.array([int(v) if v < 1 << 63 else None for v in best.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(chosen.astype(np.int32)), distance], [key, "cluster", "distance"])

    return stored.mapInArrow(label, f"`{key}` {kind}, cluster int, distance bigint")


def first_vectors(kept: DataFrame, salt: str, count: int) -> list[Sequence[float]]:
    """The vectors of the `count` rows with the least hash of their key; equal keys by their components."""
    hashed = kept.where(F.col("key").isNotNull()).select(F.sha2(F.concat(F.lit(salt), F.col("key").cast("string")), 256).alias("h"), "x")
    return [r.x for r in hashed.orderBy("h", "x").limit(count).collect()]


def clusters(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 64, k: int = 8, rounds: int = 10, salt: str = "3:", pivots: int = 16
) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every usable vector, repeated rows included.

    Components become floor(1024 x). Centroids start as the vectors with the `k` smallest hashes of `salt` and key
    (fewer where there are fewer vectors); the same order gives the pivots. Vectors of another size, null ones and those
    with null or non-finite components are left out; rows with a null key are placed but start no centroid. Without
    vectors the result is empty, and so it is without any key. Squared distances and their sums that
    exceed 64 bits are null; clusters are exact all the same. Other columns are not read.
    """
    kind = rows.schema[key].dataType.simpleString()
    source = rows.select(rows[key].alias("key"), rows[vector].alias("x"))
    kept = source.where(usable(F.col("x"), size))
    first = integers(np.array(first_vectors(kept, salt, max(k, pivots)), np.float64).reshape(-1, size))
    schema = f"`{key}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(first):
        return rows.sparkSession.createDataFrame([], schema)
    centroids, fixed = first[:k].astype(object), first[:pivots]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pivot_distances(integers(_matrix(batch.column("x"), size)), fixed)
            lists = pa.ListArray.from_arrays(np.arange(len(table) + 1, dtype=np.int32) * len(fixed), pa.array(table.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("x"), lists], ["key", "x", "p"])

    stored = materialize(kept.mapInArrow(measure, f"key {kind}, x {rows.schema[vector].dataType.simpleString()}, p array<float>"))
    for _ in range(rounds):
        before, centroids = centroids, _means(stored, centroids, fixed, size)
        if (before == centroids).all():
            break  # further rounds would change nothing
    labelled = materialize(_labelled(stored, key, kind, centroids, fixed, size))
    total = F.when(F.count_if(F.col("distance").isNull()) == 0, F.sum(F.col("distance").cast("decimal(38,0)")))
    by_cluster = {r.cluster: r.s for r in labelled.groupBy("cluster").agg(total.alias("s")).collect()}  # k rows

    def fits(value) -> int | None:
        return int(value) if value is not None and value < 1 << 63 else None

    inertia = fits(sum(by_cluster.values())) if None not in by_cluster.values() else None
    about = [(c, fits(s), inertia, hashlib.sha256(",".join(str(int(x)) for x in centroids[c]).encode()).hexdigest()) for c, s in by_cluster.items()]
    facts = rows.sparkSession.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return labelled.join(F.broadcast(facts), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # at most k rows
