"""Centroid clustering against plain Python integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np

from starloom.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, x int, p int"


def _brute(rows, k=8, rounds=10, size=64):
    kept = [(i, [math.floor(1024 * x) if abs(x) < 2**52 else int(x) * 1024 for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]
    if not seeds:
        return []
    centres = [q for _, q in seeds]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(centres)) for _, q in kept]

    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, q), (_, j) in zip(kept, assign(), strict=True):
            groups[j].append(q)
        for j, g in groups.items():
            centres[j] = [sum(column) // len(g) for column in zip(*g, strict=True)]
    placed, sums = assign(), defaultdict(int)
    for d, j in placed:
        sums[j] += d

    def fits(x):
        return x if x < 1 << 63 else None

    known = all(d < 1 << 63 for d, _ in placed)
    return sorted(
        (str(i), j, fits(d), fits(sums[j]) if all(e < 1 << 63 for e, c in placed if c == j) else None, fits(sum(sums.values())) if known else None, hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(kept, placed, strict=True)
    )


def _found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], SCHEMA).repartition(3)
    return sorted(((str(r.vec_id), *r[1:]) for r in centroids.clusters(frame, **options).collect()), key=str)


def _same(spark, rows, **options):
    found = _found(spark, rows, **options)
    assert found == sorted(_brute(rows, **{k: v for k, v in options.items() if k != "pivots"}), key=str)
    return found


def test_edges(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=64).tolist()) for i in range(120)]
    rows += [(7, rows[7][1]), (7, [0.5] * 64), (None, rows[3][1]), (200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63), (205, [float("nan")] * 64), (206, [float("inf")] * 64), (207, [0.0] * 64), (208, [-0.00001] * 64)]
    assert len(_same(spark, rows)) == 125


def test_ties_and_few_vectors(spark):
    same = [(i, [float(i % 2)] * 64) for i in range(40)]
    _same(spark, same)
    _same(spark, [(1, [1.0] * 64)])
    _same(spark, [(i, [float(i)] * 64) for i in range(3)])
    assert _found(spark, []) == [] and _found(spark, [(None, [1.0] * 64)]) == [] and _found(spark, [(1, None)]) == []


def test_huge_components(spark):
    rows = [(i, [3e38 * (1 - i / 100) * (1 if i % 3 else -1)] * 32 + [float(i)] * 32) for i in range(30)] + [(i, [float(i)] * 64) for i in range(30, 60)] + [(99, [2.0**40] * 64)]
    found = _same(spark, rows)
    assert any(r[2] is None for r in found) and any(r[2] is not None for r in found)


def test_other_parameters(spark):
    draw = np.random.default_rng(2)
    rows = [(i, (draw.normal(size=5) + 9 * (i % 4)).tolist()) for i in range(300)]
    _same(spark, rows, size=5, k=4, rounds=3, pivots=2)


def test_bounds_leave_out_only_what_is_farther():
    draw = np.random.default_rng(3)
    spots = draw.integers(-3000, 3000, (6, 64))
    q = spots[draw.integers(0, 6, 2000)] + draw.integers(-20, 20, (2000, 64))
    centres = np.concatenate([spots, spots[:1], spots[1:2] + 1])
    pivots = q[:16]
    chosen, best, computed = centroids.nearest(q, centroids.pivot_distances(q, pivots), centres, centroids.pivot_distances(centres, pivots))
    exact = ((q[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (chosen == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert computed < 0.4 * q.shape[0] * len(centres)  # of eight distances each


def test_whole_table(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    found = sorted((str(r.vec_id), *r[1:]) for r in centroids.clusters(spark.read.parquet(f"{small}/embeddings.parquet")).collect())
    assert found == _brute(rows)
