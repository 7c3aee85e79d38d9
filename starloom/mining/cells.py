"""Binned training rows: trees see features in bins, so rows that lie in the same bins are one weighted row to them.

There are at most as many cells as combinations of bins, however many rows there are; where no two rows share a cell, every
row is one. A split is judged by sums of weights, labels and squares, and the squares within a cell add the same to both
sides of a gain, so the mean label of a cell gives the gains of its rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize, stored_for_fits

#: Bins of a feature, Spark's default for trees.
BINS = 32
#: Cells in a partition, and the least partitions.
CELL_ROWS, CELL_PARTITIONS = 25_000, 8
# Points of the order of a feature from which its bins are cut.
_POINTS = 1024


def _cuts(points: Sequence[float], bins: int) -> list[float]:
    """Upper ends of all bins but the last: even shares of the points, what a frequent value takes beyond its share left to the others."""
    counts, cuts = Counter(points), []
    values, held, left = sorted(counts), 0, len(points)
    for value in values[:-1]:
        held += counts[value]
        if held * (bins - len(cuts)) >= left:
            cuts.append(value)
            held, left = 0, left - held
        if len(cuts) == bins - 1:
            break
    return cuts


def feature_cuts(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Thresholds of every feature, at most bins - 1: all midpoints of a feature with at most `bins` values, else quantiles
    of all rows. A value at a threshold belongs to the lower bin. Two aggregates, whose results are bounded."""
    counts = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    few = [c for c in features if counts[c] <= 2 * bins]
    shares = F.lit([k / _POINTS for k in range(_POINTS + 1)])
    found = rows.agg(*[
        (F.sort_array(F.collect_set(c)) if c in few else F.percentile_approx(c, shares, 10 * _POINTS)).alias(c) for c in features
    ]).first()
    out = []
    for c in features:
        values = list(found[c] or [])
        if c in few and len(values) <= bins:
            out.append([(a + b) / 2 for a, b in zip(values[:-1], values[1:], strict=True)])
        elif c in few:
            points = rows.agg(F.percentile_approx(c, shares, 10 * _POINTS)).first()[0]
            out.append(_cuts(points, bins))
        else:
            out.append(_cuts(values, bins))
    return out


def bin_name(feature: str) -> str:
    return f"_bin_{feature}"


def bucketizer(features: Sequence[str], cuts: Sequence[Sequence[float]]) -> Bucketizer:
    """Bin numbers of the features. Spark's buckets hold their lower end, trees send a value at a threshold down."""
    splits = [[-math.inf, *[math.nextafter(x, math.inf) for x in c], math.inf] for c in cuts]
    splits = [s if len(s) > 2 else [-math.inf, math.nextafter(math.inf, 0), math.inf] for s in splits]
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=[bin_name(c) for c in features])


@dataclass(frozen=True)
class Cells:
    """Bins of the features, and the cells: one stored row for each combination of bins that occurs."""

    bins: Bucketizer
    rows: DataFrame  # bins, weight (rows), label (their mean)
    names: list[str]
    label: str


def cells(rows: DataFrame, features: Sequence[str], label: str, by_label: bool = False) -> Cells:
    """The cells of training rows; `by_label` keeps rows of different labels apart, for classes.

    Labels are summed as decimals, so that the cells do not depend on the order of the rows: |label| is below 10^10.
    """
    stage = bucketizer(features, feature_cuts(rows, features))
    names = [bin_name(c) for c in features]
    # Plain numbers: the buckets' own attributes would make every bin a category without an order.
    binned = stage.transform(rows).withColumns({c: F.col(c).cast("int") for c in names})
    keys = [*names, label] if by_label else names
    mean = [] if by_label else [F.avg(F.col(label).cast("decimal(28,18)")).cast("double").alias(label)]
    merged = materialize(binned.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("weight"), *mean))
    merged = merged.withColumn("_cell", F.xxhash64(*keys))
    partitions = max(CELL_PARTITIONS, -(-merged.count() // CELL_ROWS))
    return Cells(stage, stored_for_fits(merged, "_cell", partitions), names, label)
