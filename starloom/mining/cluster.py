"""K-Means role families: feature matrix, choice of k, quality indices, profiles and 2-D projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.arrays import multi_hot
from starloom.functions.encode import CLUSTER_LABELS, label
from starloom.functions.numeric import number_or_zero
from starloom.operators.aggregate import item_sets, top_values
from starloom.operators.joins import keep_top_items
from starloom.operators.project import present
from starloom.operators.ranking import top_per_group
from starloom.operators.sampling import sample_rows
from starloom.operators.scaling import unit_range
from starloom.session import materialize

# Numeric attributes that join the category matrix, and their weight.
NUMERIC_FEATURES = ("experience_encoded", "company_size_encoded", "is_remote")
NUMERIC_WEIGHT = 0.5
# Matrix columns where there is no category bridge.
FALLBACK_FEATURES = ("skill_count", "applies", "views", "experience_encoded", "company_size_encoded", "salary_clean")


def category_matrix(
    bridge: DataFrame,
    fact: DataFrame | None,
    key: str,
    item: str,
    top: int = 35,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    weight: float = NUMERIC_WEIGHT,
) -> DataFrame:
    """(key, items, features): 0/1 slot per top item, then weighted min-max scaled attributes of the key.

    The attributes are left out for all rows if any key is missing from the fact table.
    """
    kept = item_sets(keep_top_items(bridge, item, top), key, item)
    counts = top_values(bridge, item, top)
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("place"), F.col(item).alias("item"))))
    classes = counts.agg(F.transform(order, lambda t: t["item"]).alias("classes")).scalar()
    coded = kept.withColumn("_classes", classes)
    hot = F.transform(multi_hot("items", F.col("_classes")), lambda x: x.cast("double"))
    columns = present(fact, numeric) if fact is not None and key in fact.columns else []
    if not columns:
        return coded.select(key, "items", hot.alias("features"))
    attributes = fact.groupBy(key).agg(F.min(F.struct(*columns)).alias("_row")).select(key, "_row.*")
    # The scaling needs the ranges of the joined rows first: store them instead of joining twice.
    joined = materialize(kept.join(attributes.withColumn("_known", F.lit(True)), key, "left")).withColumn("_classes", classes)
    complete = joined.agg(F.count_if(F.col("_known").isNull()) == 0).scalar()
    extra = F.when(F.col("_complete"), F.array(*[F.col(c) for c in columns])).otherwise(F.array().cast("array<double>"))
    scaled = unit_range(joined, columns, weight).withColumn("_complete", complete)
    return scaled.select(key, "items", F.concat(hot, extra).alias("features"))


def numeric_matrix(fact: DataFrame, key: str, columns: Sequence[str] = FALLBACK_FEATURES) -> DataFrame:
    """(key, features) from numeric columns alone, missing values as 0."""
    return fact.select(key, F.array(*[number_or_zero(fact, c) for c in present(fact, columns)]).alias("features"))


def merged_rows(matrix: DataFrame) -> DataFrame:
    """Equal vectors as one row (features, weight), stored: the objective of K-Means is the same, and 0/1 category vectors
    have few distinct values however many rows there are."""
    merged = matrix.groupBy("features").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return materialize(merged.select(array_to_vector("features").alias("features"), "weight"))


def fit_kmeans(
    matrix: DataFrame, k: int, restarts: int = 10, seed: int = 42, parallel: int = 4, merged: DataFrame | None = None
) -> KMeansModel:
    """Best of several seeded K-Means fits by inertia; `merged` are the merged rows of the matrix where they are at hand."""
    rows = merged_rows(matrix) if merged is None else merged

    def fit(i: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + i, maxIter=300, tol=1e-4, weightCol="weight").fit(rows)

    with ThreadPool(min(parallel, restarts)) as pool:
        models = pool.map(fit, range(restarts))
    return min(models, key=lambda m: m.summary.trainingCost)


def assign(model: KMeansModel, matrix: DataFrame) -> DataFrame:
    """The matrix with its cluster number."""
    vectors = matrix.withColumn("_vector", array_to_vector("features"))
    model = model.copy().setFeaturesCol("_vector").setPredictionCol("cluster")
    return model.transform(vectors).drop("_vector")


def _block_silhouette(sample: pd.DataFrame) -> pd.DataFrame:
    """Silhouettes of the rows one block owns, against the whole sample."""
    points = sample[sample["_own"]]
    x = np.asarray(points["features"].tolist(), dtype=float).reshape(len(points), -1)
    y = np.asarray(sample["features"].tolist(), dtype=float).reshape(len(sample), -1)
    if not len(x):
        return pd.DataFrame({"_id": [], "cluster": [], "silhouette": []})
    squares = (x**2).sum(1)[:, None] + (y**2).sum(1)[None, :] - 2.0 * x @ y.T
    squares[points["_id"].to_numpy()[:, None] == sample["_id"].to_numpy()[None, :]] = 0.0
    distance = np.sqrt(np.maximum(squares, 0.0))
    clusters, member = np.unique(sample["cluster"].to_numpy(), return_inverse=True)
    sizes = np.bincount(member)
    sums = distance @ (member[:, None] == np.arange(len(clusters))[None, :])
    own, rows = np.searchsorted(clusters, points["cluster"].to_numpy()), np.arange(len(x))
    inner = sums[rows, own] / np.maximum(sizes[own] - 1, 1)
    means = sums / sizes
    means[rows, own] = np.inf
    outer = means.min(axis=1)
    defined = (sizes[own] > 1) & np.isfinite(outer) & (np.maximum(inner, outer) > 0)
    value = np.where(defined, (outer - inner) / np.where(defined, np.maximum(inner, outer), 1.0), 0.0)
    return pd.DataFrame({"_id": points["_id"], "cluster": points["cluster"], "silhouette": value})


def silhouette_samples(labelled: DataFrame, key: str, n: int = 2000, seed: int = 42, blocks: int = 8) -> DataFrame:
    """Exact Euclidean silhouette of a seeded sample of at most n rows (the sampling is part of the measure).

    Each of the blocks owns a part of the sample and gets a copy of all of it, so every task computes one block of
    the distance matrix and no pair is ever joined or emitted.
    """
    source = labelled.select(F.col(key).cast("bigint").alias("_id"), F.col("cluster").cast("int"), "features")
    sample = sample_rows(source, "_id", n, seed)
    copies = sample.withColumn("_block", F.explode(F.array(*[F.lit(i) for i in range(blocks)])))
    owned = copies.withColumn("_own", F.pmod("_id", F.lit(blocks)) == F.col("_block"))
    schema = "_id bigint, cluster int, silhouette double"
    return owned.groupBy("_block").applyInPandas(_block_silhouette, schema).withColumnRenamed("_id", key)


def silhouette(labelled: DataFrame, key: str, n: int = 2000, seed: int = 42) -> DataFrame:
    return silhouette_samples(labelled, key, n, seed).agg(
        F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette")
    )


@dataclass(frozen=True)
class Sweep:
    """Fits of one matrix for several k: its stored rows, and (k, silhouette, model) for each k."""

    rows: DataFrame
    fits: list[tuple[int, float, KMeansModel]]

    @property
    def best(self) -> tuple[int, float, KMeansModel]:
        """The fit of the largest silhouette; the smaller k wins a tie."""
        return max(self.fits, key=lambda m: (m[1], -m[0]))

    def scores(self) -> DataFrame:
        return self.rows.sparkSession.createDataFrame([(k, score) for k, score, _ in self.fits], "k int, silhouette double")


def sweep(
    matrix: DataFrame,
    key: str,
    k_values: Sequence[int] = (2, 3, 4, 5),
    sample: int | None = None,
    measured: int = 2000,
    restarts: int = 10,
) -> Sweep:
    """One fit for each k, on all rows or on a seeded sample of so many. Rows are stored once and merged once for all fits,
    and the winner is at hand afterwards, so nothing is fitted twice."""
    rows = materialize(sample_rows(matrix, key, sample) if sample else matrix)
    merged = merged_rows(rows)

    def measure(k: int) -> tuple[int, float, KMeansModel]:
        model = fit_kmeans(rows, k, restarts, merged=merged)
        return k, silhouette(assign(model, rows), key, measured).first()["silhouette"], model

    with ThreadPool(len(k_values)) as pool:
        return Sweep(rows, pool.map(measure, k_values))


def choose_k(
    matrix: DataFrame,
    key: str,
    k_values: Sequence[int] = (2, 3, 4, 5),
    sample: int | None = None,
    measured: int = 2000,
    restarts: int = 10,
) -> DataFrame:
    """Silhouette per k, one row per k."""
    return sweep(matrix, key, k_values, sample, measured, restarts).scores()


def best_model(
    matrix: DataFrame, key: str, k_values: Sequence[int] = (2, 3, 4, 5), measured: int = 2000, restarts: int = 10
) -> KMeansModel:
    """The model of the k that `best_k` takes from `choose_k` on all rows."""
    return sweep(matrix, key, k_values, None, measured, restarts).best[2]


def best_k(scores: DataFrame) -> int:
    return scores.agg(F.max_by("k", F.struct("silhouette", -F.col("k")))).first()[0]


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def centroids(labelled: DataFrame) -> DataFrame:
    """Mean vector and size of every cluster."""
    mean = Summarizer.mean(array_to_vector("features"))
    rows = labelled.groupBy("cluster").agg(mean.alias("_mean"), F.count(F.lit(1)).alias("n"))
    return rows.select("cluster", vector_to_array("_mean").alias("centre"), "n")


def davies_bouldin(labelled: DataFrame) -> DataFrame:
    """Davies-Bouldin index in one row.

    The k x k comparison runs inside one array of k entries.
    """
    rows = labelled.join(centroids(labelled), "cluster")
    spread = rows.groupBy("cluster", "centre").agg(F.avg(_distance(F.col("features"), F.col("centre"))).alias("spread"))
    gathered = spread.agg(F.collect_list(F.struct("cluster", "centre", "spread")).alias("all"))

    def worst(i: Column) -> Column:
        others = F.filter("all", lambda j: j["cluster"] != i["cluster"])
        ratio = F.transform(others, lambda j: (i["spread"] + j["spread"]) / F.nullif(_distance(i["centre"], j["centre"]), F.lit(0.0)))
        return F.coalesce(F.array_max(ratio), F.lit(0.0))

    total = F.aggregate(F.transform("all", worst), F.lit(0.0), lambda t, x: t + x)
    return gathered.select(F.size("all").alias("k"), (total / F.size("all")).alias("davies_bouldin"))


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    total = labelled.agg(F.count(F.lit(1))).scalar()
    sizes = labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("share", F.col("n") / total)


def item_shares(labelled: DataFrame, items: str = "items") -> DataFrame:
    """Share of cluster members that carry each item (the centre of the 0/1 part)."""
    sizes = labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("_size"))
    counts = (
        labelled.select("cluster", F.explode(items).alias("item"))
        .groupBy("cluster", "item")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.join(sizes, "cluster").select(
        "cluster", "item", (F.col("_n") / F.col("_size")).alias("share")
    )


def cluster_profile(shares: DataFrame, top: int = 5) -> DataFrame:
    """The leading items of each cluster."""
    return top_per_group(shares, "cluster", [F.desc("share"), F.asc("item")], top)


def cluster_names(
    shares: DataFrame, threshold: float = 0.12, terms: int = 2, labels: Mapping[str, str] = CLUSTER_LABELS
) -> DataFrame:
    """Name per cluster: up to two items at or above the threshold, else the leading one."""
    leading = cluster_profile(shares, terms).where((F.col("share") >= threshold) | (F.col("place") == 1))
    parts = F.array_sort(F.collect_list(F.struct("place", label("item", labels).alias("name"))))
    return leading.groupBy("cluster").agg(F.array_join(F.transform(parts, lambda p: p["name"]), " & ").alias("name"))


def fit_projection(matrix: DataFrame, components: int = 2) -> PipelineModel:
    """Centred PCA; the vector column is `_vector`, the projection `projected`."""
    vectors = materialize(matrix.select(array_to_vector("features").alias("_vector")))
    stages = [
        StandardScaler(withMean=True, withStd=False, inputCol="_vector", outputCol="_centred"),
        PCA(k=components, inputCol="_centred", outputCol="projected"),
    ]
    return Pipeline(stages=stages).fit(vectors)


def explained_variance(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    ratios = [float(v) for v in model.stages[-1].explainedVariance]
    return matrix.sparkSession.createDataFrame(
        [(i + 1, v) for i, v in enumerate(ratios)], "component int, explained double"
    )


def _signs(model: PipelineModel) -> list[float]:
    """1 or -1 for each component, so that its loading of largest size (the first of equals) is positive."""
    loadings = model.stages[-1].pc.toArray()
    largest = np.argmax(np.round(np.abs(loadings), 9), axis=0)
    return [1.0 if loadings[i, c] >= 0 else -1.0 for c, i in enumerate(largest)]


def project(model: PipelineModel, rows: DataFrame, features: str = "features") -> DataFrame:
    """Rows with their first two principal components, whose signs do not depend on the decomposition."""
    point, signs = vector_to_array("projected"), _signs(model)
    projected = model.transform(rows.withColumn("_vector", array_to_vector(features)))
    return projected.withColumns({f"pc{i + 1}": point[i] * signs[i] for i in (0, 1)}).drop("_vector", "_centred", "projected")


def project_centroids(model: PipelineModel, kmeans: KMeansModel, spark) -> DataFrame:
    """The k fitted centres in the projected plane."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(kmeans.clusterCenters())]
    centres = spark.createDataFrame(rows, "cluster int, features array<double>")
    return project(model, centres).select("cluster", "pc1", "pc2")


def plane_decomposition(model: PipelineModel, labelled: DataFrame, kmeans: KMeansModel) -> DataFrame:
    """component, n, sum_of_squares of labelled rows in the projected plane, one row per component.

    Squares from the rows to their projected centre and from that to the origin, which is the projected mean. They add up to
    the squares of the rows themselves exactly where each projected centre is the mean of its projected rows.
    """
    centres = project_centroids(model, kmeans, labelled.sparkSession).select("cluster", F.col("pc1").alias("c1"), F.col("pc2").alias("c2"))
    points = project(model, labelled).select("cluster", "pc1", "pc2").join(F.broadcast(centres), "cluster")  # one row per cluster

    def squares(i: int) -> Column:
        row, centre = F.col(f"pc{i}"), F.col(f"c{i}")
        return F.sum((row - centre) * (row - centre) + centre * centre)

    sums = points.agg(F.count(F.lit(1)).alias("n"), squares(1).alias("_1"), squares(2).alias("_2"))
    return sums.select(F.expr("stack(2, 1, n, _1, 2, n, _2) AS (component, n, sum_of_squares)"))


def scatter(model: PipelineModel, labelled: DataFrame, names: DataFrame, key: str, n: int = 10_000) -> DataFrame:
    """Seeded sample of projected rows with cluster and name."""
    sample = sample_rows(labelled, key, n)
    points = project(model, sample).select(key, "pc1", "pc2", "cluster")
    return points.join(F.broadcast(names), "cluster")  # one row per cluster


def evaluate(matrix: DataFrame, key: str, k_values: Sequence[int] = tuple(range(2, 9)), restarts: int = 10) -> DataFrame:
    """Best k, its silhouette and Davies-Bouldin index in one row; the model is the one that the sweep fitted."""
    swept = sweep(matrix, key, k_values, restarts=restarts)
    k, measured, model = swept.best
    labelled = materialize(assign(model, swept.rows))
    return davies_bouldin(labelled).select(F.lit(k).alias("optimal_k"), F.lit(measured).alias("silhouette"), "davies_bouldin")


def decomposition(labelled: DataFrame, model: KMeansModel) -> DataFrame:
    """n, n_nearest, sum_of_squares of labelled rows in one row.

    n_nearest counts the rows at the nearest centre of the model. The squared distances to the own centre and those of the
    centres to the mean of all rows add up to the total sum of squares exactly where each centre is the mean of its rows.
    """
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    mean = labelled.agg(vector_to_array(Summarizer.mean(array_to_vector("features")))).scalar()
    rows = labelled.withColumns({"_centres": centres, "_mean": mean})
    distances = F.transform("_centres", lambda c: _distance(F.col("features"), c))
    own = F.element_at("_distances", F.col("cluster") + 1)
    between = _distance(F.element_at("_centres", F.col("cluster") + 1), F.col("_mean"))
    return rows.withColumn("_distances", distances).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(own <= F.array_min("_distances") + 1e-9).alias("n_nearest"),
        F.sum(own * own + between * between).alias("sum_of_squares"),
    )
