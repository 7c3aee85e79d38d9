"""Data behind the exploratory charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import rounded
from starloom.operators.aggregate import value_counts
from starloom.operators.moments import cross_products, with_presence_and_squares
from starloom.operators.ordered import exact_quantiles, running_totals

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_stats(df: DataFrame, category: str, value: str, order: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Box-plot statistics of the listed categories: quartiles, whiskers and the number of outliers."""
    rows = df.select(category, value).where(F.col(category).isin(list(order)) & F.col(value).isNotNull())
    boxes = exact_quantiles(rows, value, QUARTILES, by=[category], few_groups=True)
    margin = F.lit(reach) * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - margin, F.col("q3") + margin)
    # One row per listed category; carrying the box through the grouping saves computing it twice.
    return (
        rows.join(F.broadcast(boxes), category)
        .groupBy(category, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram; the last bin is closed, empty bins are kept, a constant column gets a unit-wide range."""
    rows = df.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    low, high = F.min("_v"), F.max("_v")
    pad = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    span = rows.agg(F.struct((low - pad).alias("low"), (high + pad).alias("high")).alias("span"))
    # The number of counted rows is at most `bins`; the bin table is a constant range.
    placed = rows.withColumn("_span", span.scalar())
    width = (F.col("_span.high") - F.col("_span.low")) / F.lit(bins)
    number = F.least(F.floor((F.col("_v") - F.col("_span.low")) / width), F.lit(bins - 1))
    counts = placed.select(number.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("_span", span.scalar())
    step = (F.col("_span.high") - F.col("_span.low")) / F.lit(bins)
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("_span.low") + F.col("bin") * step).alias("low"),
        (F.col("_span.low") + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def correlations(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Strict lower triangle of the pairwise-complete Pearson matrix; NULL (not an error) for a constant column.

    All pairs come from one pass over the columns, shifted by their means so that the sums keep their precision.
    """
    columns = [c for c in columns if c in df.columns]
    if len(columns) < 3:
        raise ValueError("a correlation matrix needs at least three columns")
    k = len(columns)
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("means")).scalar()
    shifted = df.select(*columns).withColumn("_means", means)
    shifted = shifted.select(*[(F.col(c) - F.col(f"_means.{c}")).alias(c) for c in columns])
    sums = cross_products(shifted, columns, with_presence_and_squares)
    cell = F.struct((F.col("i") * F.lit(3 * k) + F.col("j")).alias("place"), "value")
    table = sums.agg(F.map_from_entries(F.collect_list(cell)).alias("s"))  # (3 k)^2 cells

    def correlation(a: int, b: int) -> str:
        # Sums over the rows where both columns are present.
        n, product = f"nullif(s[{a * 3 * k + b}], 0)", f"s[{(k + a) * 3 * k + k + b}]"
        sum_a, sum_b = f"s[{(k + a) * 3 * k + b}]", f"s[{(k + b) * 3 * k + a}]"
        square_a, square_b = f"s[{(2 * k + a) * 3 * k + b}]", f"s[{(2 * k + b) * 3 * k + a}]"
        spread = f"sqrt(({square_a} - {sum_a} * {sum_a} / {n}) * ({square_b} - {sum_b} * {sum_b} / {n}))"
        return f"({product} - {sum_a} * {sum_b} / {n}) / nullif(nanvl({spread}, 0.0D), 0.0D)"

    entries = ", ".join(
        f"struct({a} as a, {b} as b, {correlation(a, b)} as r)" for a in range(k) for b in range(a)
    )
    names = F.array(*[F.lit(c) for c in columns])
    return table.select(F.expr(f"inline(array({entries}))")).select(
        F.get(names, F.col("a")).alias("feature_a"), F.get(names, F.col("b")).alias("feature_b"), rounded("r", digits).alias("r")
    )


def ecdf(df: DataFrame, value: str) -> DataFrame:
    """Cumulative share per distinct value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    steps = running_totals(counts, value, ["n"])
    return steps.select(value, (F.col("n_upto") / F.col("n_total")).alias("cdf"))


def roc_points(df: DataFrame, actual: str, score: str, model: str) -> DataFrame:
    """ROC curve per model by descending score threshold, starting at the origin (threshold NULL)."""
    per_score = df.groupBy(model, score).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg")
    )
    steps = running_totals(per_score, score, ["pos", "neg"], by=[model], descending=True)
    curve = steps.select(
        model,
        F.col(score).alias("threshold"),
        (F.col("neg_upto") / F.nullif(F.col("neg_total"), F.lit(0))).alias("fpr"),
        (F.col("pos_upto") / F.nullif(F.col("pos_total"), F.lit(0))).alias("tpr"),
    )
    zero = F.lit(0.0)
    start = per_score.select(model).distinct().select(
        model, F.lit(None).cast("double").alias("threshold"), zero.alias("fpr"), zero.alias("tpr")
    )
    return start.unionByName(curve.withColumn("threshold", F.col("threshold").cast("double")))


def roc_auc(df: DataFrame, actual: str, score: str, model: str) -> DataFrame:
    """Exact area under the ROC curve per model, by the rank-sum rule with ties counted half."""
    per_score = df.groupBy(model, score).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg")
    )
    steps = running_totals(per_score, score, ["pos", "neg"], by=[model])
    below = (F.col("neg_upto") - F.col("neg")).cast("double") + F.col("neg") / F.lit(2.0)
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return steps.groupBy(model).agg((F.sum(F.col("pos") * below) / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def disclosure(df: DataFrame, value: str) -> DataFrame:
    """Rows with a known value, all rows and the share."""
    return df.agg(F.count(value).alias("n_known"), F.count(F.lit(1)).alias("n_rows")).withColumn(
        "share", F.col("n_known") / F.nullif(F.col("n_rows"), F.lit(0))
    )


def relabelled_counts(df: DataFrame, flag_column: str, names: Mapping[int, str]) -> DataFrame:
    """Value counts of a flag under display names."""
    text = F.col(flag_column).cast("string")
    for code, name in names.items():
        text = F.when(F.col(flag_column) == code, F.lit(name)).otherwise(text)
    return value_counts(df, flag_column).select(text.alias("kind"), "n")
