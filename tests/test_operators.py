"""Operators against brute force on small frames: ties, gaps, hot keys, constant columns."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions.hashing import row_key, seeded_hash
from starloom.operators import aggregate, filters, joins, ordered, profile, project, ranking, sampling, scaling, sets, statistics


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


RNG = np.random.default_rng(7)
SHAPES = {
    "one": [5.0],
    "two": [1.0, 2.0],
    "ties": [3.0] * 50 + [4.0],
    "negative": RNG.normal(0, 1e-3, 101).tolist(),
    "heavy": RNG.lognormal(3, 4, 500).tolist() + [1e15, -1e15],
    "hot": [7.0] * 400 + RNG.uniform(0, 20, 800).tolist(),
    "tiny": RNG.uniform(0, 1e-9, 300).tolist(),
    "narrow": (1.7e12 + RNG.integers(0, 40_000, 900)).tolist(),
    "clusters": (1.7e12 + RNG.uniform(0, 5, 300)).tolist() + (-3e9 + RNG.uniform(0, 1e-3, 300)).tolist() + [0.0] * 100,
    "gaps": [None, 1.0, float("nan"), 9.0, None, 4.0],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles_are_exact(spark, shape):
    values = SHAPES[shape]
    known = [v for v in values if v is not None and not math.isnan(v)]
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.99, "f": 1.0}
    row = ordered.exact_quantiles(frame(spark, values), "v", probs).first()
    assert row["n"] == len(known)
    for name, q in probs.items():
        assert row[name] == pytest.approx(np.quantile(known, q), rel=1e-12, abs=1e-18)


def test_grouped_quantiles(spark):
    rows = [(g, v) for g, shape in (("x", "hot"), ("y", "heavy"), ("z", "one")) for v in SHAPES[shape]]
    df = spark.createDataFrame(rows, "g string, v double")
    for few in (True, False):
        got = {r["g"]: r for r in ordered.exact_quantiles(df, "v", {"q": 0.37}, by=["g"], few_groups=few).collect()}
        for g, shape in (("x", "hot"), ("y", "heavy"), ("z", "one")):
            assert got[g]["q"] == pytest.approx(np.quantile(SHAPES[shape], 0.37), rel=1e-12)


def test_narrow_columns_are_cut_into_slices(spark):
    df = frame(spark, SHAPES["narrow"]).distinct().withColumn("n", F.lit(1))
    buckets = df.select(ordered.order_bucket("v").alias("b")).distinct().count()
    low, high = df.agg(F.min("v"), F.max("v")).first()
    spans = df.withColumns({"_low": F.lit(low), "_high": F.lit(high)})
    assert buckets < 5 and spans.select(ordered._slice("v").alias("s")).distinct().count() > 300


def test_quantile_of_nothing(spark):
    df = frame(spark, [None, None])
    assert df.where(F.col("v") <= ordered.quantile(df, "v", 0.5)).count() == 0


def test_running_totals_cross_bucket_borders(spark):
    counts = Counter(round(float(v), 3) for v in SHAPES["heavy"] + SHAPES["hot"] + SHAPES["narrow"])
    df = spark.createDataFrame(list(counts.items()), "v double, n bigint")
    for descending in (False, True):
        got = ordered.running_totals(df, "v", ["n"], descending=descending).collect()
        total, expected = 0, {}
        for v in sorted(counts, reverse=descending):
            total += counts[v]
            expected[v] = total
        assert {r["v"]: r["n_upto"] for r in got} == expected
        assert {r["n_total"] for r in got} == {total}


def test_ecdf_with_ties(spark):
    got = {r["v"]: r["cdf"] for r in statistics.ecdf(frame(spark, [1.0, 2.0, 2.0, None, 5.0]), "v").collect()}
    assert got == {1.0: 0.25, 2.0: 0.75, 5.0: 1.0}


def test_roc_auc_against_pairs(spark):
    rows = [("m", int(RNG.random() < 0.4), float(round(RNG.random(), 1))) for _ in range(300)]
    df = spark.createDataFrame(rows, "model string, y int, s double")
    pos, neg = [s for _, y, s in rows if y == 1], [s for _, y, s in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(pos, neg))
    assert statistics.roc_auc(df, "y", "s", "model").first()["auc"] == pytest.approx(wins / len(pos) / len(neg))
    curve = statistics.roc_points(df, "y", "s", "model").orderBy("fpr", "tpr").collect()
    assert (curve[0]["fpr"], curve[0]["tpr"], curve[-1]["fpr"], curve[-1]["tpr"]) == (0.0, 0.0, 1.0, 1.0)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in itertools.pairwise(curve))
    assert area == pytest.approx(wins / len(pos) / len(neg))


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([("m", 1, 0.3), ("m", 1, 0.5)], "model string, y int, s double")
    assert statistics.roc_auc(df, "y", "s", "model").first()["auc"] is None


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 9.0, None], [4.0, 4.0, 4.0], RNG.normal(5, 2, 400).tolist()])
def test_histogram(spark, values):
    got = statistics.histogram(frame(spark, values), "v", 10).orderBy("bin").collect()
    counts, edges = np.histogram([v for v in values if v is not None], bins=10)
    assert [r["n"] for r in got] == list(counts)
    assert [r["low"] for r in got] == pytest.approx(list(edges[:-1]))


def test_correlations_pairwise_complete_and_constant(spark):
    x = RNG.normal(1e6, 1, 300)
    y = x + RNG.normal(0, 1, 300)
    rows = [
        (float(a), None if i % 3 == 0 else float(b), 5.0, None if i % 4 == 0 else float(i))
        for i, (a, b) in enumerate(zip(x, y, strict=True))
    ]
    df = spark.createDataFrame(rows, "x double, y double, c double, i double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in statistics.correlations(df, ["x", "y", "c", "i"], 6).collect()}
    data = np.array(rows, dtype=float)
    for (ai, a), (bi, b) in itertools.combinations(enumerate("xyci"), 2):
        both = ~np.isnan(data[:, ai]) & ~np.isnan(data[:, bi])
        expected = None if "c" in (a, b) else np.corrcoef(data[both, ai], data[both, bi])[0, 1]
        assert got[(b, a)] == (None if expected is None else pytest.approx(expected, abs=1e-6))
    with pytest.raises(ValueError):
        statistics.correlations(df, ["x", "y"])


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("other", 3.0), ("a", None)], "g string, v double")
    got = {r["g"]: r for r in statistics.box_stats(df, "g", "v", ["a", "b", "absent"]).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["q1"], got["a"]["median"], got["a"]["q3"]) == (2.0, 3.0, 4.0)
    assert (got["a"]["whisker_low"], got["a"]["whisker_high"], got["a"]["n_outliers"], got["a"]["n"]) == (1.0, 4.0, 1, 5)


def test_fan_out_join_keeps_every_row(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d"), (None, "e")], "k int, name string")
    hot = [(1, float(i)) for i in range(1000)]
    details = spark.createDataFrame([*hot, (2, None), (None, 8.0), (9, 9.0)], "k int, name double")
    got = joins.with_details(fact, details, "k", ["name"])
    rows = Counter((r["k"], r["name_x"], r["name_y"]) for r in got.collect())
    expected = Counter([(1, "a", v) for _, v in hot] + [(2, "b", None), (None, "c", None), (3, "d", None), (None, "e", None)])
    assert rows == expected
    assert joins.with_details(fact, details.drop("k"), "k", ["name"]) is fact


def test_dimension_and_count_joins(spark):
    fact = spark.createDataFrame([(1, 7), (2, None), (3, 8)], "job_id int, company_id int")
    dimension = spark.createDataFrame([(7, "seven"), (9, "nine")], "company_id int, name string")
    got = joins.with_dimension(fact, dimension, "company_id", ["name"]).orderBy("job_id").collect()
    assert [r["name"] for r in got] == ["seven", None, None]
    bridge = spark.createDataFrame([(1, "x")] * 500 + [(5, "y")], "job_id int, item string")
    counted = joins.with_counts(fact, bridge, "job_id", "n").orderBy("job_id").collect()
    assert [r["n"] for r in counted] == [500, 0, 0]


def test_key_check_and_lookup(spark):
    fact = spark.createDataFrame([(1, 5), (2, 6), (2, 4)], "k int, v int")
    keys = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    assert tuple(joins.missing_keys(keys, fact, "k").first()) == (3, 1, False)
    found = joins.lookup_rows(keys.distinct(), fact, "k", ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in found] == [(1, 5), (2, 4)]


def test_cooccurrence_with_repeats_and_hot_basket(spark):
    baskets = {0: ["a"] * 300 + ["b"] * 200, 1: ["a", "b", "c"], 2: ["c", "d"], 3: ["d"], 4: ["a", "a", "c"]}
    df = spark.createDataFrame([(k, i) for k, items in baskets.items() for i in items], "k int, item string")
    expected = Counter({pair: 0 for pair in itertools.permutations("abcd", 2)})
    for items in baskets.values():
        n = Counter(items)
        for a, b in itertools.permutations(n, 2):
            expected[a, b] += n[a] * n[b]
    got = {(r["item_a"], r["item_b"]): r["n"] for r in joins.cooccurrence(df, "k", "item", 15).collect()}
    assert got == dict(expected)
    top2 = {(r["item_a"], r["item_b"]): r["n"] for r in joins.cooccurrence(df, "k", "item", 2).collect()}
    assert top2 == {("a", "b"): expected["a", "b"], ("b", "a"): expected["b", "a"]}


def test_item_lists_and_sets(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "c")], "k int, item string")
    assert {r[0]: r[1] for r in aggregate.item_lists(df, "k", "item").collect()} == {1: ["a", "b", "b"], 3: ["c"]}
    assert {r[0]: r[1] for r in aggregate.item_sets(df, "k", "item").collect()} == {1: ["a", "b"], 3: ["c"]}


def test_counts_and_shares(spark):
    df = frame(spark, ["x", "y", "x", None], "string")
    assert [tuple(r) for r in aggregate.value_counts(df, "v").collect()] == [("x", 2), ("y", 1)]
    assert [tuple(r) for r in aggregate.value_shares(df, "v").collect()] == [("x", 2, 0.5), ("y", 1, 0.25)]
    got = aggregate.conditional_counts(df, {"known": F.col("v").isNotNull()}).first()
    assert tuple(got) == ("known", 3, 0.75)
    assert tuple(aggregate.summary(frame(spark, [1.0, None, 5.0, 3.0]), "v").first()) == (3, 3.0, 3.0, 1.0, 5.0)
    order = aggregate.present_in_order(df, "v", ["z", "y", "x"]).collect()
    assert [tuple(r) for r in order] == [(2, "y"), (3, "x")]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 2.0, None), (3, None, "c")], "i int, d double, s string")
    got = {r["column_name"]: r for r in profile.profile({"t": df}).collect()}
    assert (got["d"]["null_pct"], got["d"]["high_null"], got["i"]["null_pct"], got["i"]["n_rows"]) == (66.7, True, 0.0, 3)
    assert tuple(profile.overview(df).first()) == (3, 3, 2, 1, 3, 33.3)
    assert [r["column_name"] for r in profile.missing_columns(df).collect()] == ["d", "s"]
    filled = {"d": F.coalesce("d", F.lit(0.0))}
    assert {r["step"]: r["nulls"] for r in profile.null_totals(df, filled).collect()} == {"before": 3, "after": 1}
    empty = df.where("false")
    assert profile.overview(empty).first()["null_pct"] is None


def test_projections(spark):
    df = spark.createDataFrame([(1, "x", 2.0, True)], "` Job ID` int, work_type string, work_A double, work_B boolean")
    named = project.standard_names(df)
    assert named.columns == ["job_id", "work_type", "work_a", "work_b"]
    assert project.prefixed_columns(named, "work_") == ["work_a", "work_b"]
    assert project.split_by_type(named) == (["job_id", "work_a"], ["work_type", "work_b"])
    assert (project.item_column(named), project.key_column(named)) == ("work_b", "job_id")
    assert project.nulls_for_nan(frame(spark, [float("nan"), 1.0])).where("v is null").count() == 1


def test_quantile_filter(spark):
    values = [float(i) for i in range(101)]
    kept = filters.up_to_quantile(frame(spark, values), "v", 0.99)
    assert kept.count() == 100


@pytest.mark.parametrize("n", [1, 7, 100, 5000])
def test_sample_does_not_depend_on_partitioning(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = {r["k"] for r in sampling.sample_rows(df.repartition(1), "k", n).collect()}
    other = {r["k"] for r in sampling.sample_rows(df.repartition(7), "k", n).collect()}
    assert one == other and len(one) == min(n, 1000)
    hashes = {r["k"]: r["h"] for r in df.select("k", seeded_hash("k").alias("h")).collect()}
    assert one == set(sorted(hashes, key=lambda k: (hashes[k], k))[:n])


def test_hash_is_spread_evenly(spark):
    df = spark.range(20_000).select((seeded_hash("id") / F.lit(2.0**32)).alias("u"), (F.col("id") % 2).alias("odd"))
    for row in df.groupBy("odd").agg(F.avg("u"), F.stddev_pop("u")).collect():
        assert row[1] == pytest.approx(0.5, abs=0.01) and row[2] == pytest.approx(12**-0.5, abs=0.01)
    assert spark.range(5).select(row_key("id").alias("k")).where("k < 0").count() == 0


def test_split_share(spark):
    df = sampling.split_rows(spark.range(20_000).withColumnRenamed("id", "k"), "k")
    assert df.agg(F.avg("is_test")).first()[0] == pytest.approx(0.2, abs=0.01)


def test_stratified_split_is_exact(spark):
    df = spark.range(5003).select(F.col("id").alias("k"), (F.col("id") % 10 < 3).cast("int").alias("y"))
    got = sampling.stratified_split(df, "k", "y")
    assert got.count() == 5003
    for row in got.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("is_test").alias("t")).collect():
        assert row["t"] == math.ceil(0.2 * row["n"])
    with pytest.raises(Exception, match="not listed"):
        sampling.stratified_split(df, "k", "y", classes=(0,)).collect()


def test_scaling(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, None, 5.0), (3, 4.0, 5.0)], "k int, v double, c double")
    scaled = scaling.z_scores(df, ["v", "c", "absent"]).orderBy("k").collect()
    filled = np.array([2.0, 0.0, 4.0])
    assert [r["v_scaled"] for r in scaled] == pytest.approx(list((filled - filled.mean()) / filled.std()))
    assert [r["c_scaled"] for r in scaled] == [0.0, 0.0, 0.0]
    ranged = scaling.unit_range(df, ["v", "c"], 0.5).orderBy("k").collect()
    assert [r["v"] for r in ranged] == [0.25, 0.0, 0.5] and {r["c"] for r in ranged} == {0.0}
    target = scaling.with_scaled_target(df.dropna(), "v")
    back = target.orderBy("k").select("target_scaled", scaling.unscaled("target_scaled")).collect()
    assert [tuple(r) for r in back] == [(0.0, 2.0), (1.0, 4.0)]


def test_targets(spark):
    df = frame(spark, [0.0, 1.0, 2.0, 3.0, 4.0, None])
    high = scaling.top_share_flag(df, "v", "t").collect()
    assert [r["t"] for r in high] == [0, 0, 0, 1, 1, 0]
    demand = scaling.demand_flag(df, "v", "t").collect()
    assert [r["t"] for r in demand] == [None, 0.0, 0.0, 0.0, 1.0, None]


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.9), ("b", 3, 0.9), ("a", 4, 0.1)], "g string, k int, m double")
    top = ranking.top_per_group(df, "g", [F.desc("m")], 2)
    assert {(r["g"], r["k"], r["place"]) for r in top.collect()} == {("a", 2, 1), ("a", 1, 2), ("b", 3, 1)}
    assert tuple(ranking.best_by(df, "g", "m").first()) == ("a", 0.9)
    assert tuple(ranking.best_by(df, "g", "m", largest=False).first()) == ("a", 0.1)
    shares = ranking.share_of_selection(df, "m").agg(F.sum("share")).first()[0]
    assert shares == pytest.approx(1.0)


def test_metric_frames(spark):
    row = spark.createDataFrame([(0.5, 3)], "f1 double, n int")
    assert [tuple(r) for r in sets.long_metrics(row, "t", ["f1", "n"]).collect()] == [("t", "f1", 0.5), ("t", "n", 3.0)]
    table = spark.createDataFrame([("ols", 1.0, 0.5)], "model string, rmse double, r2 double")
    got = sets.with_naive_baseline(table, frame(spark, [1.0, 3.0]), "v", "naive").collect()
    assert [tuple(r) for r in got] == [("naive", 1.0, 0.0), ("ols", 1.0, 0.5)]


def test_item_flags_keep_one_small_state_a_key(spark):
    items = [f"i{n}" for n in range(70)]
    rows = [(1, "i0"), (1, "i0"), (1, "i69"), (2, "other"), (3, None), (None, "i61"), (2, "i62")]
    df = spark.createDataFrame(rows, "k int, item string")
    flags = aggregate.item_flags(df, "k", "item", items)
    got = {r["k"]: {c for c in items if r[c] == 1} for r in flags.collect()}
    assert got == {1: {"i0", "i69"}, 2: {"i62"}, 3: set(), None: {"i61"}}
    assert {t for c, t in flags.dtypes if c != "k"} == {"int"}


def test_basket_matrix_is_grouped_by_the_job_only(spark, small):
    from starloom.plans.catalog import QUERIES

    plan = QUERIES["arr_basket_matrix"](spark, small)._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("keys=")[1].split("]")[0] for line in plan.splitlines() if "Aggregate(" in line]
    assert keys and not any("skill_abr" in k for k in keys)


def test_item_sets_shuffle_once(spark):
    rows = [(1, "b"), (1, "a"), (1, "b"), (2, None), (3, "c"), (None, "d")] + [(4, f"i{n % 7}") for n in range(2000)]
    df = spark.createDataFrame(rows, "k int, item string").repartition(5)
    sets = aggregate.item_sets(df, "k", "item")
    got = {r["k"]: r["items"] for r in sets.collect()}
    assert got == {1: ["a", "b"], 3: ["c"], None: ["d"], 4: [f"i{n}" for n in range(7)]}
    assert sets._jdf.queryExecution().sparkPlan().toString().count("Aggregate(key") == 2
