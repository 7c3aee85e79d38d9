"""Cluster matrix, quality indices on given labels, and fitted clusters."""

from pyspark.sql import functions as F

from starloom.functions.numeric import rounded
from starloom.mining import cluster as C
from starloom.plans.bindings import ONCE, _case, hashed, rnd
from starloom.plans.catalog.registry import query
from starloom.functions.encode import CLUSTER_LABELS
from starloom.session import materialize

_CTES = {
    "ranked_items": "SELECT skill_abr, row_number() OVER (ORDER BY COUNT(*) DESC, skill_abr) AS r FROM bridge GROUP BY 1",
    "kept_items": "SELECT list(skill_abr ORDER BY r) AS classes FROM ranked_items WHERE r <= 20",
    "held": "SELECT DISTINCT job_id, skill_abr FROM bridge SEMI JOIN (SELECT * FROM ranked_items WHERE r <= 20) USING (skill_abr)",
    "held_sets": "SELECT job_id, list(skill_abr ORDER BY skill_abr) AS items FROM held GROUP BY 1",
    "with_attributes": "SELECT h.job_id, items, experience_encoded AS e, company_size_encoded AS c, is_remote AS r "
    "FROM held_sets h JOIN encoded USING (job_id)",
    # Labels of the profile queries: the posting's work type stands for its cluster.
    "grouped": f"""SELECT e.job_id, CAST({_case("work_type", {"CONTRACT": 0, "FULL_TIME": 1, "PART_TIME": 2}, "-1")} AS INTEGER) AS cluster, skill_abr AS item
        FROM encoded e JOIN (SELECT DISTINCT job_id, skill_abr FROM bridge) b USING (job_id)""",
    "item_share": """SELECT cluster, item, COUNT(*) / any_value(n)::DOUBLE AS share FROM grouped JOIN
        (SELECT cluster AS k, COUNT(DISTINCT job_id) AS n FROM grouped GROUP BY 1) ON cluster = k GROUP BY 1, 2""",
    "placed": "SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY share DESC, item) AS place FROM item_share",
}


def _scaled(column):
    low, high = f"(SELECT min({column}) FROM with_attributes)", f"(SELECT max({column}) FROM with_attributes)"
    return f"coalesce(({column} - {low}) / nullif({high} - {low}, 0)::DOUBLE, 0) * 0.5"


def _grouped(t):
    from starloom.operators.aggregate import item_sets

    codes = F.when(F.col("work_type") == "CONTRACT", 0).when(F.col("work_type") == "FULL_TIME", 1).otherwise(2)
    groups = t.prepared.select("job_id", codes.alias("cluster"))
    return item_sets(t.bridge, "job_id", "skill_abr").join(groups, "job_id")


def matrix(t, top=35):
    return C.category_matrix(t.small_bridge, t.prepared, "job_id", "skill_abr", top)


def evaluation_matrix(t):
    return C.category_matrix(t.small_bridge, None, "job_id", "skill_abr", 50)


def clustered(t, k=None, restarts=10):
    """The matrix, the model with k clusters, or with as many as have the best silhouette, and the labelled rows."""
    rows = materialize(matrix(t))
    model = C.best_model(rows, "job_id", restarts=restarts) if k is None else C.fit_kmeans(rows, k, restarts)
    return rows, model, materialize(C.assign(model, rows))


@query("clu_matrix", f"""SELECT job_id, array_to_string(list_transform(classes, lambda x: CAST(list_contains(items, x) AS INTEGER)), '') AS hot,
    {rnd(_scaled("e"), 6)} AS experience, {rnd(_scaled("c"), 6)} AS company_size, {rnd(_scaled("r"), 6)} AS remote
    FROM with_attributes, kept_items""", _CTES)
def _(t):
    rows = C.category_matrix(t.bridge, t.prepared, "job_id", "skill_abr", top=20)
    hot = F.transform(F.slice("features", 1, F.size("features") - 3), lambda x: x.cast("int").cast("string"))
    tail = {"experience": -3, "company_size": -2, "remote": -1}
    return rows.select(
        "job_id",
        F.array_join(hot, "").alias("hot"),
        *[rounded(F.element_at("features", i), 6).alias(name) for name, i in tail.items()],
    )


@query("clu_numeric", f"""SELECT job_id, CAST(skill_count AS DOUBLE) AS skill_count, applies, views, CAST(experience_encoded AS DOUBLE) AS experience_encoded,
    CAST(company_size_encoded AS DOUBLE) AS company_size_encoded, coalesce(salary_clean, 0) AS salary_clean FROM encoded""")
def _(t):
    rows = C.numeric_matrix(t.prepared, "job_id")
    return rows.select("job_id", *[F.col("features")[i].alias(c) for i, c in enumerate(C.FALLBACK_FEATURES)])


# The matrix of the fits in SQL: all categories of the small bridge, then the scaled attributes.
_FIT = {k: v.replace("FROM bridge", "FROM small_bridge").replace("r <= 20", "r <= 35") for k, v in _CTES.items() if k in ("ranked_items", "kept_items", "held", "held_sets", "with_attributes")}
_FIT["fit_matrix"] = f"""{ONCE}SELECT job_id, list_concat(list_transform(classes, lambda x: CAST(list_contains(items, x) AS DOUBLE)),
    [{_scaled("e")}, {_scaled("c")}, {_scaled("r")}]) AS v FROM with_attributes, kept_items"""
_FIT["fit_cells"] = f"{ONCE}SELECT job_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS d FROM fit_matrix"


@query("clu_kmeans", f"""SELECT COUNT(DISTINCT job_id) AS n, COUNT(DISTINCT job_id) AS n_nearest, {rnd("SUM((x - m) * (x - m))", 4)} AS sum_of_squares
    FROM fit_cells JOIN (SELECT d, avg(x) AS m FROM fit_cells GROUP BY 1) USING (d)""", _FIT)
def _(t):
    """Whether the fit is at rest: every basket at the nearest centre, and the squares within and between the clusters add
    up to the total that SQL computes, which they do only if every centre is the mean of its baskets."""
    _, model, labelled = clustered(t)
    return C.decomposition(labelled, model).withColumn("sum_of_squares", rounded("sum_of_squares", 4))


@query("clu_best_k")
def _(t):
    return C.choose_k(matrix(t), "job_id")


def task_metrics(t):
    """The evaluation preset: top 50 categories, no numeric attributes, k from 2 to 8 over all rows; stored once a session."""
    return t._stage("clustering_metrics", lambda: C.evaluate(materialize(evaluation_matrix(t)), "job_id"))


@query("clu_evaluate")
def _(t):
    return task_metrics(t)


_PAIRS = """SELECT a.vec_id AS id, a.cluster AS own, b.cluster AS other, SUM(list_distance(a.features, b.features)) AS total,
    COUNT(*) AS n FROM sample a JOIN sample b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3"""
_SILHOUETTE = {
    "sample": f"SELECT * FROM {hashed('vectors', 'vec_id')} ORDER BY _h, vec_id LIMIT 2000",
    "distances": _PAIRS,
    "points": """SELECT id, max(total / n) FILTER (WHERE own = other) AS a, min(total / n) FILTER (WHERE own <> other) AS b
        FROM distances GROUP BY 1""",
}


@query("clu_silhouette", f"""SELECT COUNT(*) AS n, {rnd("avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)", 6)} AS silhouette
    FROM points""", _SILHOUETTE)
def _(t):
    result = C.silhouette(t.vectors, "vec_id", 2000)
    return result.select("n", rounded("silhouette", 6).alias("silhouette"))


_DBI = {
    "spots": "SELECT vec_id, cluster, unnest(features) AS x, unnest(range(1, len(features) + 1)) AS d FROM vectors",
    "centres": "SELECT cluster, list(m ORDER BY d) AS centre FROM (SELECT cluster, d, avg(x) AS m FROM spots GROUP BY 1, 2) GROUP BY 1",
    "spreads": """SELECT v.cluster, any_value(centre) AS centre, avg(list_distance(v.features, centre)) AS s
        FROM vectors v JOIN centres USING (cluster) GROUP BY 1""",
}


@query("clu_dbi", f"""SELECT CAST(COUNT(*) AS INTEGER) AS k, {rnd("avg(w)", 6)} AS davies_bouldin FROM (
    SELECT a.cluster, max((a.s + b.s) / list_distance(a.centre, b.centre)) AS w FROM spreads a JOIN spreads b ON a.cluster <> b.cluster
    GROUP BY 1)""", _DBI)
def _(t):
    result = C.davies_bouldin(t.vectors)
    return result.select("k", rounded("davies_bouldin", 6).alias("davies_bouldin"))


@query("clu_sizes", f"SELECT cluster, COUNT(*) AS n, {rnd('COUNT(*) / (SELECT COUNT(*) FROM vectors)::DOUBLE', 8)} AS share FROM vectors GROUP BY 1")
def _(t):
    return C.cluster_sizes(t.vectors).withColumn("share", rounded("share", 8))


@query("clu_profile", f"""SELECT cluster, item, {rnd("share", 8)} AS share, CAST(place AS INTEGER) AS place FROM placed WHERE place <= 5""", _CTES)
def _(t):
    return C.cluster_profile(C.item_shares(_grouped(t))).withColumn("share", rounded("share", 8))


@query("clu_names", f"""SELECT cluster, string_agg({_case("item", CLUSTER_LABELS, "item")}, ' & ' ORDER BY place) AS name FROM placed
    WHERE place <= 2 AND (share >= 0.12 OR place = 1) GROUP BY 1""", _CTES)
def _(t):
    return C.cluster_names(C.item_shares(_grouped(t)))


def _principal(step, matrix_name):
    """Largest eigenvalue and its vector of a symmetric matrix (list of rows): the matrix is squared until one column is left
    of it, brought to trace 1 each time."""
    product = "list_transform(m, lambda a: list_transform(m, lambda b: list_dot_product(a, b) / t))"
    trace = "list_sum(list_transform(range(1, len(m) + 1), lambda i: m[i][i]))"
    return {
        f"squared{step}": f"""{ONCE}SELECT m FROM (WITH RECURSIVE s(n, m) AS (SELECT 0, m FROM {matrix_name} UNION ALL
            SELECT n + 1, {product} FROM (SELECT n, m, {trace} AS t FROM s) WHERE n < 40) SELECT m FROM s ORDER BY n DESC LIMIT 1)""",
        f"column{step}": f"""{ONCE}SELECT list_transform(c, lambda x: x / sqrt(list_dot_product(c, c))) AS u FROM (SELECT m[list_position(
            list_transform(range(1, len(m) + 1), lambda i: m[i][i]), list_max(list_transform(range(1, len(m) + 1), lambda i: m[i][i])))] AS c FROM squared{step})""",
        f"axis{step}": f"""{ONCE}SELECT list_transform(u, lambda x: x * CASE WHEN u[list_position(w, list_max(w))] >= 0 THEN 1 ELSE -1 END) AS u,
            list_dot_product(u, list_transform(m, lambda a: list_dot_product(a, u))) AS value
            FROM (SELECT u, m, list_transform(u, lambda x: round(abs(x), 9)) AS w FROM column{step}, {matrix_name})""",
        f"rest{step}": f"""{ONCE}SELECT list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1), lambda j: m[i][j] - value * u[i] * u[j])) AS m
            FROM {matrix_name}, axis{step}""",
    }


_PCA = _FIT | {
    "fit_mean": f"{ONCE}SELECT list(m ORDER BY d) AS mean FROM (SELECT d, avg(x) AS m FROM fit_cells GROUP BY 1)",
    "fit_covariance": f"""{ONCE}SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM (SELECT i, j, SUM((v[i] - mean[i]) * (v[j] - mean[j])) / (COUNT(*) - 1) AS c
        FROM fit_matrix, fit_mean, (SELECT unnest(range(1, len(mean) + 1)) AS i FROM fit_mean) a, (SELECT unnest(range(1, len(mean) + 1)) AS j FROM fit_mean) b GROUP BY 1, 2) GROUP BY 1)""",
    **_principal(1, "fit_covariance"),
    **_principal(2, "rest1"),
    "spread": f"{ONCE}SELECT list_sum(list_transform(range(1, len(m) + 1), lambda i: m[i][i])) AS total FROM fit_covariance",
}


@query("clu_pca", f"""SELECT 1::INTEGER AS component, {rnd("value / total", 8)} AS explained FROM axis1, spread
    UNION ALL SELECT 2, {rnd("value / total", 8)} FROM axis2, spread""", _PCA)
def _(t):
    """Shares of the variance; the SQL finds the leading eigenvalues of the covariance matrix."""
    rows = matrix(t)
    return C.explained_variance(C.fit_projection(rows), rows).withColumn("explained", rounded("explained", 8))


@query("clu_projection", f"""SELECT job_id, {rnd("list_dot_product(list_transform(range(1, len(v) + 1), lambda i: v[i] - mean[i]), axis1.u)", 5)} AS pc1,
    {rnd("list_dot_product(list_transform(range(1, len(v) + 1), lambda i: v[i] - mean[i]), axis2.u)", 5)} AS pc2
    FROM (SELECT * FROM {hashed("fit_matrix", "job_id")} ORDER BY _h, job_id LIMIT 10000), fit_mean, axis1, axis2""", _PCA)
def _(t):
    """The points of the scatter chart, without their clusters."""
    rows = matrix(t)
    points = C.project(C.fit_projection(rows), C.sample_rows(rows, "job_id", 10_000))
    return points.select("job_id", rounded("pc1", 5).alias("pc1"), rounded("pc2", 5).alias("pc2"))


@query("clu_centroids")
def _(t):
    rows, model, _ = clustered(t)
    return C.project_centroids(C.fit_projection(rows), model, t.spark)


@query("clu_plane", f"""SELECT 1::INTEGER AS component, (SELECT COUNT(*) FROM fit_matrix) AS n,
    {rnd("value * ((SELECT COUNT(*) FROM fit_matrix) - 1)", 4)} AS sum_of_squares FROM axis1
    UNION ALL SELECT 2, (SELECT COUNT(*) FROM fit_matrix), {rnd("value * ((SELECT COUNT(*) FROM fit_matrix) - 1)", 4)} FROM axis2""", _PCA)
def _(t):
    """Whether the projected centres belong to the projected rows: squares within and between the clusters, on each axis, add
    up to what the eigenvalues that SQL finds give for all rows."""
    rows, model, labelled = clustered(t)
    return C.plane_decomposition(C.fit_projection(rows), labelled, model).withColumn("sum_of_squares", rounded("sum_of_squares", 4))


@query("clu_scatter")
def _(t):
    rows, _, labelled = clustered(t)
    names = C.cluster_names(C.item_shares(labelled))
    return C.scatter(C.fit_projection(rows), labelled, names, "job_id")
