"""SQL twins of fitted models: trees grown level by level, normal equations and Newton steps as table expressions.

The statements are generated from parameters (features, depth, number of steps) and need no result of a fit.
"""

from __future__ import annotations

from starloom.plans.bindings import ONCE, hashed

#: Tables of test predictions: (job_id, actual, predicted, score) of classes, (job_id, actual, predicted, low, high) of values.
TREE, NEWTON = "tree_predictions", "newton_predictions"


def feature_list(names) -> str:
    return "[" + ", ".join(f'"{n}"' for n in names) + "]"


def split_classes(source: str, names, target: str) -> dict[str, str]:
    """fit_rows(job_id, f, y, is_test): the stratified split of a feature frame."""
    rows = f"(SELECT job_id, {feature_list(names)} AS f, {target} AS y FROM ({source}))"
    return {"fit_rows": f"""{ONCE}SELECT job_id, f, y, CAST(row_number() OVER (PARTITION BY y ORDER BY _h, job_id)
        <= ceil(0.2::DOUBLE * COUNT(*) OVER (PARTITION BY y)) AS INTEGER) AS is_test FROM {hashed(rows, "job_id")}"""}


def split_values(source: str, names, target: str) -> dict[str, str]:
    """fit_rows(job_id, f, y, is_test, low, high): the plain split, with the target on [0, 1] and its range."""
    rows = f"(SELECT job_id, {feature_list(names)} AS f, {target} AS t FROM ({source}))"
    return {
        "all_rows": f"{ONCE}SELECT *, min(t) OVER () AS low, max(t) OVER () AS high FROM {hashed(rows, 'job_id')}",
        "fit_rows": f"{ONCE}SELECT job_id, f, coalesce((t - low) / nullif(high - low, 0), 0) AS y, CAST(_h < 858993459 AS INTEGER) AS is_test, low, high FROM all_rows",
    }


def grown_tree(p: int, depth: int) -> dict[str, str]:
    """tree_nodes and tree_leaves of a Gini tree over fit_rows, whose thresholds are midpoints between known values.

    Gains are computed in the same order of double operations as by the learner; the first feature and the lowest
    threshold win a tie. Sibling leaves of one class are merged from the bottom up.
    """
    gini = "(1.0::DOUBLE - ({0}0 / {0}) * ({0}0 / {0}) - ({0}1 / {0}) * ({0}1 / {0}))"
    ctes = {
        "tree_values": f"""{ONCE}SELECT i, x, lead(x) OVER (PARTITION BY i ORDER BY x) AS nx
            FROM (SELECT DISTINCT i, f[i] AS x FROM fit_rows, range(1, {p + 1}) r(i) WHERE is_test = 0)""",
        "tree_rows0": f"{ONCE}SELECT *, 1::BIGINT AS node, 0 AS depth FROM fit_rows",
    }
    for d in range(depth):
        ctes[f"tree_sums{d}"] = f"""SELECT *, SUM(n0) OVER (PARTITION BY node, i) AS t0, SUM(n1) OVER (PARTITION BY node, i) AS t1,
            SUM(n0) OVER (PARTITION BY node, i ORDER BY x) AS l0, SUM(n1) OVER (PARTITION BY node, i ORDER BY x) AS l1 FROM (
            SELECT node, i, f[i] AS x, COUNT(*) FILTER (WHERE y = 0) AS n0, COUNT(*) FILTER (WHERE y = 1) AS n1
            FROM tree_rows{d}, range(1, {p + 1}) r(i) WHERE is_test = 0 AND depth = {d} GROUP BY ALL)"""
        ctes[f"tree_parts{d}"] = f"""SELECT node, i, x, t0::DOUBLE AS t0, t1::DOUBLE AS t1, (t0 + t1)::DOUBLE AS t, l0::DOUBLE AS l0, l1::DOUBLE AS l1,
            (l0 + l1)::DOUBLE AS l, (t0 - l0)::DOUBLE AS r0, (t1 - l1)::DOUBLE AS r1, (t0 + t1 - l0 - l1)::DOUBLE AS r
            FROM tree_sums{d} WHERE l0 + l1 < t0 + t1"""
        ctes[f"tree_best{d}"] = f"""{ONCE}SELECT node, i, (x + nx) / 2 AS threshold, gain FROM (
            SELECT *, {gini.format("t")} - l / t * {gini.format("l")} - r / t * {gini.format("r")} AS gain FROM tree_parts{d})
            JOIN tree_values USING (i, x) QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, i, x) = 1 AND gain > 0"""
        ctes[f"tree_rows{d + 1}"] = f"""{ONCE}SELECT r.* REPLACE (CASE WHEN b.node IS NULL THEN r.node ELSE 2 * r.node + CAST(f[b.i] > b.threshold AS BIGINT) END AS node,
            CASE WHEN b.node IS NULL THEN depth ELSE depth + 1 END AS depth) FROM tree_rows{d} r LEFT JOIN tree_best{d} b ON b.node = r.node AND r.depth = {d}"""
    counts = "SELECT node, COUNT(*) FILTER (WHERE y = 0 AND is_test = 0) AS n0, COUNT(*) FILTER (WHERE y = 1 AND is_test = 0) AS n1, COUNT(*) FILTER (WHERE is_test = 1) AS n_test"
    for d in range(depth, -1, -1):
        best = f"LEFT JOIN tree_best{d} USING (node)" if d < depth else ""
        split = "i, threshold, gain" if d < depth else "NULL::BIGINT AS i, NULL::DOUBLE AS threshold, NULL::DOUBLE AS gain"
        ctes[f"tree_level{d}"] = f"{ONCE}SELECT node, {d} AS depth, n0, n1, n_test, {split} FROM ({counts} FROM tree_rows{d} WHERE depth = {d} GROUP BY node) {best}"
        own = "CAST(n1 > n0 AS INTEGER)"
        ctes[f"tree_class{d}"] = (
            f"{ONCE}SELECT n.node, n.depth, CASE WHEN n.i IS NULL THEN {own} WHEN a.c = b.c THEN a.c END AS c FROM tree_level{d} n "
            f"LEFT JOIN tree_class{d + 1} a ON a.node = 2 * n.node LEFT JOIN tree_class{d + 1} b ON b.node = 2 * n.node + 1"
            if d < depth else f"{ONCE}SELECT node, depth, {own} AS c FROM tree_level{d}"
        )
    every = range(depth + 1)
    ctes["tree_classes"] = ONCE + " UNION ALL ".join(f"SELECT * FROM tree_class{d}" for d in every)
    ctes["tree_nodes"] = f"""{ONCE}SELECT n.* REPLACE (CASE WHEN c IS NULL THEN i END AS i, CASE WHEN c IS NULL THEN threshold END AS threshold,
        CASE WHEN c IS NULL THEN gain END AS gain), c IS NOT NULL AS leaf FROM ({" UNION ALL ".join(f"SELECT * FROM tree_level{d}" for d in every)}) n JOIN tree_classes USING (node)
        WHERE NOT EXISTS (SELECT 1 FROM tree_classes a WHERE a.c IS NOT NULL AND a.depth < n.depth AND n.node >> (n.depth - a.depth) = a.node)"""
    ctes[TREE] = f"""{ONCE}SELECT job_id, y AS actual, CAST(n1 > n0 AS INTEGER) AS predicted, n1 / (n0 + n1) AS score
        FROM tree_rows{depth} r JOIN tree_nodes l ON l.leaf AND l.depth <= r.depth AND r.node >> (r.depth - l.depth) = l.node WHERE is_test = 1"""
    return ctes


def solved(prefix: str, size: int) -> tuple[dict[str, str], str]:
    """Gauss-Jordan steps from <prefix>0(i, j, v), i in 1..size, j in 1..size + 1; the solution is column size + 1 of the
    table named second."""
    ctes = {}
    for k in range(1, size + 1):
        m = f"{prefix}{k - 1}"
        ctes[f"{prefix}{k}"] = f"""{ONCE}SELECT a.i, a.j, CASE WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v
            FROM {m} a JOIN {m} r ON r.i = {k} AND r.j = a.j JOIN {m} c ON c.j = {k} AND c.i = a.i JOIN {m} p ON p.i = {k} AND p.j = {k}"""
    return ctes, f"{prefix}{size}"


def least_squares(name: str, p: int, penalty: float) -> dict[str, str]:
    """<name>_weights(i, w) of the training rows of fit_rows, 0 for the intercept: least squares with `penalty` * |w|^2,
    and the test predictions <name>_predictions."""
    steps, last = solved(f"{name}_normal", p)
    return {
        "train_means": f"{ONCE}SELECT i, avg(f[i]) AS m, avg(y) AS my FROM fit_rows, range(1, {p + 1}) r(i) WHERE is_test = 0 GROUP BY i",
        "centred": f"{ONCE}SELECT list(m ORDER BY i) AS ms, any_value(my) AS my FROM train_means",
        f"{name}_normal0": f"""{ONCE}SELECT i, j, SUM((f[i] - ms[i]) * CASE WHEN j <= {p} THEN f[j] - ms[j] ELSE y - my END) + CASE WHEN i = j THEN {penalty}::DOUBLE ELSE 0 END AS v
            FROM fit_rows, centred, range(1, {p + 1}) r(i), range(1, {p + 2}) s(j) WHERE is_test = 0 GROUP BY i, j""",
        **steps,
        f"{name}_weights": f"""{ONCE}SELECT i, v AS w FROM {last} WHERE j = {p + 1}
            UNION ALL SELECT 0, any_value(my) - SUM(v * m) FROM {last} JOIN train_means USING (i) WHERE j = {p + 1}""",
        f"{name}_list": f"{ONCE}SELECT list(w ORDER BY i) AS ws FROM {name}_weights",
        f"{name}_predictions": f"""{ONCE}SELECT job_id, y AS actual, ws[1] + list_sum(list_transform(range(1, {p + 1}), lambda i: ws[i + 1] * f[i])) AS predicted, low, high
            FROM fit_rows, {name}_list WHERE is_test = 1""",
    }


def logistic(p: int, steps: int = 9) -> dict[str, str]:
    """newton_weights(i, w) of the least 1/2 |w|^2 + sum of log losses over the training rows, by Newton's method from 0."""
    n = p + 1  # the intercept is number n, its feature is 1
    ctes = {"newton_rows": f"{ONCE}SELECT job_id, list_append(f, 1.0::DOUBLE) AS f, y::DOUBLE AS y, is_test FROM fit_rows", "newton_w0": f"SELECT list_transform(range({n}), lambda i: 0.0::DOUBLE) AS ws"}
    for s in range(steps):
        ctes[f"newton_p{s}"] = f"""{ONCE}SELECT f, y, ws, 1.0::DOUBLE / (1.0::DOUBLE + exp(-list_sum(list_transform(range(1, {n + 1}), lambda i: ws[i] * f[i])))) AS q
            FROM newton_rows, newton_w{s} WHERE is_test = 0"""
        ctes[f"newton{s}_0"] = f"""{ONCE}SELECT i, j, CASE WHEN j <= {n} THEN SUM(f[i] * f[least(j, {n})] * q * (1 - q)) + CASE WHEN i = j AND i <= {p} THEN 1 ELSE 0 END
            ELSE SUM(f[i] * (q - y)) + CASE WHEN i <= {p} THEN any_value(ws[i]) ELSE 0 END END AS v
            FROM newton_p{s}, range(1, {n + 1}) r(i), range(1, {n + 2}) t(j) GROUP BY i, j"""
        solution, last = solved(f"newton{s}_", n)
        ctes |= solution
        ctes[f"newton_w{s + 1}"] = f"{ONCE}SELECT list(ws[i] - v ORDER BY i) AS ws FROM {last}, newton_w{s} WHERE j = {n + 1}"
    ctes["newton_weights"] = f"{ONCE}SELECT i % {n} AS i, ws[i] AS w FROM newton_w{steps}, range(1, {n + 1}) r(i)"
    ctes[NEWTON] = f"""{ONCE}SELECT job_id, actual, CAST(z > 0 AS INTEGER) AS predicted, 1.0::DOUBLE / (1.0::DOUBLE + exp(-z)) AS score FROM (
        SELECT job_id, y::INTEGER AS actual, list_sum(list_transform(range(1, {n + 1}), lambda i: ws[i] * f[i])) AS z FROM newton_rows, newton_w{steps} WHERE is_test = 1)"""
    return ctes


def named(names) -> str:
    """(i, feature) of the features, 0 for the intercept, to join with the weights."""
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(["(intercept)", *names]))
    return f"(VALUES {rows}) feature_names(i, feature)"
