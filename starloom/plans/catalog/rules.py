"""Association rules."""

from pyspark.sql import functions as F

from starloom.functions.encode import RULE_LABELS, label
from starloom.functions.numeric import rounded
from starloom.mining import rules as R
from starloom.operators.joins import cooccurrence
from starloom.plans.bindings import _case, rnd
from starloom.plans.catalog.joins import TOP15
from starloom.plans.catalog.registry import query
from starloom.sources.sinks import rules_as_text

MEASURES = ["antecedent_support", "consequent_support", "support", "confidence", "lift"]
EXTRA = ["leverage", "conviction", "zhangs_metric"]

# Item sets of the six-item bridge as sorted text, by joining distinct (job, item) rows level by level.
_LEVELS = {
    "marks": "SELECT DISTINCT job_id, skill_abr AS i FROM small_bridge",
    "n_jobs": "SELECT COUNT(DISTINCT job_id)::DOUBLE AS n FROM marks",
    "sets1": "SELECT job_id, i AS s, i AS last FROM marks",
}
for k in range(2, 7):
    _LEVELS[f"sets{k}"] = f"SELECT p.job_id, s || ',' || i AS s, i AS last FROM sets{k - 1} p JOIN marks m ON p.job_id = m.job_id AND i > last"
_LEVELS["all_sets"] = " UNION ALL ".join(f"SELECT s, {k} AS length FROM sets{k}" for k in range(1, 7))
_LEVELS["itemsets"] = """SELECT s, length, COUNT(*) AS cnt, COUNT(*) / (SELECT n FROM n_jobs) AS support FROM all_sets
    GROUP BY 1, 2 HAVING COUNT(*) >= ceil(0.05 * (SELECT n FROM n_jobs))"""
_LEVELS["splits"] = """SELECT s, support, string_split(s, ',') AS parts, unnest(range(1, (1 << length) - 1)) AS mask
    FROM itemsets WHERE length > 1"""
_LEVELS["sides"] = """SELECT support,
    array_to_string(list_filter(parts, lambda x, i: (mask >> (i - 1)) & 1 = 1), ',') AS a,
    array_to_string(list_filter(parts, lambda x, i: (mask >> (i - 1)) & 1 = 0), ',') AS c FROM splits"""
_LEVELS["rule_set"] = """SELECT r.a, r.c, x.support AS antecedent_support, y.support AS consequent_support, r.support,
    r.support / x.support AS confidence, r.support / x.support / y.support AS lift
    FROM sides r JOIN itemsets x ON r.a = x.s JOIN itemsets y ON r.c = y.s WHERE r.support / x.support >= 0.1"""
_LEVELS["measured"] = """SELECT *, support - antecedent_support * consequent_support AS leverage,
    CASE WHEN confidence < 1 THEN (1 - consequent_support) / (1 - confidence) ELSE 'inf'::DOUBLE END AS conviction,
    greatest(support * (1 - antecedent_support), antecedent_support * (consequent_support - support)) AS rest FROM rule_set"""

_BASE = ", ".join(f"{rnd(m, 8)} AS {m}" for m in MEASURES)


def _transactions(t):
    return R.baskets(t.small_bridge, "job_id", "skill_abr")


def _rules(t, min_confidence=0.1):
    return R.association_rules(R.frequent_itemsets(_transactions(t)), min_confidence)


def _rounded(df, *columns):
    return df.withColumns({c: rounded(c, 8) for c in columns})


def _as_text(df):
    return rules_as_text(df, ",")


@query("arm_tx", """SELECT job_id, string_agg(DISTINCT skill_abr, ',' ORDER BY skill_abr) AS items FROM bridge GROUP BY 1""")
def _(t):
    return R.baskets(t.bridge, "job_id", "skill_abr", 30).withColumn("items", F.array_join("items", ","))


@query("arm_itemsets", f"SELECT s AS items, cnt AS n, {rnd('support', 8)} AS support, length FROM itemsets", _LEVELS)
def _(t):
    return _rounded(R.frequent_itemsets(_transactions(t)), "support").withColumn("items", F.array_join("items", ","))


@query("arm_rules", f"SELECT a AS antecedents, c AS consequents, {_BASE} FROM rule_set", _LEVELS)
def _(t):
    return _rounded(_as_text(_rules(t)).select("antecedents", "consequents", *MEASURES), *MEASURES)


@query("arm_extra", f"""SELECT a AS antecedents, c AS consequents, {rnd("leverage", 8)} AS leverage, {rnd("conviction", 6)} AS conviction,
    {rnd("coalesce(leverage / nullif(rest, 0), 0)", 8)} AS zhangs_metric FROM measured""", _LEVELS)
def _(t):
    rules = _as_text(_rules(t)).select("antecedents", "consequents", *EXTRA)
    return _rounded(rules, "leverage", "zhangs_metric").withColumn("conviction", rounded("conviction", 6))


_RANK = "row_number() OVER (ORDER BY round_even(lift * 1e10, 0) DESC, a, c)"


@query("arm_ranked", f"SELECT {_RANK} AS rank, a AS antecedents, c AS consequents, {rnd('lift', 8)} AS lift FROM rule_set", _LEVELS)
def _(t):
    return _rounded(_as_text(R.numbered_rules(_rules(t))).select("rank", "antecedents", "consequents", "lift"), "lift")


def _label_sql(column):
    one = _case("x", RULE_LABELS, "x")
    return f"array_to_string(list_transform(string_split({column}, ','), lambda x: {one}), ' + ')"


_TOP = "SELECT * FROM rule_set ORDER BY round_even(lift * 1e10, 0) DESC, a, c LIMIT {n}"


@query("arm_top", f"""SELECT {_label_sql("a")} || '  →  ' || {_label_sql("c")} AS rule_label, {rnd("support", 8)} AS support,
    {rnd("confidence", 8)} AS confidence, {rnd("lift", 8)} AS lift FROM ({_TOP.format(n=15)})""", _LEVELS)
def _(t):
    top = R.labelled_rules(R.top_rules(_rules(t), 15)).select("rule_label", "support", "confidence", "lift")
    return _rounded(top, "support", "confidence", "lift")


@query("arm_scatter", f"""SELECT {_label_sql("a")} AS antecedent_label, {_label_sql("c")} AS consequent_label, {rnd("support", 8)} AS support,
    {rnd("confidence", 8)} AS confidence, {rnd("lift", 8)} AS lift FROM rule_set""", _LEVELS)
def _(t):
    rows = R.labelled_rules(_rules(t)).select("antecedent_label", "consequent_label", "support", "confidence", "lift")
    return _rounded(rows, "support", "confidence", "lift")


@query("arm_cooccur", f"""SELECT {_case("item_a", RULE_LABELS, "item_a")} AS label_a, {_case("item_b", RULE_LABELS, "item_b")} AS label_b, n
    FROM pairs""", TOP15)
def _(t):
    pairs = cooccurrence(t.bridge, "job_id", "skill_abr", 15)
    return pairs.select(label("item_a", RULE_LABELS).alias("label_a"), label("item_b", RULE_LABELS).alias("label_b"), "n")


_RANGES = ["min_support", "max_support", "min_confidence", "max_confidence", "min_lift", "max_lift", "avg_confidence"]


#: Rules that the scorecard counts and the evaluation shows: fixed value.
EVALUATED = 0.3
_EVALUATED = _LEVELS | {"evaluated": f"SELECT * FROM rule_set WHERE confidence >= {EVALUATED}"}


def task_metrics(t):
    """Numbers of the evaluated rules; stored once a session."""
    return t._stage("rule_metrics", lambda: R.rule_summary(_rules(t, EVALUATED)))


@query("arm_eval", "SELECT COUNT(*) AS total_rules, " + ", ".join(
    f"{rnd(f'{p}({m})', 8)} AS {p}_{m}" for m in ("support", "confidence", "lift") for p in ("min", "max"))
    + f""", COUNT(*) FILTER (WHERE lift > 1.5) AS n_lift_above, COUNT(*) FILTER (WHERE confidence > 0.5) AS n_confidence_above,
    {rnd("avg(confidence)", 8)} AS avg_confidence FROM rule_set""", _LEVELS)
def _(t):
    """Numbers of all rules; the scorecard counts those of the evaluation."""
    return _rounded(R.rule_summary(_rules(t)), *_RANGES)


@query("arm_eval_top", f"""SELECT rank, a AS antecedents, c AS consequents, {rnd("support", 8)} AS support, {rnd("confidence", 8)} AS confidence,
    {rnd("lift", 8)} AS lift FROM (SELECT *, {_RANK} AS rank FROM evaluated) WHERE rank <= 5""", _EVALUATED)
def _(t):
    """The five leading rules that the evaluation shows."""
    top = R.numbered_rules(R.top_rules(_rules(t, EVALUATED), 5))
    return _rounded(_as_text(top).select("rank", "antecedents", "consequents", "support", "confidence", "lift"), "support", "confidence", "lift")


@query("srt_head_rules", f"""SELECT a AS antecedents, c AS consequents, {rnd("support", 8)} AS support, {rnd("confidence", 8)} AS confidence,
    {rnd("lift", 8)} AS lift FROM ({_TOP.format(n=20)})""", _LEVELS)
def _(t):
    shown = ["support", "confidence", "lift"]
    return _rounded(_as_text(R.top_rules(_rules(t), 20)).select("antecedents", "consequents", *shown), *shown)
