"""Quality rules: statistics of texts and an ordered decision list learned from labelled ones by sequential covering.

The list is grown on the driver from the statistics of a bounded sample of labelled documents and is applied as one
ordered CASE expression. Statistics and verdicts are built-in expressions over whole texts, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import words_of

#: Statistics that rules may test: shares of words or of the code points in words.
FEATURES = {
    "words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: F.col("word_chars") / F.greatest("n_words", F.lit(1)),
    "symbol_share": lambda: F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
    "shout_share": lambda: F.col("n_shouts") / F.greatest("word_chars", F.lit(1)),
    "capital_share": lambda: F.col("n_capitals") / F.greatest("word_chars", F.lit(1)),
    "digit_share": lambda: F.col("n_digits") / F.greatest("word_chars", F.lit(1)),
    "distinct_share": lambda: F.col("n_distinct") / F.greatest("n_words", F.lit(1)),
    "repeat_share": lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
    "dup_line_share": lambda: F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
}
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouts", "n_capitals", "n_digits", "n_distinct", "n_lines"]


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is_at_least, threshold) and the verdict on what meets it."""

    tests: tuple[tuple[str, bool, float], ...]
    keep: bool


def with_statistics(rows: DataFrame, text: str, window: int = 8) -> DataFrame:
    """`rows` with the columns STATISTICS (long) of a text column. Null and empty texts have zeros.

    n_repeat_words counts the words of windows of `window` words that occur twice or more in the text. Windows are
    hashed and sorted as numbers; only where two are equal are they sorted again with their positions.
    """

    def only(kept: str) -> Column:
        return F.length(F.regexp_replace(F.col("_t"), f"[^{kept}]+", "")).cast("bigint")

    base = rows.withColumn("_t", F.coalesce(F.col(text), F.lit(""))).withColumn("_w", words_of(F.col("_t")))
    lines = F.filter(F.split(F.col("_t"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.when(
        F.size("_w") >= window, F.transform(F.sequence(F.lit(1), F.size("_w") - (window - 1)), lambda i: F.xxhash64(F.slice(F.col("_w"), i, window)))
    ).otherwise(F.array().cast("array<bigint>"))
    base = base.withColumn("_l", lines).withColumn("_h", hashes)
    # Sorted (window, position) pairs, only where some window is found twice.
    pairs = F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    base = base.withColumn("_p", pairs)
    again = F.filter("_p", lambda p, k: (F.get(F.col("_p"), k - 1)["h"].eqNullSafe(p["h"])) | (F.get(F.col("_p"), k + 1)["h"].eqNullSafe(p["h"])))
    base = base.withColumn("_r", F.sort_array(F.transform(again, lambda p: p["i"])))
    covered = F.aggregate(
        F.transform("_r", lambda p, k: F.least(F.lit(window), F.coalesce(F.get(F.col("_r"), k + 1) - p, F.lit(window)))), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    length = F.length(F.array_join("_w", ""))
    return base.withColumns(
        {
            "n_words": F.size("_w").cast("bigint"),
            "word_chars": length.cast("bigint"),
            "n_symbols": only("#*$%&|<>"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
            "n_repeat_words": covered,
            "n_shouts": only("!"),
            "n_capitals": only("A-Z"),
            "n_digits": only("0-9"),
            "n_distinct": F.size(F.array_distinct("_w")).cast("bigint"),
            "n_lines": F.size("_l").cast("bigint"),
        }
    ).drop("_t", "_w", "_l", "_h", "_p", "_r")


def labelled_statistics(documents: DataFrame, labels: DataFrame, most: int = 4096) -> list[tuple[list[float], bool]]:
    """Features and quality of labelled documents: at most `most` rows, those with the least hash of doc_id and text.

    Rows with a null doc_id, text or quality are not used.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = documents.where(F.col("text").isNotNull()).select("doc_id", F.col("text").alias("t"))
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("t")).limit(most)
    stats = with_statistics(rows, "t").select("quality", *[f().alias(n) for n, f in FEATURES.items()])
    return [([float(r[n]) for n in FEATURES], r["quality"] > 0) for r in stats.collect()]


def _meets(x: list[float], tests) -> bool:
    return all((x[i] >= c) if up else (x[i] < c) for i, up, c in tests)


def _grow(bad: list, good: list, most_tests: int, cuts: list[list[float]]) -> list[tuple[int, bool, float]]:
    """Adds the test with the best information gain until no good row is left or nothing is gained."""
    from math import log2

    tests = []
    while good and bad and len(tests) < most_tests:
        p, n, best = len(bad), len(good), (1e-9, None)
        for i, values in enumerate(cuts):
            for up in (True, False):
                for c in values:
                    a = sum((x[i] >= c) == up for x in bad)
                    b = sum((x[i] >= c) == up for x in good)
                    if a and a + b < p + n:
                        gain = a * (log2(a / (a + b)) - log2(p / (p + n)))
                        best = max(best, (gain, (i, up, c)), key=lambda g: g[0])
        if best[1] is None:
            break
        tests.append(best[1])
        bad, good = [x for x in bad if _meets(x, [best[1]])], [x for x in good if _meets(x, [best[1]])]
    return tests


def _prune(tests: list, bad: list, good: list) -> tuple[list, float, int]:
    """The beginning of the conjunction that does best on held-out rows, its precision there and the rows it meets."""

    def held(k: int) -> tuple[int, int]:
        return sum(_meets(x, tests[:k]) for x in bad), sum(_meets(x, tests[:k]) for x in good)

    scores = [((a + 1) / (a + b + 2), a, k) for k in range(1, len(tests) + 1) for a, b in [held(k)]]
    score, a, k = max(scores, default=(0.0, 0, 0))
    return tests[:k], score, a


def learn_rules(rows: list[tuple[list[float], bool]], most_rules: int = 12, most_tests: int = 3, precision: float = 0.9, thresholds: int = 24) -> list[Rule]:
    """Sequential covering: rules that reject, each grown on two thirds of the rows and pruned on the others.

    A rule stays if it is right in `precision` of the held-out rows that it meets; rows it meets are then set aside.
    Without rows of both kinds there are no rules, so everything is kept.
    """
    grow = [r for k, r in enumerate(rows) if k % 3]
    hold = [r for k, r in enumerate(rows) if not k % 3]
    names, found = list(FEATURES), []
    while len(found) < most_rules:
        bad, good = [x for x, y in grow if not y], [x for x, y in grow if y]
        if len(bad) < 5 or not good:
            break
        cuts = []
        for i in range(len(names)):
            values = sorted({x[i] for x in bad} | {x[i] for x in good})
            spread = values if len(values) <= 2 * thresholds else [sorted(x[i] for x in part)[len(part) * k // thresholds] for part in (bad, good) for k in range(thresholds)]
            cuts.append(sorted(set(spread)))
        tests, score, met = _prune(_grow(bad, good, most_tests, cuts), [x for x, y in hold if not y], [x for x, y in hold if y])
        if not tests or score < precision or met < 3:
            break
        found.append(Rule(tuple((names[i], up, c) for i, up, c in tests), False))
        grow = [r for r in grow if not _meets(r[0], tests)]
        hold = [r for r in hold if not _meets(r[0], tests)]
    return found


def verdict(rules: list[Rule]) -> Column:
    """The ordered rules as one CASE expression over the STATISTICS; what meets no rule is kept."""
    out = None
    for rule in rules:
        test = F.lit(True)
        for name, up, c in rule.tests:
            test = test & ((FEATURES[name]() >= c) if up else (FEATURES[name]() < c))
        out = F.when(test, F.lit(rule.keep)) if out is None else out.when(test, F.lit(rule.keep))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge_quality(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the STATISTICS, base_failed and kept for every row of documents (doc_id, text); repeated rows stay."""
    judged = with_statistics(documents.select("doc_id", "text"), "text").withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules)).drop("text")


def kept_documents(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of documents that pass, with their own columns, whatever these are called."""
    rows = documents.select(documents["text"].alias("_text"), F.struct(*[documents[c] for c in documents.columns]).alias("_row"))
    # A filter is not moved below a random column. Else the statistics would be copied into it, once for every use.
    judged = with_statistics(rows, "_text").select("_row", (~base_failed() & verdict(rules)).alias("_kept"), F.rand(0).alias("_draw"))
    return judged.where(F.col("_kept") & (F.col("_draw") >= 0)).select("_row.*")
