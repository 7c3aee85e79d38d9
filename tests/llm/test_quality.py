"""Statistics against plain Python, the decision list on held-out labels, and edge rows."""

import re
from collections import Counter

import pytest

from starloom.llm import quality
from starloom.llm.queries import QUERIES, quality_rules


def statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if many[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    joined = "".join(words)
    return {
        "n_words": len(words), "word_chars": len(joined), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_shouts": text.count("!"), "n_capitals": sum("A" <= c <= "Z" for c in text), "n_digits": sum("0" <= c <= "9" for c in text), "n_distinct": len(set(words)), "n_lines": len(lines),
    }


def _features(s):
    words, chars = max(s["n_words"], 1), max(s["word_chars"], 1)
    return {
        "words": float(s["n_words"]), "word_length": s["word_chars"] / words, "symbol_share": s["n_symbols"] / chars, "shout_share": s["n_shouts"] / chars, "capital_share": s["n_capitals"] / chars,
        "digit_share": s["n_digits"] / chars, "distinct_share": s["n_distinct"] / words, "repeat_share": s["n_repeat_words"] / words, "dup_line_share": s["n_dup_lines"] / max(s["n_lines"], 1),
    }


def kept(text, rules):
    s = statistics(text)
    if s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"]:
        return False
    f = _features(s)
    return next((r.keep for r in rules if all((f[n] >= c) == up for n, up, c in r.tests)), True)


CASES = [None, "", " \n\t", "a", "a b c d e f g h " * 3, "x\n\nx\n \nx", "# * $ %&|<> é!", "one two three four five six seven eight nine one two three four five six seven eight", "w " * 25_000, "\x85\xa0 b", "Ab1 " * 30]


def test_statistics(spark):
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(CASES)] * 2, "doc_id bigint, text string, n_words string")
    rows = quality.judge_quality(df, []).collect()
    assert len(rows) == 2 * len(CASES)
    for r in rows:
        expected = statistics(CASES[r.doc_id])
        assert {k: r[k] for k in expected} == expected
        assert r.kept == (not r.base_failed) == kept(CASES[r.doc_id], [])


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rules = quality_rules(spark, small, docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = QUERIES["op2_quality_rules"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = statistics(texts[r.doc_id])
        assert {k: r[k] for k in expected} == expected and r.kept == kept(texts[r.doc_id], rules)


def test_rules_on_held_out_labels(spark, small):
    folder = f"{small}/../sf0.01"
    rules = quality_rules(spark, f"{small}/../sf0.1", spark.read.parquet(f"{small}/../sf0.1/documents.parquet"))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    usable = [d for d in labels if d in texts and len((texts[d] or "").split()) >= 20]
    good = [kept(texts[d], rules) for d in usable if labels[d]]
    bad = [kept(texts[d], rules) for d in usable if not labels[d]]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_learning():
    rows = [([float(k % 50)] + [0.5] * 8, k % 50 >= 20) for k in range(300)]
    (rule,) = quality.learn_rules(rows)
    assert rule.tests == (("words", False, 20.0),) and not rule.keep
    assert quality.learn_rules([]) == [] and quality.learn_rules([([1.0] * 9, True)] * 50) == []


@pytest.mark.parametrize("labels", [[], [(1, None, 0), (None, 1, 0)], [(1, 1, 0), (1, 0, 1), (99, 0, 0)]])
def test_edge_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "x")], "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert quality.learn_rules(quality.labelled_statistics(docs, known)) == []
    assert quality.kept_documents(docs.limit(0), []).count() == 0
