"""Phrase collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from starloom.llm import phrases
from starloom.llm.phrases import Settings

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, phrase string, n bigint"


def _brute(rows, s=Settings()):
    counts, totals, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWERED)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            totals[lang] += len(w)
            for k in range(1, s.longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        candidates, within, found = {p: a for p, a in f.items() if len(p) > 1 and a >= s.support}, Counter(), []
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    within[p[i : i + m]] = max(within[p[i : i + m]], a)
        for p, a in candidates.items():
            if not (p in within and 100 * within[p] >= s.absorbed * a):
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[: s.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def _rows(spark, rows, s=Settings(), parts=1):
    docs = spark.createDataFrame([(k, t, lang, "x", 1) for k, (t, lang) in enumerate(rows)], SCHEMA).repartition(parts)
    return sorted(map(tuple, phrases.collocations(docs, s).collect()))


def test_edges(spark):
    rows = [(None, "en"), ("", None), ("  \t ", "en"), ("...;;\n", "en"), ("Big CAT\tbig  cat É É" * 6, None), ("a b. a b, a b\ra b!" * 4, "und")]
    rows += [("big cat sat", "en")] * 12 + [("big cat", "en")] * 12 + [("big cat sat down", "de")] * 9 + [("x x x x x x x x x x x x x", "de")] + [("solo", "fr")]
    rows += [("of the " * 40_000, "en")]
    assert _rows(spark, rows, parts=5) == _brute(rows)


def test_nothing_to_find(spark):
    assert _rows(spark, []) == []
    assert _rows(spark, [(None, None), ("a b c d", "en")]) == []


def test_random_texts_over_shards(spark):
    draw = random.Random(3)
    words = [chr(97 + i) for i in range(26)] + ["ß", "日本", "x\x00y", "\xa0"]
    rows = [(" ".join(draw.choice(words[: draw.choice((3, 8, 30))]) + draw.choice(("", "", "", ",")) for _ in range(draw.randrange(60))), draw.choice(("en", "de", None))) for _ in range(400)]
    for s in (Settings(), Settings(support=7, longest=4, absorbed=30, top=25, shards=2), Settings(support=5, longest=2, shards=9)):
        assert _rows(spark, rows, s, parts=7) == _brute(rows, s)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = sorted(map(tuple, phrases.collocations(docs).collect()))
    assert found == _brute([(r.text, r.lang) for r in docs.collect()]) and len(found) > 100


def test_products_beyond_64_bits(spark):
    """Scores of counts whose products need more than 64 bits are exact."""
    f = {("a",): 987_654_321_987_654, ("b",): 876_543_219_876_543, ("a", "b"): 765_432_198_765_432}
    counts = spark.createDataFrame([("en", len(p), " ".join(p), n) for p, n in f.items()], "lang string, size int, phrase string, n bigint")
    row = phrases.scored(counts).first()
    a, left, right = f["a", "b"], f["a",], f["b",]
    assert (row.score, row.a, row.l, row.r) == (1000000 * a * a // (left * right), a, left, right)


def test_saturated_filter_changes_nothing(spark, monkeypatch):
    """Where the filter holds too few bits to tell phrases apart, the exact count still decides."""
    rows = [(f"w{i % 97} w{i % 89} w{i % 7}", "en") for i in range(3000)]
    held = phrases._may_hold
    expected = _brute(rows)
    monkeypatch.setattr(phrases, "_may_hold", lambda bits, keys, kind: held(bits, keys, kind) | True)
    assert _rows(spark, rows, parts=3) == expected


def test_languages_with_unlike_shares(spark):
    docs = spark.range(0, 900).select("id", F.lit("red apple pie").alias("text"), F.when(F.col("id") < 850, "en").when(F.col("id") < 890, "de").otherwise("fr").alias("lang"))
    found = phrases.collocations(docs).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in found} == {"en": 1, "de": 1, "fr": 1}
