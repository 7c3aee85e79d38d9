"""The quality classifier: its indicators, its optimum, its calibration and its held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import classifier as C
from starloom.llm.queries import QUERIES


def _sets(*texts):
    return [set(x.tolist()) for x in C.indicators(pa.array(texts, pa.string()))]


def test_indicators_belong_to_one_text():
    """A text has the same indicators alone and between others; n-grams don't cross texts."""
    texts = ["The cat sat", None, "", "é ü!!", "a", "the the the", "the cat\tsat\n", " ", "x" * 5000, "x y " * 700]
    together = _sets(*texts)
    for text, found in zip(texts, together, strict=True):
        assert found == _sets(text)[0]
    assert together[1] == together[2] == set()
    # Byte n-grams of "a": one; and its word.
    assert len(together[4]) == 2
    # Equal words in a row share indicators whatever the word is.
    runs = {int(C._numbers(np.array([k * 7919], np.uint64))[0]) for k in (2, 3)}
    assert runs <= together[5] and runs <= _sets("dog dog dog")[0] and not runs <= together[0]


def test_number_of_indicators():
    text = "Ab cd ab"
    grams = {text.encode()[i : i + n] for n in range(1, 5) for i in range(len(text) - n + 1)}
    words = {("ab",), ("cd",), ("ab", "cd"), ("cd", "ab")}
    assert len(_sets(text)[0]) == len(grams) + len(words)


def test_packed_sets():
    draw = np.random.default_rng(0)
    for n in (0, 1, 8191, 8192, 8193, 100_000):
        numbers = np.sort(draw.choice(C.WIDTH, n, replace=False))
        assert (C._unpacked(C._packed(numbers)) == numbers).all() and len(C._packed(numbers)) <= C.WIDTH // 8


def test_descent_reaches_the_optimum():
    """The primal loss at the found weights equals the dual value, so both are optimal."""
    draw = np.random.default_rng(1)
    rows, signs = [], np.where(draw.random(60) < 0.4, 1.0, -1.0)
    for s in signs:
        numbers = np.unique(draw.choice(40, 12))
        values = draw.normal(size=len(numbers)) + 0.3 * s
        rows.append((numbers, values / np.sqrt(values @ values)))
    weights, bias = C.descend(rows, signs, 1.0, 2000, 3)
    margins = np.array([weights[n] @ v + bias for n, v in rows]) * signs
    primal = (weights @ weights + bias * bias) / 2 + np.maximum(0, 1 - margins).sum()
    for shift in draw.normal(size=(50, 41)) * 0.02:
        moved, b = weights.copy(), bias + shift[40]
        moved[:40] += shift[:40]
        other = (moved @ moved + b * b) / 2 + np.maximum(0, 1 - np.array([moved[n] @ v + b for n, v in rows]) * signs).sum()
        assert other >= primal - 1e-2


def test_calibration_matches_frequencies():
    draw = np.random.default_rng(2)
    m = draw.normal(size=20000)
    good = draw.random(20000) < 1 / (1 + np.exp(-(2.5 * m + 0.7)))
    assert C.calibration(m, good) == pytest.approx((2.5, 0.7), abs=0.12)


def _world(spark, n, seed=4):
    draw = random.Random(seed)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "do"]
    rows, labels = [], []
    for i in range(n):
        good = draw.random() < 0.7
        text = " ".join(draw.choice(words) + ("" if good or draw.random() < 0.5 else draw.choice(("$$$", "!!"))) for _ in range(draw.randrange(5, 60)))
        rows.append((i, text, i % 2, "en"))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id bigint, text string, score int, held_out string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_rows_are_never_learnt(spark):
    docs, labels = _world(spark, 400)
    before = C.scores(docs, C.fitted(docs, labels)).collect()
    # Turning around the labels of all held-out rows changes nothing.
    turned = labels.withColumn("quality", F.when(C.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(before) == sorted(C.scores(docs.repartition(7), C.fitted(docs.repartition(5), turned)).collect())
    for r in before:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    tested = [(r.predicted, truth[r.doc_id]) for r in before if r.held_out]
    assert sum(a == b for a, b in tested) > 0.95 * len(tested) > 0


def test_edges(spark):
    docs, labels = _world(spark, 200)
    odd = spark.createDataFrame([(None, None, 1, "x"), (900, None, 1, "x"), (901, "", 1, "x"), (901, "", 1, "x"), (902, "word " * 200_000, 1, "x"), (903, "\x00\n", 1, "x")], docs.schema)
    labels = labels.union(spark.createDataFrame([(None, 1, 0), (0, None, 0), (1, 5, 0), (2, 0, 0), (2, 1, 0), (5000, 1, 1)], labels.schema))
    both = docs.union(odd)
    model = C.fitted(both, labels)
    found = C.scores(both, model).collect()
    assert len(found) == 206 and all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.doc_id in (None, 900, 901)}
    assert len(empty) == 1 and next(r for r in found if r.doc_id is None).held_out
    assert C.scores(docs.limit(0), model).count() == 0
    for few in (labels.limit(0), labels.where("quality = 1")):
        flat = {r.score for r in C.scores(docs, C.fitted(docs, few)).collect()}
        assert len(flat) == 1 and 0 < min(flat) < 1


def test_held_out_accuracy(spark):
    """On the given tables: of held-out labelled rows at least 0.95 are right, and the order separates the classes."""
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op13_quality_classifier"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in found if r.quality == 1], [r.score for r in found if r.quality == 0]
    assert len(good) > 20 and len(bad) > 5
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found)
    assert sum(b < g for g in good for b in bad) >= 0.99 * len(good) * len(bad)
