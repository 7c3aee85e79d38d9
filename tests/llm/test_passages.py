"""Repeated byte strings against a dictionary of all strings."""

import hashlib
import random

import numpy as np

from starloom.llm import passages
from starloom.llm.queries import QUERIES

SPAN = passages.SPAN


def _brute(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - SPAN + 1):
            s = b[k : k + SPAN]
            first[s] = min(d, first.get(s, d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, np.int8)
        for k in range(len(b) - SPAN + 1):
            if first[b[k : k + SPAN]] < d:
                gone[k : k + SPAN] = 1
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _found(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert _found(QUERIES["op8_suffix_dedup"](spark, small)) == _brute(rows)


def test_edits_passages_and_edges(spark):
    draw = random.Random(4)
    base = "".join(draw.choice("abcdefgh é") for _ in range(600))
    rows = [(k, "x" * 49) for k in range(3)] + [(10, "y" * 50), (11, "y" * 51), (12, "y" * 49), (13, "ab" * 300), (14, "c" + "ab" * 300)]
    for k in range(100, 160):
        text = list(base)
        for _ in range(draw.randrange(14)):
            text[draw.randrange(len(text))] = draw.choice("xyz")
        a, b = sorted(draw.randrange(600) for _ in range(2))
        rows.append((k, "".join(text[a:b])))
        noise = "".join(draw.choice("mnopqrst ") for _ in range(200))
        rows.append((k + 100, noise[: draw.randrange(200)] + base[300 : 300 + draw.randrange(45, 120)] + noise))
    rows += [(300, ""), (301, base + base), (302, base), (302, base), (303, "short")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows] + [(304, None, 1)], "doc_id bigint, text string, row int")
    expected = _brute(rows + [(304, None)])
    assert _found(passages.without_repeats(df.repartition(5))) == expected
    assert _found(passages.without_repeats(df.repartition(3), passages.Settings(slice_bytes=700, gathered=50, contexts=40))) == expected


def test_no_rows_and_no_id(spark):
    schema = "doc_id bigint, text string"
    assert passages.without_repeats(spark.createDataFrame([], schema)).count() == 0
    rows = passages.without_repeats(spark.createDataFrame([(None, "z" * 80), (None, "z" * 80), (1, "z" * 80)], schema)).collect()
    assert [r.n_removed for r in rows] == [0, 0, 0]


def test_multikey_ranks():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 3, (500, 4)).astype(np.uint64)
    rank = passages.multikey_ranks(words)
    seen = {}
    for k, w in enumerate(map(tuple, words.tolist())):
        assert seen.setdefault(w, rank[k]) == rank[k]
    assert len(set(rank.tolist())) == len(seen)


def test_long_text_has_few_anchors():
    text = np.random.default_rng(0).integers(97, 123, 200_000).astype(np.uint8)
    a = passages.anchors_of(text, np.array([len(text)]))
    assert 10 < len(text) / len(a.at) < 16
    assert (a.last - a.first < SPAN - passages.LEAD + 1).all() and a.first[0] == 0 and a.last[-1] == len(text) - SPAN
