"""Base spans against plain patterns, the network against held-out labels, and redaction."""

import hashlib
import random
import re

import pytest

from starloom.llm import personal
from starloom.llm.queries import QUERIES


def _plain(text):
    """The patterns as they are stated."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], personal.KINDS.index(s[0])))


CASES = [
    "", "a@b.c@d.e", "@x.y", "x@y", "x@y.z.", "a..b%+-@-.-.-", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256 01.002.3.0255", "4465758382889437 4465758382889437", "4465-7583 8288-9437",
    "+1 (743) 555-3824", "+12 3", "+1.......2345678", "++1 234 567 89 0", "é@b.co ü1.2.3.4ü", "1" * 300, "a" * 300 + "@" + "b." * 20 + "c", "x@y-.z_@q.r",
]


@pytest.mark.parametrize("text", CASES)
def test_base_cases(text):
    assert personal.base_spans(text) == _plain(text)


def test_base_random():
    draw = random.Random(1)
    for _ in range(3000):
        text = "".join(draw.choice("ab1234567890..@@+- ()é") for _ in range(draw.randrange(60)))
        assert personal.base_spans(text) == _plain(text)


@pytest.fixture(scope="module")
def weights(spark, small):
    return personal.fitted(spark.read.parquet(f"{small}/../sf0.1/documents.parquet"))


def test_whole_table(spark, small):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op6_personal_data"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = _plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in personal.KINDS] == [sum(s[0] == k for s in base) for k in personal.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_network_finds_held_out_spans(spark, small, weights):
    hit = total = extra = 0
    for text in [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]:
        for a, b in personal.stretches(text):
            base = set(personal.base_spans(text[a:b]))
            found = set(personal._label_spans(personal.label_stretches([text[a:b]], weights)[0], text[a:b], 0))
            hit, total, extra = hit + len(base & found), total + len(base), extra + len(found - base)
    assert total >= 10 and hit >= 0.8 * total and extra <= 0.1 * total


def test_windows_meet(weights):
    """A stretch of many windows gets one label for each character."""
    text = "word +1 (743) 555-3824 word " * 40
    spans = personal.all_spans([text], weights)[0]
    assert [s[:3] for s in spans if s[3]] == _plain(text)
    assert len(personal.label_stretches([text], weights)[0]) == len(text)


def test_rows_and_redaction(spark, weights):
    rows = [(1, None, 0, "x"), (2, "", 0, "x"), (3, "call +1 (743) 555-3824 or a@b.co", 99, "x"), (3, "call +1 (743) 555-3824 or a@b.co", 99, "x"), (None, "no data", 7, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, clean string")
    out = sorted(personal.redacted_documents(df, weights).collect(), key=str)
    assert [r.text for r in out if r.doc_id == 3] == ["call <PHONE> or <EMAIL>"] * 2
    assert {r.n_chars for r in out if r.doc_id == 3} == {23} and len(out) == 5
    assert personal.redacted_documents(df, weights).columns == df.columns
    assert personal.redacted_documents(df.limit(0), weights).count() == 0


def test_without_training():
    weights = personal.train([])
    assert personal.all_spans(["x 12345 y", "a@b.co"], weights) == [[], [("email", 0, 6, True)]]
