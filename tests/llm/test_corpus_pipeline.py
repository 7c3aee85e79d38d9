"""The pipeline against its stages redone plainly, on the smallest tables."""

import hashlib
from collections import Counter

import corpus_pipeline
from test_minhash import _brute
from test_mixing import mixed
from test_quality import kept

from starloom.llm import personal
from starloom.llm.queries import quality_rules


def test_run(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rules = quality_rules(spark, small, docs)
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect() if kept(r.text, rules)]
    near = {d for d, _, _, k in _brute([(d, t) for d, _, t in rows]) if k}
    assert near < {d for d, _, _ in rows} < {r.doc_id for r in docs.collect()}
    rows = [r for r in rows if r[0] in near]
    weights = personal.fitted(docs.where(docs.doc_id.isin([d for d, _, _ in rows])))
    rows = [(d, s, _redacted(t, spans)) for (d, s, t), spans in zip(rows, personal.all_spans([t for _, _, t in rows], weights), strict=True)]
    taken = mixed(rows)
    texts = {d: t for d, _, t in rows}
    expected = Counter({d: n for d, n in taken.items() if n})
    found = corpus_pipeline.run(spark, small).collect()
    assert Counter(r.doc_id for r in found) == expected
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in found)


def _redacted(text, spans):
    out, done = "", 0
    for kind, a, b, _ in spans:
        if a >= done:
            out += text[done:a] + f"<{kind.upper()}>"
        done = max(done, b)
    return out + text[done:]


def test_stages_keep_columns_and_take_no_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() == 0
