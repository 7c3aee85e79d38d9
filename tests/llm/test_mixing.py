"""The mix against a plain computation, and its limits."""

import hashlib
import re

import pytest

from starloom.llm import mixing
from starloom.llm.queries import QUERIES


def _targets(sizes):
    """Excess shared again by weight until none is above, as it is stated."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left, live = dict.fromkeys(names, 0.0), float(sum(sizes.values())), list(names)
    while live and left > 1e-9:
        total = sum(weight[s] for s in live)
        for s in live:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in live:
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
        live = [s for s in live if target[s] < 3 * sizes[s]]
    return target


def _number(doc_id):
    digest = hashlib.md5(f"{'' if doc_id is None else doc_id}:17".encode()).hexdigest()
    return (int(digest[:13], 16) + 0.5) / (1 << 52)


def mixed(rows):
    """Copies of each document of (doc_id, source, text), with distinct doc_ids."""
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, _, t in rows}
    sources = {}
    for d, s, _ in rows:
        sources.setdefault(s, []).append(d)
    target = _targets({s: sum(size[d] for d in ds) for s, ds in sources.items()})
    taken = {}
    for s, ds in sources.items():
        total = sum(size[d] for d in ds)
        share = target[s] / total if total else 0
        whole = int(share + 1e-12)
        rest, before = target[s] - whole * total, 0
        for d in sorted(ds, key=_number):
            more = 2 * before + size[d] <= 2 * rest + 1e-6 and share - whole > 1e-12
            before += size[d]
            taken[d] = (whole + more) if size[d] else 0
    return taken


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    taken, sizes = mixed([(r.doc_id, r.source, r.text) for r in docs]), {}
    rows = QUERIES["op4_mixing"](spark, small).collect()
    assert {r.doc_id: r.taken for r in rows} == {r.doc_id: taken[r.doc_id] * r.size for r in rows} and len(rows) == len(docs)
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + next(x.size for x in rows if x.doc_id == r.doc_id)
    target = _targets(sizes)
    assert all(abs(r.target - target[s.source]) < 1e-6 * (1 + r.target) for r, s in zip(sorted(rows, key=lambda r: r.doc_id), sorted(docs, key=lambda r: r.doc_id), strict=True))


def test_nulls_hot_source_and_repeats(spark):
    rows = [(k, "hot", "w " * (k % 90 + 1)) for k in range(3000)] + [(k + 5000, f"s{k % 5}", "w " * (k % 40)) for k in range(400)]
    rows += [(9000, None, "a b c"), (9001, None, None), (9002, "empty", ""), (9003, "empty", None), (9004, "é", "long " * 20_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, source string, text string, share int, rest int")
    found = mixing.mix(df).collect()
    taken = mixed(rows)
    assert {r.doc_id: r.taken for r in found} == {r.doc_id: taken[r.doc_id] * r.size for r in found}
    assert all(r.taken <= 3 * r.size for r in found)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(found) == sorted(again)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.count() == sum(taken.values())
    twice = mixing.mix(df.union(df)).collect()
    assert len(twice) == 2 * len(rows) and all(r.taken <= 3 * r.size for r in twice)


@pytest.mark.parametrize("rows", [[], [(1, "a", None)], [(None, None, None)], [(None, "a", "x y"), (None, "a", "x y"), (1, "b", "z")]])
def test_edges(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    assert mixing.mix(df).count() == len(rows)
