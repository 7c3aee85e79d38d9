"""Near vectors against all pairs."""

import sys

import numpy as np

from starloom.llm import hnsw, vectors
from starloom.llm.queries import QUERIES


def _brute(rows, least=0.95):
    ids = [i for i, _ in rows]
    sound = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    links = [[] for _ in rows]
    for length in {len(v) for (_, v), ok in zip(rows, sound, strict=True) if ok}:
        own = [k for k, ok in enumerate(sound) if ok and len(rows[k][1]) == length]
        x = np.array([rows[k][1] for k in own], np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= least), strict=True):
            if a != b:
                links[own[a]].append(own[b])
    least_of = {}
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, more in enumerate(links):
        for j in more:
            root[find(i)] = find(j)
    for i, d in enumerate(ids):
        least_of[find(i)] = min(d, least_of.get(find(i), d))
    return sorted((d, len(links[i]), least_of[find(i)], least_of[find(i)] == d) for i, d in enumerate(ids))


def _found(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def test_whole_table(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert _found(QUERIES["op10_embedding_near_dedup"](spark, small)) == _brute(rows)


def test_shards_blocks_and_edges(spark):
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((6, 12))
    rows = [(k, (centres[k % 6] + 0.16 * draw.standard_normal(12)).tolist()) for k in range(600)]
    rows += [(k, draw.standard_normal(12).tolist()) for k in range(600, 1400)]
    rows += [(2000 + k, [3.0] * 12) for k in range(50)] + [(2100, [1.0] * 12), (2101, [1e30] * 12), (2102, [1.0] * 5), (2103, [2.0] * 5)]
    bad = [(3000, None), (3001, []), (3002, [0.0] * 12), (3003, [float("nan")] * 12), (3004, [1.0] * 11 + [None]), (3005, [float("inf")] + [1.0] * 11)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows + bad], "vec_id bigint, embedding array<double>, id int")
    found = _found(vectors.near_vectors(df, vectors.Settings(shard=500, block=400)))
    brute = _brute(rows + bad)
    assert [f[0] for f in found] == [b[0] for b in brute]
    assert sum(f[1] for f in found) >= 0.98 * sum(b[1] for b in brute)
    assert all(f[1] <= b[1] for f, b in zip(found, brute, strict=True))
    assert [f[2:] for f in found] == [b[2:] for b in brute]


def test_empty_and_without_id(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = _found(vectors.near_vectors(spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], schema)))
    assert rows == [(1, 0, 1, True), (2, 0, 2, True)]
    (row,) = vectors.near_vectors(spark.createDataFrame([(None, [1.0, 0.0])], schema)).collect()
    assert (row.vec_id, row.n_links, row.component_id, row.kept) == (None, 0, None, True)


def test_recall_of_the_graph(spark, small):
    x = np.array([r.embedding for r in spark.read.parquet(f"{small}/../sf0.1/embeddings.parquet").collect()], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    left, _ = vectors.audited_links(hnsw.build(x.astype(np.float32)), x, x, vectors.Settings())
    assert len(left) >= 0.95 * int((x @ x.T >= 0.95).sum())


def test_audit_without_links_in_the_sample():
    """Real links, none of them with the query itself or in the audited sample, in a graph that hides many nodes."""
    draw = np.random.default_rng(5)
    shard = draw.standard_normal((12_000, 16))
    queries = shard[:3000] + 0.03 * draw.standard_normal((3000, 16))
    audited = np.unique(np.linspace(0, 2999, 48).astype(int))
    queries[audited] = draw.standard_normal((len(audited), 16))
    shard, queries = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (shard, queries))
    graph = hnsw.build(shard.astype(np.float32), degree=3, beam=4)
    truth = set(zip(*(x.tolist() for x in np.nonzero(queries @ shard.T >= 0.95)), strict=True))
    assert len(truth) > 2900 and not {q for q, _ in truth} & set(audited.tolist())
    assert len(vectors._found(graph, shard, queries, 32, 0.95)[0]) < 0.9 * len(truth)
    found = set(zip(*(x.tolist() for x in vectors.audited_links(graph, shard, queries, vectors.Settings())), strict=True))
    assert found <= truth and len(found) >= 0.98 * len(truth)


def test_links_found_one_way_count_at_both_ends(spark, monkeypatch):
    """A search that finds a link from one of its ends only, in one shard and across shards."""
    from pyspark import cloudpickle

    whole = vectors.audited_links

    def one_way(graph, shard, queries, s):
        left, right = whole(graph, shard, queries, s)
        seen = queries[left, 0] <= shard[right, 0]
        return left[seen], right[seen]

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    monkeypatch.setattr(vectors, "audited_links", one_way)
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((40, 12))
    rows = [(k, (centres[k % 40] + 0.1 * draw.standard_normal(12)).tolist()) for k in range(200)]
    rows += [(200 + k, rows[k][1]) for k in range(3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for size in (500, 60):
        assert _found(vectors.near_vectors(df, vectors.Settings(shard=size, block=50))) == _brute(rows)
    cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
