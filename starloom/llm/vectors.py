"""Near-duplicate vectors: a navigable small-world graph for each shard, every shard asked, cosine verified.

Equal vectors form a class first. Shards hold a bounded number of classes, so their number follows the data; each shard's
graph is built once, and each pair of shards meets in one task of bounded size, where each side searches the other. A query's beam is widened until
its worst entry is no link. The beam it starts with is the least with which a sample of the block finds the nearest
nodes of the whole shard, links or not, with the recall asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import hnsw
from starloom.llm.graph import components
from starloom.session import materialize

#: Nodes compared one after the other in the time of one place of a beam, about: 32 links, each gathered singly.
BEAM_NODES = 256


@dataclass(frozen=True)
class Settings:
    least: float = 0.95
    shard: int = 32_768  # classes in a shard at most, about
    block: int = 16_384  # queries searched and audited at once
    beam: int = 32
    audited: int = 48  # queries of a block compared with the whole shard
    nearest: int = 10  # nodes of the shard that each of these has to find
    recall: float = 0.99


def _units(packed: pd.Series) -> np.ndarray:
    """Unit vectors in double precision from their packed bytes."""
    x = np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _exact(shard: np.ndarray, queries: np.ndarray, part: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs of some queries, from all cosines."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(part), 256):
        q, n = np.nonzero(queries[part[at : at + 256]] @ shard.T >= least)
        left.append(part[at + q])
        right.append(n)
    return np.concatenate(left), np.concatenate(right)


def _found(graph: hnsw.Graph, shard: np.ndarray, queries: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs with cosine >= least; the beam of a query widens while its worst entry may be a link.

    A beam that takes longer than all cosines gives way to them; they also reach what no path leads to.
    """
    rough = queries.astype(np.float32)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    waiting = np.arange(len(queries))
    while len(waiting) and BEAM_NODES * beam < len(shard):
        wider = []
        for at in range(0, len(waiting), max(16, (1 << 14) // beam)):
            part = waiting[at : at + max(16, (1 << 14) // beam)]
            ids, sims = graph.search(rough[part], beam)
            full = sims[:, -1] >= least - 0.01
            wider.append(part[full])
            row, place = np.nonzero((sims >= least - 1e-3) & ~full[:, None])
            q, n = part[row], ids[row, place]
            for cut in range(0, len(q), 1 << 16):
                a, b = q[cut : cut + (1 << 16)], n[cut : cut + (1 << 16)]
                exact = np.einsum("kd,kd->k", queries[a], shard[b]) >= least
                left.append(a[exact])
                right.append(b[exact].astype(np.int64))
        waiting, beam = np.concatenate(wider), beam * 4
    more = _exact(shard, queries, waiting, least)
    return np.concatenate([*left, more[0]]), np.concatenate([*right, more[1]])


def _nearest_found(graph: hnsw.Graph, shard: np.ndarray, queries: np.ndarray, s: Settings) -> Iterator[tuple[int, float]]:
    """Beams, each twice the last, and the share of the `nearest` nodes of each query that a search with it meets.

    A query's own node is no neighbour, neither sought nor counted; of nodes equally near any will do.
    """
    sims = queries @ shard.T
    row, node = np.nonzero(sims >= 1 - 1e-9)
    same = (queries[row] == shard[node]).all(1)
    own = [set(node[same & (row == k)].tolist()) for k in range(len(queries))]
    sims[row[same], node[same]] = -2
    width = min(s.nearest, len(shard))
    bound = -np.partition(-sims, width - 1, axis=1)[:, width - 1]
    bound[bound < -1.5] = -1.5  # fewer nodes than sought
    true = np.minimum(width, (sims >= bound[:, None]).sum(1))
    beam = s.beam
    while BEAM_NODES * beam < len(shard):
        ids, _ = graph.search(queries.astype(np.float32), beam)
        met = [sum(sims[k, n] >= bound[k] - 1e-6 for n in set(ids[k].tolist()) - own[k] - {hnsw.NONE}) for k in range(len(queries))]
        yield beam, np.minimum(met, true).sum() / max(1, true.sum())
        beam *= 2
    yield beam, 1.0


def audited_links(graph: hnsw.Graph, shard: np.ndarray, queries: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Links of all queries, with the beam widened until a sample of queries finds its nearest nodes with the recall
    asked for. These exist in every shard, so that the sample needs no links to judge the search."""
    sample = np.unique(np.linspace(0, len(queries) - 1, min(len(queries), s.audited)).astype(int))
    beam = next(beam for beam, recall in _nearest_found(graph, shard, queries[sample], s) if recall >= s.recall)
    return _found(graph, shard, queries, beam, s.least)


def _roots(pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> dict[int, int]:
    """The smallest number of the local component of each linked number."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for left, right in pairs:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@dataclass
class Shard:
    ids: np.ndarray
    sizes: np.ndarray  # rows of each class
    x: np.ndarray
    graph: hnsw.Graph


def pair_links(a: Shard, b: Shard | None, s: Settings) -> tuple[list[np.ndarray], dict[int, int]]:
    """Rows linked with each class of a (and of b) across the two shards, or inside a alone, and local roots.

    Each side's vectors search the other side's graph; a link that only one of the searches finds counts at both ends.
    Links are held as bits, so that memory does not depend on their number.
    """
    other = a if b is None else b
    bits = np.zeros((len(a.x), -(-len(other.x) // 8)), np.uint8)
    for queries, shard in ((a, other), (b, a))[: 1 if b is None else 2]:
        for at in range(0, len(queries.x), s.block):
            left, right = audited_links(shard.graph, shard.x, queries.x[at : at + s.block], s)
            left = left + at
            ends = [(left, right)] if queries is a else [(right, left)]
            for row, column in ends + [(right, left)] * (b is None):
                np.bitwise_or.at(bits, (row, column >> 3), (128 >> (column & 7)).astype(np.uint8))
    counts = [np.zeros(len(side.x)) for side in ((a,) if b is None else (a, b))]

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(bits), 64):
            row, column = np.nonzero(np.unpackbits(bits[at : at + 64], axis=1, count=len(other.x)))
            row = row + at
            apart = a.ids[row] != other.ids[column]
            row, column = row[apart], column[apart]
            counts[0] += np.bincount(row, weights=other.sizes[column], minlength=len(a.x))
            if b is not None:
                counts[1] += np.bincount(column, weights=a.sizes[row], minlength=len(b.x))
            yield a.ids[row], other.ids[column]

    root = _roots(pairs())
    return [c.astype(np.int64) for c in counts], root


def near_vectors(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of rows (vec_id, embedding); repeated rows stay.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and vectors of
    different lengths don't link with each other. Rows without a vec_id take no part: n_links 0, component_id null,
    kept true. A row with an equal vector is a link like any other. Other columns are left out.
    """
    value = F.transform(rows["embedding"], lambda x: x.cast("double"))
    sound = ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(value, lambda x: x != 0)
    own = rows.select(rows["vec_id"].cast("bigint").alias("vec_id"), F.when(F.coalesce(sound, F.lit(False)) & rows["vec_id"].isNotNull(), value).alias("v"))
    classes = materialize(own.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")))
    counts = {r["d"]: r["k"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("k")).collect()}
    if not counts:
        return own.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    def parts(most: int):
        """Number of parts for the classes of each length."""
        pairs = [F.lit(x) for d, k in sorted(counts.items()) for x in (d, -(-k // most))]
        return F.element_at(F.create_map(*pairs), F.size("v"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "n": b["n"], "d": b["d"], "shard": b["shard"], "shards": b["shards"], "x": [np.asarray(v, np.float64).tobytes() for v in b["v"]]})

    placed = classes.select("id", "n", "v", F.size("v").alias("d"), parts(s.shard).cast("int").alias("shards"))
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("v", F.lit("shard")), F.col("shards")).cast("int"))
    packed = materialize(placed.mapInPandas(pack, "id bigint, n bigint, d int, shard int, shards int, x binary"))

    def index(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["id", "n"], ignore_index=True)
        graph = hnsw.build(_units(own["x"]).astype(np.float32))
        layers = b"".join(np.array([len(nodes), links.shape[1]], np.int32).tobytes() + nodes.tobytes() + links.tobytes() for nodes, links in graph.layers)
        columns = {"d": [key[0]], "shard": [key[1]], "shards": [own["shards"][0]], "ids": [own["id"].to_numpy(np.int64).tobytes()], "sizes": [own["n"].to_numpy(np.int64).tobytes()]}
        return pd.DataFrame(columns | {"x": [b"".join(own["x"])], "layers": [layers]})

    graphs = materialize(packed.groupBy("d", "shard").applyInPandas(index, "d int, shard int, shards int, ids binary, sizes binary, x binary, layers binary"))
    # Each pair of shards meets in one task, a shard with itself too.
    partner = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    met = graphs.select("*", partner.alias("partner")).select("d", F.least("shard", "partner").alias("a"), F.greatest("shard", "partner").alias("b"), "shard", "ids", "sizes", "x", "layers")

    def unpack(row: pd.Series, d: int) -> Shard:
        x, flat, layers, at = row["x"], np.frombuffer(row["layers"], np.int32), [], 0
        x = _units(pd.Series([x[k : k + 8 * d] for k in range(0, len(x), 8 * d)]))
        while at < len(flat):
            n, width = flat[at : at + 2].tolist()
            layers.append((flat[at + 2 : at + 2 + n], flat[at + 2 + n : at + 2 + n + n * width].reshape(n, width)))
            at += 2 + n + n * width
        return Shard(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64), x, hnsw.Graph(x.astype(np.float32), layers))

    def ask(key: tuple, sides: pd.DataFrame) -> pd.DataFrame:
        shards = [unpack(row, key[0]) for _, row in sides.sort_values("shard").iterrows()]
        # A hash may leave a shard without classes; its partner then comes alone and has nothing to ask.
        if key[1] != key[2] and len(shards) < 2:
            return pd.DataFrame({"id": [], "links": [], "root": []})
        counts, root = pair_links(shards[0], shards[1] if len(shards) > 1 else None, s)
        own = np.concatenate([side.ids for side in shards])
        more = [i for i in root if root[i] != i]
        return pd.DataFrame({"id": np.concatenate([own, np.array(more, np.int64)]), "links": np.concatenate([*counts, np.zeros(len(more), np.int64)]), "root": np.concatenate([own, np.array([root[i] for i in more], np.int64)])})

    answers = materialize(met.groupBy("d", "a", "b").applyInPandas(ask, "id bigint, links bigint, root bigint"))
    joined = components(answers.where("id != root").select(F.col("id").alias("u"), F.col("root").alias("v")))
    linked = answers.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.select(F.col("v").alias("w"), "id", "n").join(linked, "id", "left").join(joined, "id", "left").select("w", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "id").alias("root"))
    out = own.join(named, F.col("v") == F.col("w"), "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
