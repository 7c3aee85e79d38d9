"""Near duplicates against all pairs of shingle sets."""

import random
import re

import pytest

from starloom.llm import minhash
from starloom.llm.graph import components
from starloom.llm.queries import QUERIES


def _shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def _brute(rows):
    """Component and set size by row index; links between texts, named by the smallest doc_id."""
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < i}:
            if 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows))


def _found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert _found(QUERIES["op7_minhash"](spark, small)) == _brute(rows)


def test_chains_groups_and_edges(spark):
    draw = random.Random(5)
    base = [f"w{draw.randrange(10_000)}" for _ in range(200)]
    rows = [(900 - k, " ".join(base[: 200 - k])) for k in range(60)]  # a chain whose ends aren't alike
    for k in range(80):  # a group of near copies, and texts that share a passage only
        copy = list(base)
        for _ in range(5):
            copy[draw.randrange(200)] = f"x{draw.randrange(10_000)}"
        rows.append((1000 + k, " ".join(copy)))
        rows.append((2000 + k, " ".join([f"y{draw.randrange(10**6)}" for _ in range(120)] + base[:80])))
    rows += [(3000, ""), (3001, " \n "), (3002, "Only Three words"), (3003, "only three WORDS"), (3004, "only three words more than"), (3005, "İ é ß"), (3005, "İ é ß")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows] + [(3006, None, 1)], "doc_id bigint, text string, bands int")
    assert _found(minhash.near_duplicates(df)) == sorted(_brute(rows) + [(3006, 0, 3006, True)])
    kept = minhash.distinct_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _, c, k in _brute(rows) if k} | {3006})


def test_no_rows_and_no_id(spark):
    schema = "doc_id bigint, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    (row,) = minhash.near_duplicates(spark.createDataFrame([(None, "a b c d e f")], schema)).collect()
    assert (row.n_shingles, row.component_id, row.kept) == (2, None, True)


def test_large_group_between_the_limits(spark):
    """Near copies of one text whose pairs lie on both sides of the limit, many of them linked with no other."""
    draw = random.Random(8)
    base, rows = [f"w{k}" for k in range(150)], []
    for k in range(400):
        copy = list(base)
        for _ in range(draw.choice((1, 2, 3, 4, 5, 6))):
            copy[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    draw.shuffle(rows)
    expected = _brute(rows)
    assert sum(k for *_, k in expected) > 40 and sum(c == 0 for _, _, c, _ in expected) > 40
    assert _found(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))) == expected


def test_long_signatures(spark):
    """Equal bits of long signatures follow the similarity; ids with unlike texts have none."""
    words = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:350])), (3, " ".join(words)), (4, "x y z"), (4, "quite another"), (5, "short")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    s = minhash.Settings()
    found = {r.id: r.fine for r in minhash.fine_signatures(docs.select(docs.doc_id.alias("id")).distinct(), docs, s).collect()}
    assert found[4] is None and found[1] == found[3] and len(found[5]) == s.fine // 32
    unlike = sum(bin(((a ^ b) | ((a ^ b) >> 1)) & 0x5555555555555555).count("1") for a, b in zip(*([x & (2**64 - 1) for x in found[k]] for k in (1, 2)), strict=True))
    similarity = 346 / 396
    assert abs((s.fine - unlike) / s.fine - (1 + 3 * similarity) / 4) < 0.03


def test_rows_without_id_in_the_pipeline_stage(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(7, text, "a"), (9, text + " more", "b"), (None, text, "c"), (None, "quite another text of seven words here", "d"), (None, "quite another text of seven words here", "d"), (None, None, "e"), (None, "", "f"), (8, "", "g")]
    kept = minhash.distinct_documents(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    assert sorted((str(r.doc_id), r.source) for r in kept.collect()) == [("7", "a"), ("8", "g"), ("None", "d"), ("None", "e"), ("None", "f")]


@pytest.mark.parametrize("edges, roots", [([], {}), ([(1, 1)], {}), ([(5, 4), (4, 3), (9, 8), (3, 7), (4, 5)], {3: 3, 4: 3, 5: 3, 7: 3, 8: 8, 9: 8})])
def test_components(spark, edges, roots):
    assert {r.id: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()} == roots


def test_long_chain(spark):
    edges = spark.range(1, 300).selectExpr("id AS u", "id - 1 AS v")
    assert {r.root for r in components(edges).collect()} == {0}
