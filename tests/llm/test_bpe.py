"""Ids against the tiktoken library, decoding against the text."""

import base64
import hashlib

import public_tokenizers
import tiktoken

from starloom.llm import bpe
from starloom.llm.common import BATCH_ROWS
from starloom.llm.queries import QUERIES, token_digests

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "\n\n  x", "The quick brown fox", "naïve façade — 日本語 🙂🙂", "don't  stop\tnow   end ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "<|endoftext|> 12345 67.89", "ab" * 4000, "the" * 3000 + "Thequickbrown" * 300, "\x00\x01\x7f", "ÀÉÎ" * 50,
]


def _library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _expected(text):
    ids = _library().encode_ordinary(text or "")
    return len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_ids_and_round_trip(spark):
    rows = [(k, t, "x") for k, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x"), (None, "no key", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in token_digests(docs).collect()), key=str)
    assert found == sorted(((k, *_expected(t)) for k, t, _ in rows), key=str)


def test_empty_table(spark):
    assert token_digests(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_whole_table(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    library = _library()
    for r in QUERIES["op9_byte_bpe"](spark, small).collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_clashing_columns_and_long_words():
    ranks = bpe.read_ranks(PATH)
    library = _library()
    for word in (b"abc" * 500, b"x" * 23, b"x" * 99, b"x" * 100, b"ab" * 49, b"the" * 33 + b"a", bytes(range(33, 127)) * 3, bytes(range(128, 256)), bytes(range(128, 200))):
        assert bpe.merge_word(word, ranks) == library._encode_single_piece(word)


def test_decoding_of_nulls_and_empty_rows(spark):
    ranks = bpe.read_ranks(PATH)
    ids = bpe.encode(spark.createDataFrame([(1, "one two"), (2, ""), (3, None)], "doc_id int, text string"), ranks, public_tokenizers.PATTERN)
    rows = ids.union(spark.createDataFrame([(4, None)], ids.schema))
    assert {r.doc_id: r.decoded and bytes(r.decoded) for r in bpe.decode(rows, ranks).collect()} == {1: b"one two", 2: b"", 3: b"", 4: None}
    only_empty = rows.where("doc_id IN (2, 3)").coalesce(1)
    assert [bytes(r.decoded) for r in bpe.decode(only_empty, ranks).collect()] == [b"", b""]


def test_batches_and_kept_words_are_bounded(spark, monkeypatch):
    """Batches of 10,000 whole texts, in two Python steps a task, took an executor beyond its memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    ranks, before = bpe.read_ranks(PATH), spark.conf.get(name)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 2)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS * 3)], "doc_id bigint, text string").coalesce(1)
    try:
        spark.conf.set(name, 10_000)
        rows = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
        assert int(spark.conf.get(name)) == BATCH_ROWS
        spark.conf.set(name, 7)
        bpe.encode(docs, ranks, public_tokenizers.PATTERN)
        assert int(spark.conf.get(name)) == 7
    finally:
        spark.conf.set(name, before)
    library = _library()
    for r in rows:
        text = TEXTS[r.doc_id % len(TEXTS)] or ""
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text))
        assert bytes(r.decoded) == text.encode()
