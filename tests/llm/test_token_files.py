import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeworks.llm import queries, token_files
from gaugeworks.llm.common import table
from gaugeworks.session import scratch_path
from tests.llm.helpers import odd_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
@pytest.mark.parametrize("high", [1, 2, 10, 50_000, 2**32, 2**63])
def test_round_trip(n, high):
    rng = np.random.default_rng(n)
    values = np.repeat(rng.integers(0, high, n), rng.integers(1, 30, n))[:n].astype(np.uint64)
    words, blocks, escapes = token_files.pack(values)
    assert (token_files.unpack(words, blocks, escapes, n) == values).all()
    assert len(words) <= n


def test_mixed_values_round_trip():
    rng = np.random.default_rng(1)
    values = rng.choice(np.array([0, 1, 3, 200, 40_000, 2**40, 2**62, 2**64 - 1], np.uint64), 20_000)
    assert (token_files.unpack(*token_files.pack(values), len(values)) == values).all()


def test_small_ids_share_words():
    words, _, _ = token_files.pack(np.arange(512) % 8)
    assert len(words) <= 512 // 20 + 1
    assert len(token_files.pack(np.full(512, 7))[0]) == 1


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_odd_rows_and_order(spark):
    docs = odd_documents(spark).repartition(4)
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, PATH, 1)
    got = [tuple(r) for r in token_files.read_tokens(spark, path).orderBy("start").collect()]
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == expected(rows)


def test_query_over_the_table(spark, sf_small):
    got = [tuple(r) for r in queries.op1_token_files(spark, sf_small).orderBy("doc_id").collect()]
    rows = sorted((r.doc_id, r.text) for r in table(spark, sf_small, "documents").select("doc_id", "text").collect())
    assert got == expected(rows)


def test_no_documents(spark):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(odd_documents(spark).limit(0), path, PATH, 1)
    assert token_files.read_tokens(spark, path).count() == 0


def test_large_ids_beside_rows_without_one(spark):
    docs = spark.createDataFrame([(2**53 + 1, "one"), (None, "two words"), (5, None)], "doc_id long, text string").coalesce(1)
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, PATH, 1)
    assert [r.doc_id for r in token_files.read_tokens(spark, path).orderBy("start").collect()] == [None, 5, 2**53 + 1]


def test_other_tokenizers_encode_whole_texts(spark, sf_small):
    path, other = scratch_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json")
    docs = odd_documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    token_files.write_tokens(docs, path, other, 1)
    tokenizer = Tokenizer.from_file(other)
    want = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_files.read_tokens(spark, path).collect()} == want


def test_chunks_of_whole_documents(spark, monkeypatch):
    """Documents around a chunk's size, in several slices."""
    rows = [(i, f"word{i % 7}, and more! " * (i % 90)) for i in range(400)]
    monkeypatch.setattr(token_files, "CHUNK_IDS", 150)
    monkeypatch.setattr(token_files, "SLICE_BYTES", 3000)
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH, 1)
    assert [tuple(r) for r in token_files.read_tokens(spark, path).orderBy("start").collect()] == expected(rows)
