import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken

from gaugeworks.llm import byte_bpe, queries
from gaugeworks.llm.common import Words, table
from tests.llm.helpers import odd_documents

PATH = P.path("byte_bpe_50k.tiktoken")


def expected(rows):
    tool = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})
    for doc_id, text in rows:
        ids = tool.encode_ordinary(text or "")
        yield doc_id, len(ids), *(hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode()))


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, str(r[1:])))


def test_odd_rows(spark):
    docs = odd_documents(spark, ["a  b   c \n\n d\t\te ", " lead", "trail ", "it's we'll I'M", "x" * 3000, "b　c", " a b"])
    got = byte_bpe.encode_documents(docs, PATH, P.PATTERN, ("doc_id",))
    assert order(tuple(r) for r in got.collect()) == order(expected((r.doc_id, r.text) for r in docs.collect()))


def test_ids_decode(spark):
    docs = odd_documents(spark)
    back = byte_bpe.decode_ids(PATH, P.PATTERN)
    for row in byte_bpe.encode_documents(docs, PATH, P.PATTERN, ("text",), with_ids=True).collect():
        assert back(row.ids) == (row.text or "").encode()


def test_query_over_the_table(spark, sf_small):
    rows = table(spark, sf_small, "documents").select("doc_id", "text").collect()
    assert order(tuple(r) for r in queries.op10_byte_bpe(spark, sf_small).collect()) == order(expected(map(tuple, rows)))


def test_no_documents(spark):
    assert byte_bpe.encode_documents(odd_documents(spark).limit(0), PATH, P.PATTERN).count() == 0


def test_long_documents_and_a_small_memory(spark, monkeypatch):
    """Ids beyond what is hashed at once, and words forgotten between slices."""
    monkeypatch.setattr(byte_bpe, "DIGEST_IDS", 64)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 100)
    tool = byte_bpe.Codec(PATH, P.PATTERN)
    texts = ["short one", "", "a long text, with 12 numbers and more " * 40, "  odd  spaces\n", "x", "words again " * 30]
    for _ in range(2):
        ids, counts = tool.encode(texts)
        got = list(zip(range(6), counts.tolist(), tool.decimals.digests(ids, counts, 1), tool.pieces.digests(ids, counts, 0), strict=True))
        assert got == list(expected(enumerate(texts)))


def test_words_used_again_outlive_the_bound(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 60_000)
    tool = byte_bpe.Codec(PATH, P.PATTERN)
    texts = [f"often again word{i} rare{i * 7}x other{i}" for i in range(600)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = []
    for i in range(0, len(texts), 50):
        ids, counts = tool.encode(texts[i : i + 50])
        got += [len(x) for x in np.split(ids, counts.cumsum()[:-1])]
        assert tool.words.held() < 120_000
    assert got == [n for _, n, *_ in expected(rows)]
    assert " again" in tool.words.number
    few = Words()
    few.add(["a", "b", "c", "d"], np.arange(8, dtype=np.uint32), np.full(4, 2))
    for _ in range(3):
        few.ids(np.array([1, 3]))
    kept = few.within(few.held() - 1)
    assert list(kept.number) == ["b", "d"] and kept.ids(np.array([1, 0]))[0].tolist() == [6, 7, 2, 3]
