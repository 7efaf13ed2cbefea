import hashlib
import re

import corpus_pipeline
from gaugeworks.llm import byte_bpe
from gaugeworks.llm.common import written
from tests.llm.helpers import odd_documents
from tests.llm.test_byte_bpe import PATH, expected
from tests.llm.test_decontaminate import plain as plain_matches
from tests.llm.test_near_join import plain as plain_groups


def test_each_stage_against_a_plain_version(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    known = written(stages["language"](spark, docs, sf_small), "t")
    assert known.columns == columns
    lost = {r.doc_id for r in docs.join(known, "doc_id", "left_anti").collect()}
    assert len(lost) < 0.01 * docs.count()
    one = written(stages["near_duplicates"](spark, known, sf_small), "t")
    rows = [(r.doc_id, r.text) for r in known.collect()]
    assert one.columns == columns
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, c, _ in plain_groups(rows)})
    clean = written(stages["decontamination"](spark, one, sf_small), "t")
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in one.collect()]
    hits = plain_matches((t for _, t in rows), items, 10)
    assert clean.columns == columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for (i, _), (_, hit, _) in zip(rows, hits, strict=True) if not hit)
    masked = written(stages["personal_data"](spark, clean, sf_small), "t")
    before = {r.doc_id: r.text for r in clean.collect()}
    assert masked.schema == clean.schema and masked.count() == len(before)
    for r in masked.collect():
        assert "@mail" not in r.text and r.n_chars == len(r.text)
        assert r.text == before[r.doc_id] or re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r.text)
    last = stages["byte_bpe"](spark, masked, sf_small).collect()
    want = {x[0]: x[1:] for x in expected([(r.doc_id, r.text) for r in masked.collect()])}
    decode = byte_bpe.decode_ids(PATH, byte_bpe_pattern())
    for r in last:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id]
        assert hashlib.sha256(decode(r.ids)).hexdigest() == r.decoded_sha256


def byte_bpe_pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


def test_odd_and_no_documents(spark, sf_small):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, written(docs, "t"), sf_small)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() >= 0
