import hashlib
import re

import numpy as np

from gaugeworks.llm import pii, queries
from tests.llm.helpers import odd_documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip":
                good = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                twice = [d if i % 2 == 0 else sum(map(int, str(2 * d))) for i, d in enumerate(digits[::-1])]
                good = 14 <= len(digits) <= 19 and sum(twice) % 10 == 0
            else:
                good = kind == "email" or 10 <= len(digits) <= 15
            if good:
                out.append((m.start(), n, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def test_query_keeps_every_strict_span(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op4_pii(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in spans) for k in pii.KINDS]
        assert set(spans) <= set(r.spans.split(","))


def test_labelers_that_agree_outweigh_one_that_guesses():
    patterns = {(1, 1, 0): 400, (-1, -1, 0): 400, (1, 1, 1): 20, (1, 1, -1): 20, (-1, -1, 1): 20, (-1, -1, -1): 20, (1, -1, 1): 5}
    p = pii.estimate(patterns)
    assert p[(1, 1, -1)] > 0.9 and p[(-1, -1, 1)] < 0.1
    assert pii.estimate({}) == {}


def test_the_method_adds_spans_and_redacts(spark):
    rows = [(i, f"mail me at a{i}@x.example.com or call +1 (482) 555-71{i:02} today") for i in range(60)]
    rows += [(100 + i, f"card 4845 1681 1440 73{i:02} is here and nothing else 12345678901234") for i in range(30)]
    rows += [(200, "contact: jo (at) example dot com"), (201, None), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "length(text) as n_chars")
    masked = {r.doc_id: r for r in pii.redact(docs, sure=0.5).collect()}
    assert masked[0].text == "mail me at [EMAIL] or call [PHONE] today"
    assert masked[0].n_chars == len(masked[0].text)
    assert "[EMAIL]" in masked[200].text
    assert masked[201].text is None and masked[201].n_chars is None and masked[202].text == ""


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert pii.find_spans(docs).count() == docs.count()
    masked = pii.redact(docs)
    assert masked.columns == docs.columns and masked.schema == docs.schema
    by_id = {r.doc_id: r for r in masked.collect()}
    assert by_id[11].text.endswith("[PHONE] [EMAIL] [IP] 4845168114407329") and by_id[5].text == "a\x00b\x1cc\x85d\xa0e"
    assert pii.find_spans(docs.limit(0)).count() == 0
    assert np.isfinite(pii.fit({("ip", (1, 0, 0, 0, 1)): 1}).weights["ip"]).all()
    assert pii.strict_ok("ip", "0" * 5000 + "1.2.3.4") and not pii.strict_ok("ip", "9" * 5000 + ".2.3.4")


def test_long_runs_take_linear_time():
    import time

    for text in ("a" * 2_000_000 + " @", "1" * 2_000_000 + " @", "+1((" * 500_000, "1 " * 1_000_000, "(030) 12-34 " * 80_000, "a@" * 1_000_000, "x@" + "b" * 2_000_000, "a at " * 400_000):
        start = time.process_time()
        pii.candidates(text)
        assert time.process_time() - start < 5


def test_matches_inside_runs_and_behind_each_other():
    found = [(k, a, b) for k, a, b, good, _ in pii.candidates("a@b.c_d@e.f 1.2.3.4.5.6.7.8 1.2.3") if good]
    assert found == [("email", 0, 5), ("email", 5, 11), ("ip", 12, 19), ("ip", 20, 27)]
