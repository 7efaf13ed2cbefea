import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import line_dedup, queries
from tests.llm.helpers import odd_documents

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10):
    """(doc_id, n_lines, n_dropped, kept text) of (doc_id, text) rows; rows without an id come last, as one document."""
    order = lambda i: (i is None, i or 0)
    key = lambda line: line.strip(" \t\n\v\f\r").translate(CAPITALS)
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held[key(x)]) < 2 or min(held[key(x)], key=order) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def digests(docs):
    cut = line_dedup.cut_texts(docs, line_dedup.keep_bitmaps(docs), ["doc_id"], "n_lines long, n_dropped long, kept string", lambda t, n, lost: [n, lost, t])
    return sorted(map(tuple, cut.collect()), key=repr)


def test_whole_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in queries.op13_line_dedup(spark, sf_small).collect()}
    assert got == {(i, n, lost, hashlib.sha256(t.encode()).hexdigest()) for i, n, lost, t in plain(rows)}
    assert sum(lost for _, _, lost, _ in plain(rows)) > 0


def test_odd_rows(spark):
    line = "A line that several documents hold"
    more = [f"  {line}\t\n{line.lower()}\nshort", line + "\n\n" + "9" * 9, "Äb" * 5 + "\nx", "äb" * 5, "AB" * 4 + "é" + "\n" + "ab" * 4 + "Éx", "\n" * 50_000, line]
    docs = odd_documents(spark, more).withColumn("fp", F.lit("x")).withColumn("n_lines", F.lit(1)).withColumn("pos", F.lit(0))
    docs = docs.unionByName(docs.limit(0)).unionByName(docs.where("doc_id is null").withColumn("text", F.lit(line)))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert digests(docs) == sorted(plain(rows), key=repr)
    cut = line_dedup.without_repeated_lines(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert digests(docs.limit(0)) == [] and line_dedup.keep_bitmaps(docs.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_a_key_over_many_ranges(spark, partitions):
    """A third of all lines are one key; ranges cut it in several places."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.shuffle.partitions": partitions, "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "37"}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = [(900 - i, f"the very common line\nown line of document {i}\nThe Very common line \nshared by a few {i % 50}") for i in range(900)]
        rows += [(i, "the very common line") for i in (1, 1, 1)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert digests(docs) == sorted(plain(rows), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bitmaps_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 130, 40_000):
        for share in (0.0, 0.01, 0.5, 1.0):
            dropped = np.flatnonzero(rng.random(n) < share)
            keep = np.ones(n, bool)
            keep[dropped] = False
            assert (line_dedup.from_runs(line_dedup.to_runs(dropped), n) == keep).all()
    assert len(line_dedup.to_runs(np.arange(100, 30_000))) == 4
