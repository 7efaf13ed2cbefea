import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gaugeworks.llm import queries, ranked_search
from tests.llm.helpers import odd_documents, words


def plain(docs, items, top=50):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    counts = [(i, Counter(words(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for (i, c), size in zip(counts, sizes, strict=True):
            m = 50 + 50 * size * n // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(words(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def test_whole_table(spark, sf_small):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf_small}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = sorted(tuple(r) for r in queries.op11_ranked_search(spark, sf_small).collect())
    assert got == sorted(plain(docs, items))


def test_odd_rows_and_several_query_blocks(spark):
    docs = odd_documents(spark, ["one two three", "Two three", "three", "日本語 one"]).withColumn("rank", F.lit(1)).withColumn("terms", F.lit("x"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    asked = [(1, "ONE two"), (2, None), (3, ""), (None, "three 日本語"), (1, "ONE two"), (4, "nowhere"), (5, "x now here same " * 3), (6, "id without row")]
    items = spark.createDataFrame([(*a, "e") for a in asked], "item_id long, text string, doc_id string")
    for chars in (1, 10, 1 << 20):
        got = ranked_search.rank(docs, items, top=3, query_chars=chars)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows, asked, 3), key=repr)
    assert ranked_search.rank(docs.limit(0), items).collect() == [] == ranked_search.rank(docs, items.limit(0)).collect()


def test_blocks_are_skipped_by_their_bounds_only():
    """Small blocks, many ties: every document that reaches the floor is found, and some blocks are not looked at."""
    rng = np.random.default_rng(2)
    asked = ranked_search.Queries([" ".join(f"t{i}" for i in rng.integers(0, 60, 8)) for _ in range(30)])
    rows = []
    for _ in range(900):
        held = np.unique(np.minimum(rng.geometric(0.05, 12), len(asked.names)) - 1)
        rows += [(held, rng.integers(1, 1000, len(held)) * 1000)] * int(rng.integers(1, 3))
    ends = np.cumsum([len(t) for t, _ in rows])
    terms, impacts = (np.concatenate(x) for x in zip(*rows, strict=True))
    asked.weigh(Counter(terms.tolist()), len(rows))
    made = ranked_search.build_shard(asked, ends, terms, impacts)
    shard = ranked_search.Shard({**{k: v.tobytes() for k, v in made.items()}, "doc_ids": list(range(len(rows)))}, asked)
    dense = np.zeros((len(rows), len(asked.names)), np.int64)
    dense[np.repeat(np.arange(len(rows)), np.diff(ends, prepend=0)), terms] = impacts
    for q, held in enumerate(asked.terms):
        scores = dense[:, held] @ asked.weight[held]
        floor = max(1, int(np.sort(scores)[-10]))
        docs, found = shard.search(q, 10, 0)
        assert sorted(found.tolist(), reverse=True)[:10] == np.sort(scores[scores > 0])[::-1][:10].tolist()
        assert set(np.flatnonzero(scores >= floor)) <= set(docs.tolist()) and (scores[docs] == found).all()
        block, bound = shard.bounds(q)
        for d in np.flatnonzero(scores > 0):
            inside = [v for b, v in zip(block, bound, strict=True) if d in shard.postings[shard.block_ends[b - 1] if b else 0 : shard.block_ends[b]]]
            assert max(inside) >= scores[d]
    assert shard.skipped > shard.evaluated / 4
