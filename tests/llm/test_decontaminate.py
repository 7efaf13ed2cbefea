import hashlib
import random

from gaugeworks.llm import decontaminate, queries
from gaugeworks.llm.common import table, words_of
from tests.llm.helpers import odd_documents, words


def plain(docs, items, window):
    """doc -> words, hit words, items; by comparing every window with every place."""
    wins = []
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        if m:
            wins.append((item, m, {tuple(w[j : j + m]) for j in range(len(w) - m + 1)}))
    for text in docs:
        w = words(text)
        hit, seen = set(), set()
        for item, m, own in wins:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in own:
                    hit |= set(range(i, i + m))
                    seen.add(item)
        yield len(w), len(hit), sorted(seen)


def test_lookup_against_plain_search():
    rnd = random.Random(1)
    for _ in range(200):
        letters = "abcdef"[: rnd.choice([2, 3, 6])]
        make = lambda n: " ".join(rnd.choice(letters) for _ in range(n))
        items = [(str(i), make(rnd.choice([0, 1, 2, 3, 4, 6, 9]))) for i in range(rnd.randint(1, 4))]
        docs = [make(rnd.choice([0, 1, 3, 8, 20, 40])) for _ in range(5)] + [""]
        window = rnd.choice([3, 4, 5])
        got = decontaminate.Tests(items, window).lookup([words_of(d) for d in docs])
        for n, (_, hit, seen) in enumerate(plain(docs, items, window)):
            spans, matches = got.get(n, ([], []))
            assert (sum(b - a for a, b in spans), sorted(m[0] for m in matches)) == (hit, seen)
            for item, at, start, length in matches:
                assert words_of(docs[n])[at : at + length] == words_of(dict(items)[item])[start : start + length]


def test_query_against_plain_search(spark, sf_small):
    docs = table(spark, sf_small, "documents").select("doc_id", "text").collect()
    items = [(str(r[0]), r[1]) for r in table(spark, sf_small, "benchmark").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op2_decontaminate(spark, sf_small).collect()}
    assert len(got) == len(docs)
    for doc, (n, hit, seen) in zip(docs, plain((d.text for d in docs), items, 10), strict=True):
        row = got[doc.doc_id]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n, hit, len(seen), hit > 0)
        assert row.items_sha256 == hashlib.sha256(",".join(seen).encode()).hexdigest()
    assert any(r.contaminated for r in got.values())


def test_blocks_odd_rows_and_other_columns(spark):
    docs = odd_documents(spark, ["alpha beta gamma delta", "one two words one two"])
    bench = spark.createDataFrame([(1, "two words"), (1, "one"), (2, None), (3, "..."), (None, "alpha"), (4, "beta gamma")], "item_id long, text string")
    whole = decontaminate.find_matches(docs, bench, 3)
    parts = decontaminate.find_matches(docs, bench, 3, block_bytes=4)
    key = lambda df: sorted(str((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.score)) for r in df.collect())
    assert key(whole) == key(parts)
    items = [("1", "two words"), ("1", "one"), ("4", "beta gamma")]
    for r in whole.collect():
        assert (r.n_words, r.n_hit, r.item_ids) == next(plain([r.text], items, 3))
    kept = decontaminate.decontaminate(docs, bench, 3)
    assert kept.columns == docs.columns
    assert kept.count() == whole.where("n_hit = 0").count()


def test_empty_tables(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_matches(docs, none).where("contaminated").count() == 0
    assert decontaminate.find_matches(docs, none).count() == docs.count()
    assert decontaminate.find_matches(docs.limit(0), none).count() == 0
