import itertools
import random

from gaugeworks.llm import near_join
from gaugeworks.llm.components import components
from tests.llm.helpers import odd_documents, words


def runs(text, size=5):
    w = words(text)
    m = min(size, len(w))
    return frozenset(tuple(w[i : i + m]) for i in range(len(w) - m + 1)) if m else frozenset()


def plain(rows, threshold=0.8):
    """Per row: class, links; by comparing all pairs."""
    sets = [runs(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 10 * len(a & b) >= 10 * threshold * len(a | b) - 1e-9:
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 60), doc_id)
    return sorted((doc_id, least[find(i)], links[i]) for i, (doc_id, _) in enumerate(rows))


def got(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_query_against_all_pairs(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    assert got(near_join.near_duplicates(docs)) == plain([tuple(r) for r in docs.collect()])


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rnd.randint(0, 5)):
            text[rnd.randrange(len(text))] = f"x{rnd.randrange(9999)}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(rnd.choice(base) for _ in range(60))) for i in range(20)]
    rows += [(2000 + i, rows[i][1].upper()) for i in range(5)]
    monkeypatch.setattr(near_join, "BLOCK_CLASSES", 16)
    assert got(near_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = near_join.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[0].class_id == 0 and by_id[0].n_links == 0
    assert by_id[10].class_id == 9 and by_id[10].n_links == 3  # row 9 comes three times
    kept = near_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id is not None and r.doc_id for r in kept.collect())
    assert ids.count(9) == 1 and 10 not in ids and 0 in ids and 1 in ids
    assert near_join.near_duplicates(docs.limit(0)).count() == 0


def test_depth_is_shortened_to_the_target():
    assert near_join.matched_depth(0.8, 24, 10, 0.9999) == 5
    assert near_join.matched_depth(1.0, 1, 10, 0.9999) == 10


def test_components_of_a_long_chain(spark):
    rows = [(f"{i:04}", f"{i + 1:04}") for i in range(300)] + [("a", "b"), ("b", "a"), ("z", "z")]
    found = {r.node: r.root for r in components(spark.createDataFrame(rows, "a string, b string")).collect()}
    assert all(found[f"{i:04}"] == "0000" for i in range(301))
    assert found["b"] == found["a"] == "a" and "z" not in found


def test_a_recall_out_of_reach_is_refused():
    import pytest

    assert near_join.matched_depth(0.8) == 5
    with pytest.raises(ValueError):
        near_join.matched_depth(0.2)
    assert near_join.matched_depth(0.2, trees=60) == 1
