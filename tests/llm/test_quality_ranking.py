import numpy as np

from gaugeworks.llm import quality_ranking, queries
from tests.llm.helpers import odd_documents


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.op9_quality_ranking(spark, folder).join(labels, "doc_id").where("held_out").collect()
    score, label = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert len(rows) > 50
    better = (score[label == 1][:, None] > score[label == 0]).mean()
    assert better > 0.95
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_pairs_teach_the_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(quality_ranking.FEATURES)))
    label = (x[:, 3] + 0.1 * rng.normal(size=600) > -0.5).astype(int)
    ranking = quality_ranking.learn(x, label, 0.3)
    score = ranking.score(x)
    assert ((score >= 0.3) == label).mean() > 0.95 and score.min() >= 0 and score.max() <= 1


def test_odd_rows_and_no_labels(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    ranking = quality_ranking.train(docs, none, 0.3)
    rows = quality_ranking.score(docs, ranking, docs.columns).collect()
    assert len(rows) == docs.count() and {round(r.score, 6) for r in rows} == {0.3}
    some = spark.createDataFrame([(9, 1), (9, 1), (9, 0), (8, 0), (None, 1), (6, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality_ranking.score(docs, quality_ranking.train(docs, some)).collect())
    assert quality_ranking.score(docs.limit(0), ranking).count() == 0


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=500), rng.integers(0, 4, 500) / 3, np.zeros(500)])
    x[:5, 2] = [-1e300, -0.0, 1e-300, -2.5, 7]
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(5)
    at = np.linspace(0, 1, 13)
    assert np.array_equal(quality_ranking.quantiles(rows, "x", 3, at), np.quantile(x, at, axis=0).T)


def test_every_labelled_document_counts(spark):
    texts = [f"word{i % 7} plain text of {i} words, fine." if i % 3 else f"## {i} $$ %% && {i} ||" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    x = np.array([quality_ranking.features(t) for t in texts])
    whole = quality_ranking.train(docs, labels, 0.3)
    parts = quality_ranking.train(docs, labels, 0.3, group_rows=40)
    for ranking in (whole, parts):  # bins and cut of all rows, whatever the groups
        assert np.array_equal(ranking.edges, np.quantile(x, np.linspace(0, 1, 13)[:-1], axis=0).T)
        assert np.isclose(ranking.cut, np.quantile(ranking.raw(x).astype(float), 1 / 3))
        score = ranking.score(x)
        assert score[1::3].min() > score[::3].max()
