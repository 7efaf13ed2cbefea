import numpy as np

from gaugeworks.llm import language, queries
from tests.llm.helpers import odd_documents

TRAIN = [(1, "the cat and the dog went home again with them " * 20, "en"), (2, "der hund und die katze gehen nach hause zurück " * 20, "de"), (3, "кошка и собака идут домой вместе " * 20, "ru"), (4, None, "en"), (5, "ignored", None)]


def train(spark):
    return language.train(spark.createDataFrame(TRAIN, "doc_id long, text string, lang string"))


def test_held_out_accuracy(spark):
    got = queries.op7_language(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_spans_of_mixed_text_and_scripts(spark):
    text = "the dog and the cat went home again кошка и собака идут домой der hund und die katze gehen"
    docs = spark.createDataFrame([(1, text), (2, "дом"), (3, "日本語"), (4, "12 34 ..."), (5, "«…»")], "doc_id long, text string")
    rows = {r.doc_id: r for r in language.identify(docs, train(spark), with_spans=True).collect()}
    assert [s.lang for s in rows[1].spans] == ["en", "ru", "de"]
    assert [(s.start, s.end) for s in rows[1].spans] == [(0, 8), (8, 13), (13, 19)]
    assert rows[2].lang_pred == "ru" and rows[3].lang_pred in ("en", "de", "ru")
    assert rows[4].lang_pred == rows[5].lang_pred == "und" and rows[5].spans == []


def test_path_against_a_word_by_word_pass():
    rng = np.random.default_rng(3)
    counts = np.array([0, 5, 1, 30, 0, 12])
    score = rng.normal(size=(counts.sum(), 3)).astype(np.float32) * 4
    got = language.Model(["a", "b", "c"], None, None, 2.0).path(score, counts)
    at = 0
    for n in counts:
        state, back = np.zeros(3, np.float32), []
        for e in score[at : at + n]:
            best = int(state.argmax())
            moved = state[best] - np.float32(2)
            back.append(np.where(state >= moved, np.arange(3), best))
            state = np.maximum(state, moved) + e
        now, out = int(state.argmax()), []
        for b in back[::-1]:
            out.append(now)
            now = int(b[now])
        assert out[::-1] == got[at : at + n].tolist()
        at += n


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumnRenamed("words", "lang_pred")
    rows = language.identify(docs, train(spark), docs.columns).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in range(4)] == ["und"] * 4 and by_id[0].score == 0
    kept = language.keep_known(docs, train(spark))
    assert kept.columns == docs.columns and not {0, 1, 2, 3} & {r.doc_id for r in kept.collect()}
    nothing = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), nothing).count() == 0
