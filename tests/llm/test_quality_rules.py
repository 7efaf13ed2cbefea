import random
from collections import Counter

from gaugeworks.llm import queries, quality_rules
from gaugeworks.llm.common import written
from tests.llm.helpers import odd_documents

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    out, now = [], ""
    for c in text or "":
        if c in SPACE:
            out += [now] if now else []
            now = ""
        else:
            now += c
    return out + ([now] if now else [])


def plain(text):
    w = split(text)
    wins = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {k for i in range(len(w) - 2) if wins[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def figures(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_figures_of_the_table(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = queries.op5_quality_rules(spark, sf_small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *_, again = expected = plain(texts[r.doc_id])
        assert figures(r) == expected
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert not (r.base_failed and r.kept)
    assert sum(r.kept for r in rows) > 0.8 * sum(not r.base_failed for r in rows)


def test_odd_rows(spark):
    rnd = random.Random(3)
    more = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    docs = odd_documents(spark, [*more, "a\x0bb\x0cc a\x1cb", "l\nl\n \nl\n\n"]).withColumnRenamed("words", "hashes")
    rows = quality_rules.figures(docs.withColumn("raw", docs.text)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert figures(r) == plain(r.raw), r.raw


def test_outliers_of_a_group_go(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8)))
    rows = [(i, " ".join(word() for _ in range(80)), "en", "a") for i in range(250)]
    rows += [(999, " ".join(word() + "###" for _ in range(80)), "en", "a"), (1000, " ".join(word() + "###" for _ in range(80)), None, None)]
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[999] and not kept[1000] and all(kept[i] for i in range(250))


def test_a_group_follows_its_own_data(spark):
    """Texts full of symbols are usual in one source and outliers in the other; a small group goes with its language."""
    rnd = random.Random(5)
    text = lambda mark: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) + mark for _ in range(80))
    rows = [(i, text(""), "en", "plain") for i in range(400)] + [(1000 + i, text("###"), "en", "code") for i in range(400)]
    rows += [(2000, text("###"), "en", "plain"), (2001, text("#" * 30), "en", "code"), (2002, text(""), "en", "new")]
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in [*range(400), *range(1000, 1400), 2002]) and not kept[2000] and not kept[2001]


def test_thresholds_of_the_table_are_those_of_its_groups(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = written(quality_rules.figures(docs).drop("text"), "figures")
    limits = quality_rules.thresholds(rows).collect()
    assert len({r.limits.word_length.high for r in limits}) > 0.9 * len(limits) > 4
    counts = {(r.lang, r.source): r["count"] for r in rows.where(~quality_rules.base_failed()).groupBy("lang", "source").count().collect()}
    assert set(counts) == {(r.lang, r.source) for r in limits}


def test_empty_table_and_names(spark):
    docs = odd_documents(spark)
    out = quality_rules.apply_rules(docs)
    assert out.count() == docs.count()
    assert quality_rules.apply_rules(docs.limit(0)).count() == 0
