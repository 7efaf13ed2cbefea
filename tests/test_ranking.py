import random
from decimal import Decimal

import pytest

from gaugeworks.operators import latest_date_per_group, latest_per_key, rank_within, topk_union
from tests.conftest import d, rows

COLUMNS = "g string, id int, v decimal(18,2), w double"


def sample(size=600, seed=3):
    rng = random.Random(seed)
    data = []
    for i in range(size):
        g = "hot" if i % 3 else f"g{i % 5}"
        v = rng.choice([None, Decimal("0.00"), Decimal(rng.randrange(10**6)) / 100, Decimal(-rng.randrange(900))])
        w = rng.choice([5.0, rng.random() * 10, 1e12 * rng.random(), -(10.0 ** rng.randrange(9))])
        data.append((g, i, v, w))
    return data


def brute_rank(data, column):
    out = {}
    for row in data:
        peers = [r[column] for r in data if r[0] == row[0]]
        if row[column] is None:
            out[row[1]] = 1 + sum(p is not None for p in peers)
        else:
            out[row[1]] = 1 + sum(p is not None and p > row[column] for p in peers)
    return out


@pytest.mark.parametrize("pieces", [1, 20, 64, 4096])
def test_rank_does_not_depend_on_the_pieces(spark, pieces):
    data = sample()
    got = rank_within(spark.createDataFrame(data, COLUMNS), ["g"], {"rv": "v", "rw": "w"}, pieces).collect()
    assert len(got) == len(data)
    assert {r.id: r.rv for r in got} == brute_rank(data, 2)
    assert {r.id: r.rw for r in got} == brute_rank(data, 3)


def test_rank_of_one_repeated_value(spark):
    data = [("g", i, Decimal("7.00"), 0.0) for i in range(700)]
    got = rank_within(spark.createDataFrame(data, COLUMNS), ["g"], {"r": "v"})
    assert {r.r for r in got.collect()} == {1}


def test_rank_with_null_groups_one_outlier_and_no_job_while_planning(spark):
    data = [(None, i, Decimal(i), 0.0) for i in range(50)] + [("g", i, Decimal(i % 40), 0.0) for i in range(400)]
    data += [("g", 400, Decimal(10**12), 0.0), ("n", 1, None, 0.0)]
    df = spark.createDataFrame(data, COLUMNS)
    spark.sparkContext.setJobGroup("ranks", "planning")
    ranked = rank_within(df, ["g"], {"r": "v"}, 8)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ranks")
    got = {(x.g, x.id): x.r for x in ranked.collect()}
    assert len(got) == len(data)
    for g in (None, "g", "n"):
        part = [x for x in data if x[0] == g]
        assert {k[1]: r for k, r in got.items() if k[0] == g} == brute_rank(part, 2)


def test_latest_per_key_breaks_ties_by_order(spark):
    data = [("a", d("2024-01-01"), 1), ("a", d("2024-01-02"), 2), ("a", d("2024-01-02"), 3), ("b", d("2023-01-01"), 4)]
    df = spark.createDataFrame(data, "k string, day date, n int")
    assert rows(latest_per_key(df, ["k"], ["day", "n"]).select("k", "n")) == {("a", 3), ("b", 4)}


def test_latest_date_keeps_every_row_of_the_date(spark):
    data = [("a", d("2024-01-01"), 1), ("a", d("2024-01-02"), 2), ("a", d("2024-01-02"), 3), ("b", d("2023-01-01"), 4)]
    df = spark.createDataFrame(data, "k string, day date, n int")
    got = latest_date_per_group(df, ["k"], "day")
    assert rows(got.select("k", "n")) == {("a", 2), ("a", 3), ("b", 4)}


def test_topk_union_lists_a_row_once(spark):
    data = [("s", i, i, 10 - i) for i in range(10)] + [("t", 1, 5, 5)]
    df = spark.createDataFrame(data, "g string, id int, x int, y int")
    got = topk_union(df, ["g"], ["id"], ["x", "y"], 2)
    assert rows(got.select("g", "id")) == {("s", 9), ("s", 8), ("s", 0), ("s", 1), ("t", 1)}


def test_hot_groups_and_hot_values_spread(spark):
    """Half of the rows are one group, half of those one value: no window group holds more than a few of the rows."""
    from pyspark.sql import functions as F

    from gaugeworks.operators import ranking

    data = [("hot" if i % 2 else f"g{i % 200}", i, Decimal(5 if i % 4 == 1 else i % 3000), None if i % 11 == 0 else 1.0) for i in range(20_000)]
    df = spark.createDataFrame(data, COLUMNS)
    cuts = ranking._cuts(df, ["g"], "v", 256)
    assert cuts.count() <= 64
    parts = ranking._in_pieces(df.withColumn("_hash", ranking._row_hash(df)), cuts, ["g"], "v").groupBy("g", "_piece", "_salt").count()
    assert parts.agg(F.max("count")).first()[0] < 1000
    got = {r.id: (r.a, r.b) for r in rank_within(df, ["g"], {"a": "v", "b": "w"}, 256).collect()}
    for column, at in ((2, 0), (3, 1)):
        by_group = {}
        for r in data:
            by_group.setdefault(r[0], []).append(r)
        for part in by_group.values():
            known = sorted((r[column] for r in part if r[column] is not None), reverse=True)
            first = {}
            for n, v in enumerate(known, 1):
                first.setdefault(v, n)
            assert all(got[r[1]][at] == (len(known) + 1 if r[column] is None else first[r[column]]) for r in part)
