import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import counter_delta
from tests.conftest import rows, t

COLUMNS = "k string, at timestamp, a long, b long"
START = t("2024-03-01 00:00:00")


def brute(data):
    """(k, at, delta a, delta b) per row after the first of its series."""
    out, last = set(), {}
    for k, at, a, b in sorted(data):
        if k in last:
            pa, pb = last[k]
            out.add((k, at, a - pa if a >= pa else a, b - pb if b >= pb else b))
        last[k] = (a, b)
    return out


def deltas(df, **options):
    return counter_delta(df, ["k"], ["at"], {"a": "da", "b": "db"}, **options).select("k", "at", "da", "db")


def test_first_row_dropped_and_counters_reset_on_their_own(spark):
    data = [
        ("x", t("2024-03-01 00:00:00"), 10, 5),
        ("x", t("2024-03-01 00:15:00"), 25, 2),
        ("x", t("2024-03-01 00:30:00"), 3, 9),
        ("x", t("2024-03-01 00:45:00"), 3, 9),
        ("y", t("2024-03-01 00:00:00"), 1, 1),
    ]
    got = rows(deltas(spark.createDataFrame(data, COLUMNS)))
    assert got == {
        ("x", t("2024-03-01 00:15:00"), 15, 2),
        ("x", t("2024-03-01 00:30:00"), 3, 7),
        ("x", t("2024-03-01 00:45:00"), 0, 0),
    }


@pytest.mark.parametrize("slot", [None, "hour", "day"])
def test_slots_do_not_change_the_result(spark, slot):
    rng = random.Random(7)
    data = []
    for k in ["hot", "warm", "lone"]:
        minutes = rng.sample(range(6 * 24 * 60), {"hot": 400, "warm": 40, "lone": 1}[k])
        data += [(k, START + dt.timedelta(minutes=m), rng.randrange(50), rng.randrange(50)) for m in minutes]
    df = spark.createDataFrame(data, COLUMNS).repartition(5)
    assert rows(deltas(df, slot=slot)) == brute(data)


@pytest.mark.parametrize("slot", [None, "day"])
def test_since_keeps_the_delta_across_the_cut(spark, slot):
    data = [("x", START + dt.timedelta(days=n), 100 - n if n == 4 else n * 10, n) for n in range(8)]
    cut = START + dt.timedelta(days=4)
    got = rows(deltas(spark.createDataFrame(data, COLUMNS), slot=slot, since=F.lit(cut)))
    assert got == {r for r in brute(data) if r[1] >= cut}


def test_ties_are_ordered_by_the_further_order_columns(spark):
    data = [("x", START, 2, 20), ("x", START, 1, 10), ("x", START + dt.timedelta(hours=1), 3, 35)]
    df = spark.createDataFrame(data, "k string, at timestamp, n int, a long")
    got = counter_delta(df, ["k"], ["at", "n"], {"a": "da"}, slot="hour")
    assert rows(got.select("n", "da")) == {(2, 10), (3, 15)}


def test_null_keys_are_one_series(spark):
    data = [(k, START + dt.timedelta(hours=30 * n), n, n) for k in ("x", None) for n in range(5)]
    got = rows(deltas(spark.createDataFrame(data, COLUMNS), slot="day"))
    assert {r[1:] for r in got if r[0] is None} == {r[1:] for r in got if r[0] == "x"} and len(got) == 8


def test_planning_runs_no_job(spark):
    data = spark.createDataFrame([("x", START + dt.timedelta(hours=n), n, n) for n in range(5)], COLUMNS)
    spark.sparkContext.setJobGroup("planning", "")
    deltas(data, slot="hour")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
