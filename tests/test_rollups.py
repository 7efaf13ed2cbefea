"""Reports from rollups agree with reports over all facts, after every kind of write."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.plans import jobs, reports
from gaugeworks.plans.rollups import Rollups
from gaugeworks.sources import fact_table
from gaugeworks.sources.files import remove
from tests.conftest import d, rows, t

AS_OF = dt.datetime(2024, 3, 31, 12)


def usage(spark, days, seed=1, gaps=0.0, tables=6):
    rng = random.Random(seed)
    data = [
        ("i", day, "db", "dbo", f"t{n}", *[rng.randrange(1000) for _ in range(4)], None, None)
        for day in days for n in range(tables) if rng.random() >= gaps
    ]
    columns = "source_instance string, snapshot_date date, database_name string, schema_name string, table_name string, "
    counters = "seeks_cum long, scans_cum long, lookups_cum long, updates_cum long, last_user_read_utc timestamp, last_user_update_utc timestamp"
    return spark.createDataFrame(data, columns + counters)


def same_trend(store, rollups, **options):
    full = reports.table_access_trend(store.table("fact_table_usage").read(), AS_OF, **options)
    got = rollups.report("table_access_trend", AS_OF, **options)
    assert got.columns == full.columns and rows(got) == rows(full)


def workload(spark, days, cpu=1.0):
    data = [("i", dt.datetime.combine(day, dt.time(h)), f"l{n}", p, "h", "db", 1 + n, cpu * n, cpu, 10 * n, 1, 1) for day in days for h in (1, 2) for n, p in enumerate(["Tableau", "sqlcmd", None, "x"])]
    names = "source_instance window_start_utc login_name program_name host_name database_name exec_count total_cpu_ms total_duration_ms total_logical_reads total_writes total_rows"
    frame = spark.createDataFrame(data, names.split())
    return frame.withColumn("attribution_hash", F.unhex(F.sha2(F.concat_ws("|", "login_name", "program_name"), 256))).withColumns(
        {c: F.col(c).cast("decimal(18,2)") for c in ("total_cpu_ms", "total_duration_ms")}
    )


def test_sums_follow_upserts_replays_and_purges(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    rollups, table = Rollups(store), store.table("fact_workload")
    days = [d(f"2024-01-{n:02d}") for n in range(1, 6)]

    def agree():
        facts = store.table("fact_workload").read()
        assert rows(rollups.report("top_logins")) == rows(reports.top_logins(facts))
        assert rows(rollups.report("workload_by_category")) == rows(reports.workload_by_category(facts))
        assert all(not x for x in rollups.refresh().values())

    for batch in (workload(spark, days[:4]), workload(spark, days[2:3], 7.0), workload(spark, days[2:3], 7.0), workload(spark, days[4:])):
        table.upsert(batch)
        agree()
    table.purge(t("2024-01-03 02:00:00"), days=0)
    agree()
    assert rollups._made("top_logins") == days[2:]
    table.purge(t("2024-02-01 00:00:00"), days=0)
    assert rollups.report("top_logins").count() == 0


def test_only_touched_days_are_read_and_written(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    rollups, table = Rollups(store), store.table("fact_workload")
    days = [d(f"2024-01-{n:02d}") for n in range(1, 9)]
    table.upsert(workload(spark, days))
    files = lambda: {f for f in spark.read.parquet(f"{store.root}/rollup/top_logins").inputFiles()}
    before = files()
    rollups.close()
    table.upsert(workload(spark, days[3:4], 3.0))
    assert rollups.stale("top_logins")[:2] == ([days[3]], [])
    part = rollups.partial("top_logins", [days[3]])
    scanned = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scanned and "2024-01-04" in scanned
    part.collect()
    assert rollups.refresh()["top_logins"] == [days[3]]
    changed = before ^ files()
    assert changed and all("day=2024-01-04" in f for f in changed)


def test_many_days_are_made_by_pieces(spark, tmp_path, monkeypatch):
    """A year's sums in one go would shuffle nearly as many rows as the facts have."""
    monkeypatch.setattr(fact_table, "PIECE_BYTES", 1)
    monkeypatch.setattr(fact_table, "PIECES", 3)
    store = jobs.Store(spark, str(tmp_path))
    rollups, days = Rollups(store), [d("2024-01-01") + dt.timedelta(days=n) for n in range(12)]
    partial, made = rollups.partial, []
    monkeypatch.setattr(rollups, "partial", lambda name, part: made.append((name, len(part))) or partial(name, part))
    store.table("fact_workload").upsert(workload(spark, days))
    for name in ("top_logins", "workload_by_category"):
        counts = [n for made_name, n in made if made_name == name]
        assert sum(counts) == 12 and max(counts) <= 4 and rollups._made(name) == days
    assert rows(rollups.report("top_logins")) == rows(reports.top_logins(store.table("fact_workload").read()))
    assert all(not x for x in rollups.refresh().values())


def test_heatmap(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    rollups, table = Rollups(store), store.table("fact_cpu")
    data = [("i", t(f"2024-01-{n % 20 + 1:02d} {n % 24:02d}:{n % 60:02d}:00"), None if n % 7 == 0 else n % 101, 1, 2) for n in range(300)]
    cpu = spark.createDataFrame(data, "source_instance string, sample_time_utc timestamp, sql_cpu_pct short, other_cpu_pct short, idle_pct short")
    for part in (cpu.where("day(sample_time_utc) < 12"), cpu.where("day(sample_time_utc) > 9")):
        table.upsert(part)
        assert rows(rollups.report("cpu_hour_heatmap")) == rows(reports.cpu_hour_heatmap(table.read()))


@pytest.mark.parametrize("gaps", [0.0, 0.5])
def test_access_trend_follows_new_days_corrections_and_purges(spark, tmp_path, gaps):
    store = jobs.Store(spark, str(tmp_path))
    rollups, table = Rollups(store), store.table("fact_table_usage")
    days = [AS_OF.date() - dt.timedelta(days=n) for n in range(11, -1, -1)]
    table.upsert(usage(spark, days[:8], gaps=gaps))
    same_trend(store, rollups)
    table.upsert(usage(spark, [days[9]], 2, gaps))  # a new last day, then one between
    same_trend(store, rollups)
    table.upsert(usage(spark, [days[8]], 3, gaps, tables=9))
    same_trend(store, rollups)
    table.upsert(usage(spark, [days[4]], 4, gaps))  # corrected
    same_trend(store, rollups)
    same_trend(store, rollups, days=3)
    table.purge(dt.datetime.combine(days[3], dt.time()), days=0)
    same_trend(store, rollups)
    table.upsert(usage(spark, [days[10]], 5, gaps))
    same_trend(store, rollups)


def test_a_new_last_day_reads_that_day_and_the_state_before_it(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    rollups, table = Rollups(store), store.table("fact_table_usage")
    days = [AS_OF.date() - dt.timedelta(days=n) for n in range(5, -1, -1)]
    table.upsert(usage(spark, days[:5]))
    rollups.close()
    table.upsert(usage(spark, days[5:], 2))
    assert rollups.refresh()["table_access_trend"] == days[5:]
    same_trend(store, rollups)


def test_a_crash_between_table_and_rollup_is_mended(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    rollups, table = Rollups(store), store.table("fact_workload")
    days = [d("2024-01-01"), d("2024-01-02")]
    table.upsert(workload(spark, days))
    for name in ("_made_from", ""):  # the mark is missing; the whole day is
        remove(spark, f"{store.root}/rollup/top_logins/day=2024-01-02/{name}".rstrip("/"))
        assert rollups.refresh()["top_logins"] == [days[1]]
        assert rows(rollups.report("top_logins")) == rows(reports.top_logins(table.read()))
