import pytest
from pyspark.sql import functions as F

from gaugeworks.plans import jobs
from gaugeworks.plans.ingest import TASKS
from gaugeworks.schemas import TABLES
from gaugeworks.sources import read_events, read_raw, read_rowset
from gaugeworks.sources.ledger import recent_runs, run_marks
from tests.conftest import rows, t
from tests.test_ingest import EVENTS, call, log, raw

START = t("2024-05-01 10:05:00")


@pytest.fixture
def store(spark, tmp_path):
    return jobs.Store(spark, str(tmp_path))


def waits(spark):
    return raw(spark, "wait_type string, wait_time_ms long, waiting_tasks_count long", ("CXPACKET", 8, 5), ("WAITFOR", 1, 1), ("WRITELOG", 2, 2))


def test_dry_run_counts_and_writes_nothing(spark, store, tmp_path):
    assert jobs.run_task(store, "waits", {"wait_stats": waits(spark)}, START, dry_run=True) == 2
    assert list(tmp_path.iterdir()) == []


def test_run_writes_and_records(spark, store):
    assert jobs.run_task(store, "waits", {"wait_stats": waits(spark)}, START) == 2
    assert store.table("fact_wait_stats").read().count() == 2
    runs = {r.source_instance: r for r in store.ledger.runs().collect()}
    assert set(runs) == {"i", "*"}
    assert all((r.status, r.row_count, r.task, r.error_message) == ("success", 2, "waits", None) for r in runs.values())
    assert {r.started_at_utc for r in runs.values()} == {START}


def test_replay_changes_nothing(spark, store):
    for _ in range(2):
        jobs.run_task(store, "waits", {"wait_stats": waits(spark)}, START)
    assert store.table("fact_wait_stats").read().count() == 2


def test_failures_are_recorded_and_raised(spark, store):
    broken = waits(spark).drop("wait_time_ms")
    with pytest.raises(Exception):
        jobs.run_task(store, "waits", {"wait_stats": broken}, START)
    (run,) = store.ledger.runs().collect()
    assert run.status == "failed" and "wait_ms_cum" in run.error_message and run.row_count is None
    late = waits(spark).withColumn("wait_time_ms", F.raise_error(F.lit("lost the source")))
    with pytest.raises(Exception):
        jobs.run_task(store, "waits", {"wait_stats": late}, t("2024-05-01 10:10:00"))
    assert {r.status for r in store.ledger.runs().collect()} == {"failed"}


def test_incremental_runs_continue_where_the_last_one_ended(spark, store):
    assert jobs.run_task(store, "workload", {"event_log": log(spark, *EVENTS)}, START) == 2
    marks = run_marks(store.ledger.runs(), "workload").where("source_instance = 'i'")
    assert rows(marks) == {("i", t("2024-05-01 00:00:05"))}
    more = log(spark, *EVENTS, call("2024-05-01T00:00:09.000Z", "new", "web", 1000, 2000, 1))
    assert jobs.run_task(store, "workload", {"event_log": more}, t("2024-05-01 10:35:00")) == 1
    facts = store.table("fact_workload").read()
    assert {(r.login_name, r.window_start_utc, r.exec_count) for r in facts.collect()} == {
        ("app", t("2024-04-30 23:59:00"), 2),
        ("etl", t("2024-04-30 23:59:00"), 1),
        ("new", t("2024-05-01 00:00:05"), 1),
    }
    assert jobs.run_task(store, "workload", {"event_log": more}, t("2024-05-01 11:05:00")) == 0


def test_failed_runs_do_not_move_the_mark(spark):
    columns = "source_instance string, task string, started_at_utc timestamp, status string, high_water_utc timestamp"
    runs = spark.createDataFrame(
        [
            ("i", "workload", t("2024-05-01 10:00:00"), "success", None),
            ("i", "workload", t("2024-05-01 12:00:00"), "failed", None),
            ("i", "deadlocks", t("2024-05-01 13:00:00"), "success", None),
            ("j", "workload", t("2024-05-01 11:00:00"), "success", t("2024-05-01 10:59:00")),
        ],
        columns,
    )
    assert rows(run_marks(runs, "workload")) == {("i", t("2024-05-01 10:00:00")), ("j", t("2024-05-01 10:59:00"))}


def test_recent_runs(spark):
    runs = spark.range(80).selectExpr("id AS run_id", "timestamp_seconds(id) AS started_at_utc")
    assert [r.run_id for r in recent_runs(runs).collect()] == list(range(79, 29, -1))


def test_purge_covers_every_table_and_the_ledger(spark, store):
    jobs.run_task(store, "waits", {"wait_stats": waits(spark)}, START)
    dropped = store.purge(t("2025-05-01 00:00:00"))
    assert set(dropped) == {*TABLES, "collection_run"}
    assert dropped["fact_wait_stats"] == ["day=2024-05-01"] == dropped["collection_run"]
    assert store.ledger.runs().count() == 0


def test_rules_are_seeded_once(spark, store, tmp_path):
    assert store.rules().count() == 16
    store.rules().where("class_id <> 1").write.mode("overwrite").parquet(str(tmp_path / "edited"))
    (tmp_path / "dim_workload_class").rename(tmp_path / "old")
    (tmp_path / "edited").rename(tmp_path / "dim_workload_class")
    assert store.rules().count() == 15


def test_every_task_has_a_table():
    assert {table for table, _ in TASKS.values()} == set(TABLES)


def test_landed_sources(spark, tmp_path):
    waits(spark).write.parquet(str(tmp_path / "w"))
    columns = "source_instance string, snapshot_time_utc timestamp, wait_type string"
    assert read_raw(spark, str(tmp_path / "w"), columns).count() == 3
    (tmp_path / "rows.json").write_text('[{"wait_type": "A", "wait_time_ms": 1},\n {"wait_type": "B"}]')
    got = read_rowset(spark, str(tmp_path / "rows.json"), "wait_type string, wait_time_ms long")
    assert rows(got) == {("A", 1), ("B", None)}
    for n in [1, 2]:
        (tmp_path / f"Workload_{n}.xml").write_text("\n".join(EVENTS[:n]))
    assert read_events(spark, str(tmp_path / "Workload*.xml")).count() == 3


def test_quiet_instances_get_a_row_and_a_bad_one_stops_no_other(spark, store):
    columns = "source_instance string, snapshot_time_utc timestamp, wait_type string, wait_time_ms long, waiting_tasks_count long"
    data = [(n, START, "WAITFOR" if n == "quiet" else "CXPACKET", -1 if n == "bad" else 8, 1) for n in ("a", "b", "bad", "quiet", "z")]
    frame = spark.createDataFrame(data, columns)
    stops = F.when(F.col("wait_time_ms") < 0, F.raise_error(F.lit("unreadable"))).otherwise(F.col("wait_time_ms"))
    assert jobs.run_task(store, "waits", {"wait_stats": frame.withColumn("wait_time_ms", stops)}, START) == 3
    assert {r.source_instance for r in store.table("fact_wait_stats").read().collect()} == {"a", "b", "z"}
    runs = {r.source_instance: (r.status, r.row_count) for r in store.ledger.runs().collect()}
    assert runs == {"a": ("success", 1), "b": ("success", 1), "z": ("success", 1), "quiet": ("success", 0), "bad": ("failed", None), "*": ("failed", 3)}


def test_unreadable_events_are_kept_once_and_counted(spark, store):
    bad = call("2024-05-01T00:00:07.000Z", "app", "web", 1, 1, 1).replace(">1<", ">bad<", 1)
    timeless = call("sometime", "app", "web", 1, 1, 1)
    for n in range(2):
        jobs.run_task(store, "workload", {"event_log": log(spark, *EVENTS, bad, timeless)}, t(f"2024-05-01 1{n}:05:00"))
    aside = store.quarantine("workload").collect()
    assert {bad, timeless} <= {r.event_data for r in aside} and len(aside) == len({r.event_data for r in aside})
    notes = [r.error_message for r in store.ledger.runs().where("source_instance = 'i'").orderBy("started_at_utc").collect()]
    assert notes == [f"{len(aside)} events set aside", None]
