"""Incremental runs over a log whose events land late, share a millisecond, or are read again."""

import datetime as dt

from pyspark.sql import functions as F

from gaugeworks.plans import jobs
from gaugeworks.plans.ingest import TASKS
from gaugeworks.sources.ledger import untaken
from tests.conftest import rows, t
from tests.test_ingest import call, log
from tests.test_xml import GRAPH, report

RUNS = [t("2024-05-01 10:00:00"), t("2024-05-01 10:30:00"), t("2024-05-01 11:00:00"), t("2024-05-01 11:30:00")]


def event(second, login, millis=0):
    return call(f"2024-05-01T09:59:{second:02d}.{millis:03d}Z", login, "web", 1000, 2000, 1)


def executions(store):
    return {(r.login_name, r.exec_count) for r in store.table("fact_workload").read().groupBy("login_name").agg(F.sum("exec_count").alias("exec_count")).collect()}


def run(store, spark, number, events, **options):
    return jobs.run_task(store, "workload", {"event_log": log(spark, *events)}, RUNS[number], **options)


def test_late_and_simultaneous_events_count_once(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    first = [event(10, "a"), event(50, "b"), event(50, "b")]
    run(store, spark, 0, first)
    late = [event(20, "late"), event(50, "tie"), event(50, "b")]  # 30 s late; at the mark itself; a third equal one
    run(store, spark, 1, first + late)
    assert executions(store) == {("a", 1), ("b", 3), ("late", 1), ("tie", 1)}
    more = [event(30, "later"), event(59, "new")]
    run(store, spark, 2, first + late + more)
    run(store, spark, 3, first + late + more)
    assert executions(store) == {("a", 1), ("b", 3), ("late", 1), ("tie", 1), ("later", 1), ("new", 1)}


def test_runs_with_late_events_only_get_windows_of_their_own(spark, tmp_path):
    """Three runs take in late events of one login behind the same mark; none replaces another's sums."""
    store = jobs.Store(spark, str(tmp_path))
    events = [event(50, "a")]
    run(store, spark, 0, events)
    for n in (1, 2, 3):
        events.append(event(40 + n, "a"))
        assert run(store, spark, n, events) == 1
    assert executions(store) == {("a", 4)}
    assert len({r.window_start_utc for r in store.table("fact_workload").read().collect()}) == 4


def test_events_beyond_the_overlap_stay_out(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    run(store, spark, 0, [event(50, "a")])
    log_ = [event(50, "a"), event(45, "in"), event(30, "out")]
    assert run(store, spark, 1, log_, dry_run=True, overlap=dt.timedelta(seconds=10)) == 1
    assert run(store, spark, 1, log_, overlap=dt.timedelta(seconds=10)) == 1
    assert executions(store) == {("a", 1), ("in", 1)}


def test_a_run_that_failed_takes_nothing_in(spark, tmp_path, monkeypatch):
    """It stops between the noted events and the ledger; the next run counts them, and again under the same start."""
    store = jobs.Store(spark, str(tmp_path))
    run(store, spark, 0, [event(10, "a")])
    append, events = jobs._Run._append, [event(10, "a"), event(5, "late"), event(50, "b")]

    def broken(self, names, status, *rest):
        if status == "success" and names.first()[0] != jobs.FLEET:
            raise RuntimeError("lost")
        append(self, names, status, *rest)

    monkeypatch.setattr(jobs._Run, "_append", broken)
    try:
        run(store, spark, 1, events)
    except RuntimeError:
        pass
    monkeypatch.setattr(jobs._Run, "_append", append)
    for _ in range(2):
        run(store, spark, 2, events)
    run(store, spark, 3, events)
    assert executions(store) == {("a", 1), ("late", 1), ("b", 1)}


def test_taken_events_expire_behind_every_mark(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    run(store, spark, 0, [event(10, "a")])
    store.purge(t("2024-06-01 00:00:00"), {name: 9999 for name in [*{table for table, _ in TASKS.values()}, "collection_run"]})
    assert store.taken("workload").count() == 1  # the mark may still be read behind
    newer = call("2024-05-20T00:00:00.000Z", "b", "web", 1, 1, 1)
    run(store, spark, 1, [newer])
    store.purge(t("2024-06-01 00:00:00"), {name: 9999 for name in [*{table for table, _ in TASKS.values()}, "collection_run"]})
    assert store.taken("workload").count() == 1 and store.taken("deadlocks").count() == 0


def test_deadlocks_that_several_polls_hold_are_one(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))

    def buffers(*times):
        xml = "<RingBufferTarget>" + "".join(report(x, GRAPH.replace("60", str(n + 60))) for n, x in enumerate(times)) + "</RingBufferTarget>"
        return {"buffers": spark.createDataFrame([("i", xml), ("i", xml)], "source_instance string, target_xml string")}

    jobs.run_task(store, "deadlocks", buffers("2024-05-01T10:00:00.000Z"), RUNS[0])
    both = buffers("2024-05-01T10:00:00.000Z", "2024-05-01T09:59:00.000Z")
    assert jobs.run_task(store, "deadlocks", both, RUNS[1]) == 1
    assert jobs.run_task(store, "deadlocks", both, RUNS[2]) == 0
    assert store.table("fact_deadlock").read().count() == 2


def test_untaken_passes_on_what_has_no_mark_or_time(spark):
    columns = "source_instance string, event_time_utc timestamp, mark_utc timestamp, event_data string"
    mark = t("2024-05-01 10:00:00")
    data = [("i", mark, None, "first run"), ("i", None, mark, "no time"), ("i", mark, mark, "x"), ("i", mark, mark, "x"), (None, mark, mark, "x"), ("i", mark, mark, None)]
    events = spark.createDataFrame(data, columns)
    taken = spark.createDataFrame([("i", 1, "x"), (None, 1, "x"), ("i", 5, "")], "source_instance string, n long, data string")
    taken = taken.select("source_instance", "n", F.sha2("data", 256).alias("event_id"))
    got = untaken(events, taken, "event_data", counted=True).select("source_instance", "event_data")
    assert sorted(map(tuple, got.collect())) == [("i", "first run"), ("i", "no time"), ("i", "x")]
    assert rows(untaken(events.limit(0), taken, "event_data", counted=False)) == set()
