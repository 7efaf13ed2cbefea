import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import counter_delta
from gaugeworks.plans import ingest
from gaugeworks.functions.xml import parse_events
from gaugeworks.schemas import TABLES
from gaugeworks.sources import FactTable
from gaugeworks.streaming import event_stream, stream_counter_deltas, stream_deadlocks, stream_facts, stream_workload
from tests.conftest import rows, t
from tests.test_ingest import call
from tests.test_xml import GRAPH, report

LOG = "source_instance string, event_data string"


def land(spark, folder, name, data, columns):
    spark.createDataFrame(data, columns).coalesce(1).write.parquet(f"{folder}/{name}")


def calls():
    rng = random.Random(1)
    return [
        ("i", call(f"2024-05-01T0{rng.randrange(3)}:{rng.randrange(60):02d}:00.{n:03d}Z", f"u{n % 3}", "p", n * 10, 5, n))
        for n in range(60)
    ]


def test_workload_stream_equals_batch(spark, tmp_path):
    data = calls()
    for n in range(3):
        land(spark, tmp_path / "in", f"part{n}", data[n * 20 : n * 20 + 20], LOG)
    table = FactTable(spark, TABLES["fact_workload"], str(tmp_path / "fact"))
    log = event_stream(spark, str(tmp_path / "in" / "*"), LOG, files_per_batch=1)
    stream_workload(log, table, str(tmp_path / "cp"), late="1 day").awaitTermination()
    batch = ingest.ingest_workload_windows(parse_events(spark.createDataFrame(data, LOG)))
    assert rows(table.read()) == rows(batch)


def test_redelivered_events_count_once(spark, tmp_path):
    data = calls()[:10]
    land(spark, tmp_path / "in", "a", data, LOG)
    land(spark, tmp_path / "in", "b", data, LOG)
    table = FactTable(spark, TABLES["fact_workload"], str(tmp_path / "fact"))
    log = event_stream(spark, str(tmp_path / "in" / "*"), LOG, files_per_batch=1)
    query = stream_workload(
        log, table, str(tmp_path / "cp"), late="1 day", distinct_on=["source_instance", "event_data"]
    )
    query.awaitTermination()
    assert table.read().agg(F.sum("exec_count")).first()[0] == 10


def test_deadlock_stream_collapses_repeats(spark, tmp_path):
    xml = "<RingBufferTarget>" + report("2024-05-01T10:00:00.000Z", GRAPH) + "</RingBufferTarget>"
    columns = "source_instance string, target_xml string"
    for n in range(2):
        land(spark, tmp_path / "in", f"p{n}", [("i", xml), ("j", xml)], columns)
    table = FactTable(spark, TABLES["fact_deadlock"], str(tmp_path / "fact"))
    buffers = event_stream(spark, str(tmp_path / "in" / "*"), columns, files_per_batch=1)
    stream_deadlocks(buffers, table, str(tmp_path / "cp")).awaitTermination()
    assert {(r.source_instance, r.victim_session_id) for r in table.read().collect()} == {("i", 60), ("j", 60)}
    assert table.read().count() == 2


def test_any_ingest_plan_runs_on_a_stream(spark, tmp_path):
    columns = "source_instance string, snapshot_time_utc timestamp, wait_type string, wait_time_ms long, waiting_tasks_count long"
    land(spark, tmp_path / "in", "a", [("i", t("2024-05-01 10:00:00"), "CXPACKET", 1, 1), ("i", t("2024-05-01 10:00:00"), "WAITFOR", 1, 1)], columns)
    table = FactTable(spark, TABLES["fact_wait_stats"], str(tmp_path / "fact"))
    raw = event_stream(spark, str(tmp_path / "in" / "*"), columns)
    stream_facts(raw, ingest.ingest_waits, table, str(tmp_path / "cp")).awaitTermination()
    assert [r.wait_type for r in table.read().collect()] == ["CXPACKET"]


COUNTERS = "k string, at timestamp, a long"


@pytest.mark.parametrize("slot", [None, "hour"])
def test_stream_deltas_equal_batch_deltas(spark, tmp_path, slot):
    rng = random.Random(9)
    data = [(f"k{n % 3}", t(f"2024-05-01 {n // 60:02d}:{n % 60:02d}:00"), rng.randrange(40)) for n in range(240)]
    for n in range(4):
        land(spark, tmp_path / "in", f"p{n}", data[n * 60 : n * 60 + 60], COUNTERS)
    stream = event_stream(spark, str(tmp_path / "in" / "*"), COUNTERS, files_per_batch=1)
    query = stream_counter_deltas(
        stream, ["k"], ["at"], {"a": "da"}, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"), slot
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "deltas")).select("k", "at", "a", "da")
    batch = counter_delta(spark.createDataFrame(data, COUNTERS), ["k"], ["at"], {"a": "da"})
    assert rows(got) == rows(batch.select("k", "at", "a", "da"))


def test_late_rows_are_set_aside(spark, tmp_path):
    land(spark, tmp_path / "in", "a", [("k", t("2024-05-01 10:00:00"), 5), ("k", t("2024-05-01 11:00:00"), 9)], COUNTERS)
    args = (["k"], ["at"], {"a": "da"}, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"))

    def run():
        stream = event_stream(spark, str(tmp_path / "in" / "*"), COUNTERS)
        stream_counter_deltas(stream, *args).awaitTermination()

    run()
    land(spark, tmp_path / "in", "b", [("k", t("2024-05-01 10:30:00"), 7), ("k", t("2024-05-01 12:00:00"), 12)], COUNTERS)
    run()
    deltas = spark.read.parquet(str(tmp_path / "out" / "deltas")).select("at", "da")
    assert rows(deltas) == {(t("2024-05-01 11:00:00"), 4), (t("2024-05-01 12:00:00"), 3)}
    late = spark.read.parquet(str(tmp_path / "out" / "late")).select("at", "a")
    assert rows(late) == {(t("2024-05-01 10:30:00"), 7)}
