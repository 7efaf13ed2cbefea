"""Ingest plans over several raw tables that arrive as streams of their own."""

import pytest
from pyspark.sql import functions as F

from gaugeworks.plans import ingest
from gaugeworks.schemas import TABLES
from gaugeworks.sources import FactTable
from gaugeworks.streaming import event_stream, stream_tables, stream_unreadable
from tests.conftest import rows, t
from tests.test_ingest import call
from tests.test_streaming import LOG, land

POLL = "source_instance string, snapshot_time_utc timestamp, "
REQUESTS = POLL + "session_id int, blocking_session_id int, database_id long, wait_type string, wait_time long, wait_resource string, cpu_time long, logical_reads long"
SESSIONS = POLL + "session_id int, login_name string, host_name string, program_name string, is_user_process boolean"
NAMES = POLL + "database_id long, name string"


def hour(n):
    return t(f"2024-05-01 {n:02d}:00:00")


def polls(n):
    """Requests, sessions and database names of poll n; database 8 has no name, and 7 is renamed with each poll."""
    requests = [("i", hour(n), s, s + 1, 7 + s % 2, "LCK_M_X", 5 * s, "KEY", s, 1) for s in range(51, 57)]
    sessions = [("i", hour(n), s, f"l{s}", "h", "p", s != 56) for s in range(51, 57)]
    return requests, sessions, [("i", hour(n), 7, f"db{n}")]


def streams(spark, folder, behind=0, hours=4):
    for n in range(hours):
        requests, sessions, names = polls(n)
        land(spark, folder / "requests", f"p{n}", requests, REQUESTS)
        land(spark, folder / "names", f"p{n}", names, NAMES)
    for n in range(-behind, hours):
        land(spark, folder / "sessions", f"p{n + behind}", polls(n)[1] if n >= 0 else [], SESSIONS)
    read = lambda name, columns: event_stream(spark, str(folder / name / "*"), columns, files_per_batch=1)
    return {"requests": read("requests", REQUESTS), "sessions": read("sessions", SESSIONS), "databases": read("names", NAMES)}


def landed(spark, hours=4):
    parts = [polls(n) for n in range(hours)]
    frames = [spark.createDataFrame([r for p in parts for r in p[k]], c) for k, c in enumerate((REQUESTS, SESSIONS, NAMES))]
    return dict(zip(("requests", "sessions", "databases"), frames, strict=True))


@pytest.mark.parametrize("behind", [0, 1, 2])
def test_blocking_equals_batch_whichever_side_is_late(spark, tmp_path, behind):
    raw = streams(spark, tmp_path, behind)
    static = {**raw, "databases": spark.createDataFrame([("i", 7, "db")], "source_instance string, database_id long, name string")}
    table = FactTable(spark, TABLES["fact_blocking_snapshot"], str(tmp_path / "fact"))
    query = stream_tables(static, ingest.ingest_blocking, table, str(tmp_path / "cp"), late="4 hours")
    query.awaitTermination()
    batch = ingest.ingest_blocking(**{**landed(spark), "databases": static["databases"]})
    assert rows(table.read()) == rows(batch) and table.read().count() == 24
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 4


def test_names_of_each_poll_and_rows_without_a_name(spark, tmp_path):
    """Named rows go out at once, under the name of their own poll; unnamed ones once the watermark has passed them."""
    table = FactTable(spark, TABLES["fact_blocking_snapshot"], str(tmp_path / "fact"))
    stream_tables(streams(spark, tmp_path, 1), ingest.ingest_blocking, table, str(tmp_path / "cp"), late="1 hour").awaitTermination()
    batch = rows(ingest.ingest_blocking(**landed(spark)))
    got = rows(table.read())
    assert {r for r in batch if r[-1]} <= got <= batch
    assert {r[1] for r in got if r[-1] is None} >= {hour(0), hour(1)}


def test_sums_over_polls(spark, tmp_path):
    raw = streams(spark, tmp_path, 1, hours=5)
    raw["databases"] = spark.createDataFrame([("i", 7, "db"), ("i", 8, "other")], "source_instance string, database_id long, name string")
    table = FactTable(spark, TABLES["fact_session_sample"], str(tmp_path / "fact"))
    stream_tables(raw, ingest.ingest_sessions, table, str(tmp_path / "cp"), late="1 hour").awaitTermination()
    batch = ingest.ingest_sessions(**{**landed(spark, 5), "databases": raw["databases"]})
    got = rows(table.read())
    assert got <= rows(batch) and {r for r in rows(batch) if r[1] <= hour(2)} <= got


def test_rows_later_than_the_watermark_are_dropped(spark, tmp_path):
    for n, (asked, held) in enumerate([([0], [9]), ([9], [9]), ([10], [10]), ([], [0])]):  # the sessions of hour 0 land last
        land(spark, tmp_path / "requests", f"p{n}", [r for h in asked for r in polls(h)[0]], REQUESTS)
        land(spark, tmp_path / "sessions", f"p{n}", [r for h in held for r in polls(h)[1]], SESSIONS)
    read = lambda name, columns: event_stream(spark, str(tmp_path / name / "*"), columns, files_per_batch=1)
    names = spark.createDataFrame([("i", 7, "db")], "source_instance string, database_id long, name string")
    raw = {"requests": read("requests", REQUESTS), "sessions": read("sessions", SESSIONS), "databases": names}
    table = FactTable(spark, TABLES["fact_blocking_snapshot"], str(tmp_path / "fact"))
    stream_tables(raw, ingest.ingest_blocking, table, str(tmp_path / "cp"), late="2 hours").awaitTermination()
    assert {r.sample_time_utc for r in table.read().collect()} == {hour(9), hour(10)}


def test_unreadable_events_are_kept(spark, tmp_path):
    good = call("2024-05-01T00:00:00.000Z", "u", "p", 1, 1, 1)
    for n in range(3):
        land(spark, tmp_path / "in", f"p{n}", [("i", good), ("i", f"<event {n}"), ("j", good.replace("2024", "never"))], LOG)
    for _ in range(2):  # the second start finds nothing new
        log = event_stream(spark, str(tmp_path / "in" / "*"), LOG, files_per_batch=1)
        stream_unreadable(log, str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "bad")).groupBy("event_data").agg(F.count("*").alias("n"))
    assert {(r.event_data, r.n) for r in kept.collect()} == {(good.replace("2024", "never"), 3), *((f"<event {n}", 1) for n in range(3))}
