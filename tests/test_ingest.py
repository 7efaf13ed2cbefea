from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gaugeworks.plans import ingest
from gaugeworks.sources import in_databases, stamp
from tests.conftest import d, dicts, rows, t
from tests.test_xml import event, name, number

AT = t("2024-05-01 10:00:00")
SNAP = "source_instance string, snapshot_time_utc timestamp"


def raw(spark, columns, *data):
    return spark.createDataFrame([("i", AT, *r) for r in data], f"{SNAP}, {columns}")


def names(spark, columns, *data):
    return spark.createDataFrame([("i", *r) for r in data], f"source_instance string, {columns}")


def test_cpu_other_share_is_clamped(spark):
    columns = "source_instance string, sample_time_utc timestamp, sql_cpu_pct short, idle_pct short"
    data = [("i", t(f"2024-05-01 10:0{n}:00"), a, b) for n, (a, b) in enumerate([(40, 55), (90, 5), (60, 60)])]
    got = ingest.cpu_rows(spark.createDataFrame(data, columns))
    assert [r.other_cpu_pct for r in got.orderBy("sample_time_utc").collect()] == [5, 5, 0]


def test_cpu_times_come_from_ticks_and_polls_agree(spark):
    record = (
        "<Record><SchedulerMonitorEvent><SystemHealth><ProcessUtilization>7</ProcessUtilization>"
        "<SystemIdle>80</SystemIdle></SystemHealth></SchedulerMonitorEvent></Record>"
    )
    kind = "RING_BUFFER_SCHEDULER_MONITOR"
    columns = "timestamp long, ring_buffer_type string, record string"
    buffers = raw(spark, columns, (1_000_000 - 90_000, kind, record), (1, "RING_BUFFER_OTHER", record), (2, kind, "<Record/>"))
    later = spark.createDataFrame(
        [("i", t("2024-05-01 10:01:00"), 1_000_000 - 90_000, kind, record)], f"{SNAP}, {columns}"
    )
    clock = raw(spark, "ms_ticks long", (1_000_000,)).union(
        spark.createDataFrame([("i", t("2024-05-01 10:01:00"), 1_060_020)], f"{SNAP}, ms_ticks long")
    )
    got = ingest.ingest_cpu(buffers.union(later), clock).distinct()
    assert rows(got) == {("i", t("2024-05-01 09:58:00"), 7, 13, 80)}


def test_idle_waits_are_left_out(spark):
    waits = raw(spark, "wait_type string, wait_time_ms long, waiting_tasks_count long",
                ("CXPACKET", 8, 5), ("SLEEP_TASK", 9, 9), ("WRITELOG", 3, 1))
    assert rows(ingest.ingest_waits(waits)) == {("i", AT, "CXPACKET", 8, 5), ("i", AT, "WRITELOG", 3, 1)}
    assert ingest.ingest_waits(waits, ["CXPACKET"]).count() == 2


def query_stats(spark, *data):
    columns = "query_hash binary, sql_handle string, execution_count long, total_worker_time long, " \
        "total_elapsed_time long, total_logical_reads long, statement_start_offset int, statement_end_offset int"
    return raw(spark, columns, *data)


def test_query_costs(spark):
    texts = names(spark, "sql_handle string, text string", ("h1", "select b"), ("h2", "go; select a"))
    stats = query_stats(
        spark,
        (b"\x01", "h1", 2, 10_001, 9_000, 7, 0, -1),
        (b"\x01", "h2", 1, 5_000, 3_000, 1, 8, -1),
        (b"\x02", "gone", 5, 1, 1, 1, 0, -1),
        (b"\x03", "h1", 0, 4_000, 4_000, 4, 0, 10),
    )
    got = {bytes(r.query_hash): r for r in ingest.ingest_query_perf(stats, texts).collect()}
    assert set(got) == {b"\x01", b"\x03"}
    one = got[b"\x01"]
    assert (one.exec_count, one.total_cpu_ms, one.avg_cpu_ms, one.avg_duration_ms, one.avg_logical_reads) == (
        3, Decimal("15.00"), Decimal("5.00"), Decimal("4.00"), Decimal("2.00"))
    assert one.query_sql_text == "select a"
    assert (got[b"\x03"].avg_cpu_ms, got[b"\x03"].query_sql_text) == (None, "select")


def test_top_queries_by_cpu_and_by_reads(spark):
    texts = names(spark, "sql_handle string, text string", ("h", "x"))
    stats = query_stats(spark, *[(bytes([n]), "h", 1, n * 1000, 1, 100 - n, 0, -1) for n in range(10)])
    got = {bytes(r.query_hash)[0] for r in ingest.ingest_query_perf(stats, texts, top_n=2).collect()}
    assert got == {9, 8, 0, 1}


def test_repeated_hash_collapses_and_missing_text_stays(spark):
    columns = f"{SNAP}, query_hash binary, exec_count long, avg_cpu_ms decimal(18,2), avg_duration_ms decimal(18,2), " \
        "avg_logical_reads decimal(18,2), total_cpu_ms decimal(18,2), query_sql_text string"
    row = ("i", AT, b"\x01", 100, Decimal(1), Decimal(2), Decimal(3), Decimal(4), "select 1")
    other = ("i", AT, b"\x02", 5, Decimal(1), Decimal(2), Decimal(3), Decimal(4), None)
    got = ingest.query_perf_rows(spark.createDataFrame([row, other, row], columns)).collect()
    assert sorted((bytes(r.query_hash), r.query_sql_text) for r in got) == [(b"\x01", "select 1"), (b"\x02", None)]


def log(spark, *events):
    return spark.createDataFrame([("i", e) for e in events], "source_instance string, event_data string")


def call(stamp, login, program, cpu, duration, reads):
    body = number("cpu_time", cpu) + number("duration", duration) + number("logical_reads", reads)
    body += name("server_principal_name", login)
    return event(stamp, body + (name("client_app_name", program) if program else ""))


EVENTS = [
    call("2024-05-01T00:00:00.000Z", "app", "web", 50_000, 120_000, 200),
    call("2024-05-01T00:00:05.000Z", "app", "web", 30_000, 80_000, 100),
    call("2024-04-30T23:59:00.000Z", "etl", None, 2_000_000, 5_000_000, 9),
]
MARK = "source_instance string, mark_utc timestamp"


def test_workload_first_run(spark):
    got = dicts(ingest.ingest_workload(log(spark, *EVENTS)), "login_name")
    assert set(got) == {"app", "etl"}
    app = got["app"]
    assert (app["exec_count"], app["total_cpu_ms"], app["total_duration_ms"], app["total_logical_reads"]) == (
        2, Decimal("80.00"), Decimal("200.00"), 300)
    assert got["etl"]["program_name"] is None
    assert {r["window_start_utc"] for r in got.values()} == {t("2024-04-30 23:59:00")}
    assert len(app["attribution_hash"]) == 32


def test_workload_after_a_mark(spark):
    marks = spark.createDataFrame([("i", t("2024-05-01 00:00:00"))], MARK)
    (row,) = ingest.ingest_workload(log(spark, *EVENTS), marks).collect()
    assert (row.exec_count, row.total_cpu_ms, row.window_start_utc) == (1, Decimal("30.00"), t("2024-05-01 00:00:00"))
    late = spark.createDataFrame([("i", t("2024-05-01 00:00:05"))], MARK)
    assert ingest.ingest_workload(log(spark, *EVENTS), late).count() == 0


def test_workload_marks_are_per_instance(spark):
    marks = spark.createDataFrame([("other", t("2025-01-01 00:00:00"))], MARK)
    assert ingest.ingest_workload(log(spark, *EVENTS), marks).count() == 2


def test_workload_minimum_duration_and_bad_events(spark):
    bad = event(body=number("cpu_time", "oops"))
    got = ingest.ingest_workload(log(spark, *EVENTS, bad), min_duration_ms=100).collect()
    assert sorted(r.exec_count for r in got) == [1, 1]


def sessions(spark, *data):
    return raw(spark, "session_id int, login_name string, host_name string, program_name string, is_user_process boolean", *data)


REQUEST = "session_id int, blocking_session_id int, database_id long, status string, wait_type string, " \
    "wait_time long, wait_resource string, cpu_time long, logical_reads long"


def test_sessions_sums_and_missing_figures(spark):
    people = sessions(spark, (60, "a", "h", "p", True), (61, "a", "h", "p", True), (7, "sys", "h", "p", False), (62, "me", "h", "p", True))
    requests = raw(
        spark, REQUEST,
        (60, 0, 5, "running", None, 0, None, 100, 5000), (61, 0, 5, "running", None, 0, None, None, 8000),
        (7, 0, 5, "running", None, 0, None, 1, 1), (62, 0, 5, "running", None, 0, None, 1, 1),
        (99, 0, 5, "running", None, 0, None, 1, 1),
    )
    dbs = names(spark, "database_id long, name string", (5, "shop"))
    got = rows(ingest.ingest_sessions(requests, people, dbs, own_session_id=62))
    assert got == {("i", AT, "a", "p", "h", "shop", 2, 100, 13000)}


def test_concurrency(spark):
    people = sessions(spark, (60, "a", "h", "p", True), (61, "a", "h", "p", False))
    requests = raw(spark, REQUEST, (60, 0, 5, "running", None, 0, None, 1, 1), (61, 60, 5, "suspended", None, 0, None, 1, 1),
                   (62, None, 5, None, None, 0, None, 1, 1))
    grants = raw(spark, "session_id int, grant_time timestamp", (60, AT), (61, None))
    open_ = raw(spark, "transaction_id long, transaction_begin_time timestamp", (1, t("2024-05-01 09:59:00")))
    got = rows(ingest.ingest_concurrency(people, requests, grants, open_))
    assert got == {("i", AT, 1, 1, 0, 1, 1, 1, 60)}
    none_open = rows(ingest.ingest_concurrency(people, requests, grants, open_.limit(0)))
    assert none_open == {("i", AT, 1, 1, 0, 1, 1, 1, 0)}


DB = f"{SNAP}, database_name string"


def per_db(spark, columns, *data):
    return spark.createDataFrame([("i", AT, "db", *r) for r in data], f"{DB}, {columns}")


def db_names(spark, columns, *data):
    return spark.createDataFrame([("i", "db", *r) for r in data], f"source_instance string, database_name string, {columns}")


def test_storage_pages(spark):
    stats = per_db(
        spark,
        "object_id long, index_id int, row_count long, in_row_data_page_count long, lob_used_page_count long, "
        "row_overflow_used_page_count long, used_page_count long, reserved_page_count long",
        (1, 1, 100, 10, 2, 1, 20, 30), (1, 2, 100, 5, 0, 0, 6, 8), (2, 0, 7, 1, 0, 0, 1, 1),
    )
    tables = db_names(spark, "object_id long, name string, schema_id int, is_ms_shipped boolean", (1, "Orders", 1, False), (2, "sys", 1, True))
    owners = db_names(spark, "schema_id int, name string", (1, "dbo"))
    assert rows(ingest.ingest_storage(stats, tables, owners)) == {
        ("i", d("2024-05-01"), "db", "dbo", "Orders", 100, 18 * 8, (26 - 18) * 8, (38 - 26) * 8)}


OBJECTS = "object_id long, name string, schema_id int, type string, is_ms_shipped boolean"
USAGE = "object_id long, index_id int, user_seeks long, user_scans long, user_lookups long, user_updates long, " \
    "last_user_seek timestamp, last_user_scan timestamp, last_user_lookup timestamp, last_user_update timestamp"


def test_index_findings(spark):
    details = per_db(spark, "index_handle long, object_id long, equality_columns string, inequality_columns string, included_columns string",
                     (1, 10, "[CustomerId]", None, "[OrderDate]"))
    groups = raw(spark, "index_handle long, index_group_handle long", (1, 11))
    stats = raw(spark, "group_handle long, avg_total_user_cost double, avg_user_impact double, user_seeks long, user_scans long",
                (11, 2.5, 80.0, 40, 2))
    usage = per_db(spark, USAGE, (10, 2, 0, 0, 0, 15, None, None, None, None), (10, 3, 1, 0, 0, 15, None, None, None, None),
                   (10, 4, 0, 0, 0, 0, None, None, None, None), (10, 0, 0, 0, 0, 5, None, None, None, None))
    indexes = db_names(spark, "object_id long, index_id int, name string", (10, 2, "IX_2"), (10, 3, "IX_3"), (10, 4, "IX_4"), (10, 0, None))
    objects = db_names(spark, OBJECTS, (10, "Orders", 1, "U", False))
    owners = db_names(spark, "schema_id int, name string", (1, "dbo"))
    got = rows(ingest.ingest_index_ops(details, groups, stats, usage, indexes, objects, owners))
    assert got == {
        ("i", d("2024-05-01"), "db", "missing", "dbo.Orders", Decimal("8400.00"), None, None,
         "EQUALITY: [CustomerId] INEQUALITY:  INCLUDED: [OrderDate]"),
        ("i", d("2024-05-01"), "db", "unused", "dbo.Orders.IX_2", None, 0, 15, None),
    }


def test_table_access_rolls_up_indexes(spark):
    usage = per_db(
        spark, USAGE,
        (10, 1, 5, 1, 2, 3, t("2024-04-01 00:00:00"), None, t("2024-04-03 00:00:00"), t("2024-04-04 00:00:00")),
        (10, 2, 5, 1, 2, 3, None, t("2024-04-02 00:00:00"), None, None),
        (11, 1, 9, 9, 9, 9, None, None, None, None),
    )
    objects = db_names(spark, OBJECTS, (10, "Orders", 1, "U", False), (11, "v", 1, "V", False))
    owners = db_names(spark, "schema_id int, name string", (1, "dbo"))
    assert rows(ingest.ingest_table_access(usage, objects, owners)) == {
        ("i", d("2024-05-01"), "db", "dbo", "Orders", 10, 2, 4, 6, t("2024-04-03 00:00:00"), t("2024-04-04 00:00:00"))}


def test_health(spark):
    dbs = raw(spark, "database_id int, name string, state_desc string, recovery_model_desc string",
              (5, "shop", "ONLINE", "FULL"), (6, "never", "ONLINE", "SIMPLE"), (1, "master", "ONLINE", "SIMPLE"))
    backups = raw(spark, "database_name string, type string, backup_finish_date timestamp",
                  ("shop", "D", t("2024-04-30 02:00:00")), ("shop", "D", t("2024-04-29 02:00:00")),
                  ("shop", "L", t("2024-05-01 09:00:00")), ("shop", "I", t("2024-05-01 09:30:00")))
    history = raw(spark, "job_id int, run_status int, run_date int, run_time int",
                  (1, 0, 20240430, 100000), (1, 0, 20240430, 95959), (1, 1, 20240501, 90000), (2, 0, 20240501, 90000),
                  (9, 0, 20240501, 90000))
    jobs = names(spark, "job_id int", (1,), (2,))
    got = dicts(ingest.ingest_health(dbs, backups, history, jobs), "database_name")
    assert set(got) == {"shop", "never"}
    assert (got["shop"]["last_full_backup_utc"], got["shop"]["last_log_backup_utc"]) == (
        t("2024-04-30 02:00:00"), t("2024-05-01 09:00:00"))
    assert (got["never"]["last_full_backup_utc"], got["never"]["last_log_backup_utc"]) == (None, None)
    assert [r["job_failures_24h"] for r in got.values()] == [2, 2]  # per server, repeated


def test_io_and_blocking(spark):
    dbs = names(spark, "database_id long, name string", (5, "shop"))
    files = names(spark, "database_id long, file_id int, name string, type_desc string", (5, 1, "shop_data", "ROWS"), (1, 1, "m", "ROWS"))
    stats = raw(spark, "database_id long, file_id int, num_of_reads long, num_of_bytes_read long, io_stall_read_ms long, "
                "num_of_writes long, num_of_bytes_written long, io_stall_write_ms long, size_on_disk_bytes long",
                (5, 1, 1, 2, 3, 4, 5, 6, 7), (1, 1, 1, 1, 1, 1, 1, 1, 1), (5, 9, 1, 1, 1, 1, 1, 1, 1))
    assert rows(ingest.ingest_io_latency(stats, files, dbs)) == {("i", AT, "shop", "shop_data", "ROWS", 1, 2, 3, 4, 5, 6, 7)}
    people = sessions(spark, (60, "a", "h", "p", True))
    requests = raw(spark, REQUEST, (60, 52, 5, "suspended", "LCK_M_X", 45, "KEY", 1, 1), (61, 0, 5, "running", None, 0, None, 1, 1))
    assert rows(ingest.ingest_blocking(requests, people, dbs)) == {("i", AT, 60, 52, "LCK_M_X", 45, "KEY", "a", "p", "shop")}


def test_event_buffers(spark):
    targets = raw(spark, "event_session_address string, target_name string, target_data string",
                  ("a", "ring_buffer", "<x/>"), ("a", "event_file", "no"), ("b", "ring_buffer", "no"))
    owners = raw(spark, "address string, name string", ("a", "system_health"), ("b", "mine"))
    assert rows(ingest.pick_event_buffers(targets, owners)) == {("i", AT, "<x/>")}


def test_stamp(spark):
    df = spark.range(1)
    row = stamp(df, "i", t("2024-05-01 12:00:00+02:00")).first()
    assert (row.source_instance, row.snapshot_time_utc) == ("i", AT)
    assert stamp(df, snapshot_time=AT, time_column="snapshot_date").first().snapshot_date == d("2024-05-01")


def test_database_selection(spark):
    df = spark.createDataFrame([("i", "a"), ("i", "b"), ("i", "c"), ("j", "a")], "source_instance string, database_name string")
    assert in_databases(df, configured=["b"]).count() == 1
    dbs = spark.createDataFrame(
        [("i", 5, "a", "ONLINE"), ("i", 6, "b", "OFFLINE"), ("i", 4, "c", "ONLINE")],
        "source_instance string, database_id int, name string, state_desc string",
    )
    assert rows(in_databases(df, databases=dbs)) == {("i", "a")}
    with pytest.raises(ValueError):
        in_databases(df)


def test_one_shuffle_serves_sums_and_window_starts(spark):
    many = log(spark, *EVENTS).select("source_instance", F.col("event_data"))
    df = ingest.ingest_workload(many)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_unknown_cpu_reading_leaves_the_rest_unknown(spark):
    from gaugeworks.plans.ingest import cpu_rows

    samples = spark.sql("select 'i' source_instance, timestamp'2024-05-01' sample_time_utc, cast(null as int) sql_cpu_pct, 40 idle_pct")
    assert cpu_rows(samples).first().other_cpu_pct is None
