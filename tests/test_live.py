from gaugeworks.plans import live
from tests.conftest import dicts, rows, t
from tests.test_ingest import AT, names, raw, sessions


def people(spark):
    return sessions(spark, (52, "one", "h1", "A", True), (60, "two", "h2", "B", True), (9, "sys", "h", "S", False))


def test_active_requests(spark):
    columns = "session_id int, database_id long, status string, command string, wait_type string, wait_time long, " \
        "blocking_session_id int, cpu_time long, total_elapsed_time long, logical_reads long, writes long, " \
        "granted_query_memory int, percent_complete double, sql_handle string, statement_start_offset int, " \
        "statement_end_offset int"
    requests = raw(
        spark, columns,
        (52, 5, "running", "SELECT", None, 0, 0, 1, 2, 3, 4, 10, 0.5, "h", 8, -1),
        (60, 77, "running", "SELECT", None, 0, 0, 1, 2, 3, 4, 0, 0.0, None, 0, -1),
        (9, 5, "running", "SELECT", None, 0, 0, 1, 2, 3, 4, 0, 0.0, "h", 0, -1),
    )
    texts = names(spark, "sql_handle string, text string", ("h", "go; select 1"))
    dbs = names(spark, "database_id long, name string", (5, "shop"))
    got = dicts(live.active_requests(requests, people(spark), texts, dbs), "session_id")
    assert set(got) == {52, 60}
    assert (got[52]["running_sql"], got[52]["granted_mem_kb"], got[52]["database_name"]) == ("select 1", 80, "shop")
    assert (got[60]["running_sql"], got[60]["database_name"]) == (None, None)
    mine = live.active_requests(requests, people(spark), texts, dbs, own_session_id=60)
    assert [r.session_id for r in mine.collect()] == [52]


def test_blocking_pairs(spark):
    columns = "session_id int, blocking_session_id int, wait_type string, wait_duration_ms long, resource_description string"
    tasks = raw(spark, columns, (60, 52, "LCK_M_X", 5, "k"), (60, 60, "CXPACKET", 1, None), (61, None, "W", 1, None), (61, 99, "W", 2, None))
    got = dicts(live.live_blocking(tasks, people(spark)), "blocked_spid")
    assert set(got) == {60, 61}
    assert (got[60]["blocker_spid"], got[60]["blocker_login"], got[60]["blocker_host"], got[60]["blocked_login"]) == (
        52, "one", "h1", "two")
    assert (got[61]["blocker_login"], got[61]["blocked_program"]) == (None, None)


def test_waits_of_user_sessions(spark):
    tasks = raw(spark, "session_id int, wait_type string, wait_duration_ms long", (51, "W", 5), (60, "W", 6), (50, "W", 100))
    assert rows(live.live_waits(tasks)) == {("i", AT, "W", 2, 11)}


def test_tempdb_transactions_and_schedulers(spark):
    space = raw(spark, "session_id int, user_objects_alloc_page_count long, internal_objects_alloc_page_count long",
                (52, 1, 2), (60, 0, 0), (99, 5, 5))
    assert rows(live.tempdb_by_session(space, people(spark))) == {("i", AT, 52, "one", "A", 24)}
    open_ = raw(spark, "transaction_id long, name string, transaction_begin_time timestamp", (7, "tx", t("2024-05-01 09:58:30")), (8, "tx", AT))
    owners = raw(spark, "transaction_id long, session_id int", (7, 60), (8, 99))
    assert rows(live.long_transactions(open_, owners, people(spark))) == {
        ("i", AT, 60, "two", "B", "tx", t("2024-05-01 09:58:30"), 90)}
    columns = "scheduler_id int, current_tasks_count int, runnable_tasks_count int, work_queue_count long, pending_disk_io_count int"
    assert rows(live.cpu_schedulers(raw(spark, columns, (254, 1, 2, 3, 4), (255, 1, 1, 1, 1)))) == {("i", AT, 254, 1, 2, 3, 4)}


def test_snapshots_stay_apart(spark):
    other = people(spark).selectExpr("source_instance", "snapshot_time_utc + INTERVAL 1 MINUTE AS snapshot_time_utc",
                                     "session_id", "login_name", "host_name", "program_name", "is_user_process")
    space = raw(spark, "session_id int, user_objects_alloc_page_count long, internal_objects_alloc_page_count long", (52, 1, 0))
    assert live.tempdb_by_session(space, other).count() == 0
