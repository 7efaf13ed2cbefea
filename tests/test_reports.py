from decimal import Decimal

import pytest

from gaugeworks.plans import reports
from gaugeworks.schemas import TABLES
from tests.conftest import d, dicts, rows, t

AS_OF = t("2024-06-30 12:30:00")


def frame(spark, table, data):
    return spark.createDataFrame(data, TABLES[table].columns)


def test_heatmap_uses_weekday_names_and_hours(spark):
    cpu = frame(
        spark,
        "fact_cpu",
        [("i", t("2024-01-01 05:10:00"), 40, 5, 55), ("i", t("2024-01-08 05:50:00"), 41, 5, 54),
         ("i", t("2024-01-02 05:00:00"), 10, 0, 90)],
    )
    got = rows(reports.cpu_hour_heatmap(cpu))
    assert got == {("i", "Monday", 5, 40.5), ("i", "Tuesday", 5, 10.0)}


def storage(spark, *data):
    full = [("i", d(day), "db", "dbo", name, n, kb, 1, 0) for name, day, kb, n in data]
    return frame(spark, "fact_table_storage", full)


def test_growth_edges(spark):
    facts = storage(
        spark,
        ("grown", "2024-06-30", 150, 1), ("grown", "2024-05-31", 100, 1), ("grown", "2024-06-01", 500, 1),
        ("zero", "2024-06-30", 10, 1), ("zero", "2024-01-01", 0, 1),
        ("new", "2024-06-30", 10, 1), ("new", "2024-06-29", 9, 1),
    )
    got = dicts(reports.table_growth(facts), "table_name")
    assert (got["grown"]["prior_snapshot_date"], got["grown"]["data_kb_growth"], got["grown"]["growth_pct"]) == (
        d("2024-05-31"), 50, 0.5)
    assert (got["zero"]["data_kb_growth"], got["zero"]["growth_pct"]) == (10, None)
    assert (got["new"]["prior_data_kb"], got["new"]["data_kb_growth"]) == (None, None)


def usage(spark, *data):
    full = [("i", d(day), "db", "dbo", name, seeks, scans, lookups, updates, None, None)
            for name, day, seeks, scans, lookups, updates in data]
    return frame(spark, "fact_table_usage", full)


def test_access_trend_counts_the_first_day_of_the_range_against_history(spark):
    facts = usage(
        spark,
        ("a", "2024-03-31", 0, 0, 0, 0),  # before the range: only the base of the next delta
        ("a", "2024-04-01", 10, 20, 0, 4),
        ("a", "2024-04-02", 30, 25, 5, 4),
        ("b", "2024-04-02", 7, 7, 7, 7),
    )
    got = dicts(reports.table_access_trend(facts, AS_OF), "table_name")
    assert set(got) == {"a"}
    row = got["a"]
    assert (row["total_scans"], row["total_seeks"], row["scan_ratio"]) == (25, 30, round(25 / 30, 6))
    # reads: 20 + 10 + 0 on the first day, 5 + 20 + 5 on the second
    assert (row["avg_reads_per_day"], row["avg_scans_per_day"], row["avg_writes_per_day"]) == (30.0, 12.5, 2.0)


def index_ops(spark, *data):
    return frame(spark, "fact_index_ops", data)


def finding(day, kind, name, score=None, db="db"):
    missing = kind == "missing"
    return ("i", d(day), db, kind, name, Decimal(score) if score else None, None if missing else 0,
            None if missing else 9, "x" if missing else None)


def test_index_opportunities_latest_day_over_both_kinds(spark):
    facts = index_ops(
        spark,
        finding("2024-06-29", "missing", "dbo.old", "99"),
        finding("2024-06-30", "missing", "dbo.a", "5"),
        finding("2024-06-30", "missing", "dbo.b", "5"),
        finding("2024-06-30", "missing", "dbo.c", "1"),
        finding("2024-06-30", "unused", "dbo.c.ix"),
    )
    got = dicts(reports.index_opportunities(facts), "object_name")
    assert {k: v["impact_rank"] for k, v in got.items()} == {"dbo.a": 1, "dbo.b": 1, "dbo.c": 3, "dbo.c.ix": None}


def test_tuning_candidates(spark):
    sizes = storage(
        spark,
        ("Orders", "2024-06-30", 2_000_000, 5), ("Order", "2024-06-30", 20_000, 5), ("edge", "2024-06-30", 10_240, 5),
        ("busy", "2024-06-30", 1_048_577, 5), ("large", "2024-06-30", 1_048_576, 5),
    )
    accesses = usage(
        spark, *[(n, day, 1, 1, 1, w) for n in ["busy", "large"] for day, w in [("2024-06-28", 0), ("2024-06-29", 5)]]
    )
    found = index_ops(
        spark,
        finding("2024-06-30", "missing", "dbo.Orders", "8"),
        finding("2024-06-30", "unused", "dbo.Orders.IX_1"),
        finding("2024-06-30", "unused", "dbo.Order.IX_2"),
    )
    got = [(r.table_name, r.index_issue_object, r.recommendation) for r in
           reports.tuning_candidates(sizes, accesses, found, AS_OF).collect()]
    assert sorted(got, key=repr) == sorted(
        [
            ("Orders", "dbo.Orders", "add index"),
            ("Orders", "dbo.Orders.IX_1", "drop index"),
            ("Order", "dbo.Order.IX_2", "drop index"),
            ("busy", None, "review fill factor / fragmentation"),
            ("large", None, None),
        ],
        key=repr,
    )


@pytest.mark.parametrize(
    "full, log, model, state, failures, expected",
    [
        ("2024-06-30 01:00:00", "2024-06-30 12:00:00", "FULL", "ONLINE", 0, "GREEN"),
        ("2024-06-29 12:00:00", None, "SIMPLE", "ONLINE", 0, "GREEN"),  # 24 hour boundaries: still fine
        ("2024-06-29 11:59:00", None, "SIMPLE", "ONLINE", 0, "RED"),
        (None, None, "SIMPLE", "ONLINE", 0, "RED"),
        ("2024-06-30 01:00:00", "2024-06-30 08:00:00", "FULL", "ONLINE", 0, "GREEN"),
        ("2024-06-30 01:00:00", "2024-06-30 07:59:00", "FULL", "ONLINE", 0, "AMBER"),
        ("2024-06-30 01:00:00", None, "FULL", "ONLINE", 0, "AMBER"),
        ("2024-06-30 01:00:00", None, "BULK_LOGGED", "ONLINE", 0, "GREEN"),
        ("2024-06-30 01:00:00", None, "SIMPLE", "RESTORING", 0, "RED"),
        ("2024-06-30 01:00:00", None, "SIMPLE", "ONLINE", 1, "RED"),
        ("2024-06-30 01:00:00", None, "SIMPLE", None, None, "GREEN"),  # unknown state and count fall through
    ],
)
def test_health_status(spark, full, log, model, state, failures, expected):
    facts = frame(
        spark,
        "fact_health",
        [
            ("i", d("2024-06-30"), "db", full and t(full), log and t(log), model, state, failures),
            ("i", d("2024-06-29"), "db", None, None, model, "OFFLINE", 9),
        ],
    )
    assert [r.rag_status for r in reports.health_summary(facts, AS_OF).collect()] == [expected]


def workload(spark, *data):
    full = [("i", t("2024-06-30 00:00:00"), login, program, "h", "db", 1, Decimal(cpu), Decimal(0), reads, 0, 0, None)
            for login, program, cpu, reads in data]
    return frame(spark, "fact_workload", full)


def test_workload_categories_and_logins(spark):
    facts = workload(
        spark, ("u", "SSIS-1", 5, 1), ("u", "SSIS Integration Services", 6, 1), ("v", None, 11, 2), ("w", "psql", 1, 9)
    )
    got = {r.workload_category: (r.total_cpu_ms, r.exec_count) for r in reports.workload_by_category(facts).collect()}
    assert got == {"ETL/SSIS": (11, 2), "Unknown": (12, 2)}
    ranks = {r.login_name: (r.cpu_rank, r.reads_rank) for r in reports.top_logins(facts).collect()}
    assert ranks == {"u": (1, 2), "v": (1, 2), "w": (3, 1)}


def test_io_latency_guards_the_division(spark):
    def row(at, reads, stall, writes, wstall):
        return ("i", t(at), "db", "f", "ROWS", reads, 0, stall, writes, 0, wstall, 77)

    facts = frame(
        spark,
        "fact_io_latency",
        [row("2024-06-30 00:00:00", 10, 100, 5, 50), row("2024-06-30 00:15:00", 13, 110, 5, 60)],
    )
    (got,) = reports.io_latency_deltas(facts).collect()
    assert (got.reads_delta, got.read_stall_ms_delta, got.avg_read_latency_ms) == (3, 10, round(10 / 3, 6))
    assert (got.writes_delta, got.write_stall_ms_delta, got.avg_write_latency_ms) == (0, 10, None)


def test_deadlock_reports(spark):
    facts = frame(
        spark,
        "fact_deadlock",
        [("i", t(f"2024-06-{day} 0{n}:00:00"), n, "l", "p", 2, "r", "<x/>") for day, n in [(24, 1), (24, 2), (30, 3)]],
    )
    assert "deadlock_graph_xml" not in reports.deadlock_summary(facts).columns
    assert rows(reports.deadlock_trend(facts)) == {("i", t("2024-06-24 00:00:00"), 2), ("i", t("2024-06-30 00:00:00"), 1)}
    assert rows(reports.deadlock_trend(facts, "week")) == {("i", t("2024-06-24 00:00:00"), 3)}


def test_views_are_registered_for_the_facts_at_hand(spark):
    facts = {name: frame(spark, name, []) for name in ["fact_cpu", "fact_table_storage", "fact_health"]}
    made = reports.register_views(spark, facts, AS_OF)
    assert made == ["rpt_cpu_timeline", "rpt_cpu_hour_heatmap", "rpt_table_storage_latest", "rpt_table_growth",
                    "rpt_health_summary"]
    assert spark.sql("SELECT count(*) AS n FROM rpt_health_summary").first().n == 0
