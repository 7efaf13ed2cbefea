"""Steps whose cost must not pile up in one task, or be paid twice, as tables grow."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.shapes import Shapes
from gaugeworks.operators import names_at
from gaugeworks.plans import ingest
from gaugeworks.sources import FactTable
from gaugeworks.sources.ledger import with_mark
from tests.test_rollups import workload

SMALL = "/root/testdata/sf0.001"


def test_events_are_not_shuffled_to_their_mark(spark, monkeypatch):
    events = spark.range(100).selectExpr("concat('srv-', id % 4) AS source_instance", "id")
    marks = events.groupBy("source_instance").agg(F.expr("timestamp_seconds(max(id))").alias("mark_utc"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = with_mark(events, marks)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_workload_is_joined_by_numbers(spark):
    plan = Shapes(spark, SMALL).workload._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join Inner", 1)
    assert "login_" in above and "login_" not in below and "host_" not in below


def test_corrections_take_the_batch_as_written(spark):
    """The sums are asked for once."""
    shapes, asked = Shapes(spark, SMALL), []

    class Once(SimpleNamespace):
        @property
        def workload(self):
            asked.append(1)
            return shapes.workload

    assert registry.rollup_after_upserts(Once(spark=spark)).count() > 0 and len(asked) == 1


def test_lines_are_shuffled_without_what_other_columns_give(spark, tmp_path):
    """Durations follow from the summed rows, and a month is a day's number."""
    line = ["id % 4 AS l_orderkey", "id % 3 AS l_partkey", "id % 2 AS l_suppkey", "1 AS l_linenumber", "IF(id = 0, NULL, id / 2) AS l_quantity", "1.5D AS l_extendedprice"]
    spark.range(12).selectExpr(*line, "timestamp'1995-01-15' + make_interval(0, id % 2) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(3).selectExpr("id AS p_partkey", "'x' AS p_name").write.parquet(f"{tmp_path}/part.parquet")
    made = Shapes(spark, str(tmp_path)).workload
    lines = made._jdf.queryExecution().optimizedPlan().toString().split("Join Inner", 1)[1]
    assert " AS duration" not in lines and " AS month" in lines and "5000" not in lines
    sums = {(str(r.window_start_utc), r.total_rows, r.total_duration_ms) for r in made.groupBy("window_start_utc").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("total_duration_ms").alias("total_duration_ms")).collect()}
    assert sums == {("1995-01-01 00:00:00", 15, 75), ("1995-02-01 00:00:00", 15, 75)}


@pytest.mark.parametrize(("build", "objects"), [(registry.rpt_views, 1), (registry.rollup_after_upserts, 3)])
def test_staged_copies_go_before_the_report(spark, monkeypatch, build, objects):
    """The copy of a view's table, and that of each round of corrections, would be as large as what they hold."""
    made, stage = [], FactTable._stage
    monkeypatch.setattr(FactTable, "_stage", lambda self, rows: made.append(self) or stage(self, rows))
    days = [dt.date(year, 5, 1) for year in (1992, 1994, 1995)]
    assert build(SimpleNamespace(spark=spark, workload=workload(spark, days))).count() == 4
    assert len({id(table) for table in made}) == objects and not any(table._staged for table in made)


@pytest.mark.parametrize(("rows_a_file", "files"), [(10, 4), (100_000, 2)])
def test_landed_parts_take_all_cores(spark, monkeypatch, rows_a_file, files):
    taken = []
    monkeypatch.setattr(registry, "FILE_ROWS", rows_a_file)
    monkeypatch.setattr(registry, "event_stream", lambda *_, files_per_batch: taken.append(files_per_batch))
    registry._landed(SimpleNamespace(spark=spark), spark.range(40).withColumn("v", F.lit(1)), "id % 2")
    assert taken == [min(files, max(2, spark.sparkContext.defaultParallelism))]


NOW = ["'i' AS source_instance", "'db' AS database_name"]
POLL = ["'i' AS source_instance", "timestamp'2024-05-01' AS snapshot_time_utc"]
AT = [*POLL, "'db' AS database_name"]


def made(spark, *columns):
    return spark.range(20).selectExpr(*columns)


def index_findings(spark, objects, owners, polled):
    details = made(spark, *AT, "id AS index_handle", "id AS object_id", "'a' equality_columns", "'b' inequality_columns", "'c' included_columns")
    groups = made(spark, *POLL, "id AS index_handle", "id AS index_group_handle")
    stats = made(spark, *POLL, "id AS group_handle", "1D avg_total_user_cost",
                 "1D avg_user_impact", "1L user_seeks", "1L user_scans")
    usage = made(spark, *AT, "id AS object_id", "2 AS index_id", "0L user_seeks", "0L user_scans", "0L user_lookups", "5L user_updates")
    indexes = made(spark, *polled, "id AS object_id", "2 AS index_id", "concat('ix_', id) AS name")
    return ingest.ingest_index_ops(details, groups, stats, usage, indexes, objects, owners)


def storage(spark, objects, owners, polled):
    pages = "in_row_data_page_count lob_used_page_count row_overflow_used_page_count used_page_count reserved_page_count"
    stats = made(spark, *AT, "id AS object_id", "1 AS index_id", "id AS row_count", *[f"1L AS {c}" for c in pages.split()])
    return ingest.ingest_storage(stats, objects, owners)


def table_access(spark, objects, owners, polled):
    moments = [f"timestamp'2024-04-01' AS last_user_{c}" for c in ("seek", "scan", "lookup", "update")]
    usage = made(spark, *AT, "id AS object_id", *[f"1L AS user_{c}" for c in ("seeks", "scans", "lookups", "updates")], *moments)
    return ingest.ingest_table_access(usage, objects, owners)


@pytest.mark.parametrize("polled", [AT, NOW], ids=["polled", "current"])
@pytest.mark.parametrize(("build", "found"), [(index_findings, 40), (storage, 20), (table_access, 20)])
def test_names_of_objects_are_not_broadcast(spark, build, found, polled):
    """Tables of one name per object or index grow with the data; a broadcast puts all of them in every task."""
    objects = spark.range(20).selectExpr(*polled, "id AS object_id", "concat('t', id) AS name", "1 AS schema_id", "'U' AS type", "false AS is_ms_shipped")
    owners = spark.range(1).selectExpr(*polled, "1 AS schema_id", "'dbo' AS name")
    df = build(spark, objects, owners, polled)
    plan = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    joins = [line for line in plan if "Join" in line and "object_id" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    assert df.count() == found


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("time", [[], ["snapshot_time_utc"]])
def test_large_name_tables_give_the_same_rows(spark, how, time):
    """Null and repeated keys, renames between polls, rows before the first poll and ids without a name."""
    df = spark.range(60).selectExpr("IF(id % 7 = 0, NULL, id % 10) AS object_id", "timestamp_seconds(id * 3600) AS snapshot_time_utc", "id")
    names = spark.range(24).selectExpr(
        "IF(id % 11 = 0, NULL, id % 8) AS object_id", "timestamp_seconds((id div 8 + 1) * 40000) AS snapshot_time_utc", "concat('n', id div 3) AS name"
    ).select("object_id", *time, "name")
    small, large = (names_at(df, names, ["object_id"], {"object_name": "name"}, how, large=x) for x in (False, True))
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty() and small.count() > 40
