"""The driver's generic tables in the shapes of facts and raw monitoring tables, as whole-table plans."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks import configure
from gaugeworks.plans import ingest

AS_OF = dt.datetime(2001, 8, 2, 12, 30)  # "now" of the order-based facts
EVENTS_AS_OF = dt.datetime(2024, 1, 31, 0, 30)  # "now" of the event-based facts
INSTANCES = "array('srv-0', 'srv-1', 'srv-2', 'srv-3')"
DATABASES = "array('db_0', 'db_1', 'db_2')"

WAIT_TYPE = """CASE event_type
    WHEN 'view' THEN IF((user_id div 4) % 2 = 0, 'PAGEIOLATCH_SH', 'WRITELOG')
    WHEN 'click' THEN IF((user_id div 4) % 2 = 0, 'LCK_M_X', 'LCKXM_S')
    WHEN 'purchase' THEN IF((user_id div 4) % 2 = 0, 'CXPACKET', 'ASYNC_NETWORK_IO')
    WHEN 'signup' THEN IF((user_id div 4) % 2 = 0, 'SOS_SCHEDULER_YIELD', 'SLEEP_TASK')
    ELSE IF((user_id div 4) % 2 = 0, 'RESOURCE_SEMAPHORE', 'LAZYWRITER_SLEEP') END"""
PROGRAM = """CASE event_type WHEN 'view' THEN 'Tableau Desktop' WHEN 'click' THEN 'sqlcmd'
    WHEN 'purchase' THEN 'MyApp' WHEN 'error' THEN 'SSIS-Nightly' END"""
PART_PROGRAM = """CASE WHEN p_partkey % 7 = 0 THEN NULL
    WHEN p_name LIKE '%widget' THEN concat('Tableau ', p_name)
    WHEN p_name LIKE '%bolt' THEN concat('ssis-', p_name)
    WHEN p_name LIKE '%ring' THEN 'Microsoft Power BI'
    WHEN p_name LIKE '%gear' THEN 'python odbc'
    WHEN p_name LIKE '%plate' THEN '.Net SqlClient Data Provider'
    ELSE p_name END"""


class Shapes:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.dir = sf_dir.rstrip("/")

    def load(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        naive = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in naive})

    # ---- facts ----
    @cached_property
    def cpu_samples(self) -> DataFrame:
        return self.load("events").selectExpr(
            "concat('srv-', user_id % 4) AS source_instance",
            "ts AS sample_time_utc",
            "CAST(CAST(floor(value) AS BIGINT) % 101 AS SHORT) AS sql_cpu_pct",
            "CAST(event_id % 101 AS SHORT) AS idle_pct",
        )

    @cached_property
    def cpu(self) -> DataFrame:
        return ingest.cpu_rows(self.cpu_samples)

    @cached_property
    def waits(self) -> DataFrame:
        return self.load("events").selectExpr(
            "concat('srv-', user_id % 4) AS source_instance",
            "ts AS snapshot_time_utc",
            f"{WAIT_TYPE} AS wait_type",
            "CAST(round(value * 100) AS BIGINT) AS wait_ms_cum",
            "event_id % 1000 AS waiting_tasks_cum",
            "event_id",
        )

    @cached_property
    def io(self) -> DataFrame:
        return self.load("events").selectExpr(
            "concat('srv-', user_id % 3) AS source_instance",
            "ts AS snapshot_time_utc",
            "event_type AS database_name",
            "concat('file_', user_id % 10) AS logical_file_name",
            "IF(user_id % 10 = 9, 'LOG', 'ROWS') AS file_type",
            "CAST(round(value * 100) AS BIGINT) AS reads_cum",
            "event_id * 10 AS bytes_read_cum",
            "CAST(round(value * 37) AS BIGINT) + event_id % 50 AS read_stall_ms_cum",
            "event_id % 1000 AS writes_cum",
            "event_id * 20 AS bytes_written_cum",
            "event_id % 777 AS write_stall_ms_cum",
            "event_id * 8192 AS size_on_disk_bytes",
            "event_id",
        )

    @cached_property
    def query_perf(self) -> DataFrame:
        return ingest.query_costs(self.query_stats, self.sql_text)

    @cached_property
    def storage(self) -> DataFrame:
        sized = self.load("orders").selectExpr(
            "concat('srv-', o_custkey % 4) AS source_instance",
            "to_date(o_orderdate) AS snapshot_date",
            "concat('db_', o_custkey % 7) AS database_name",
            "'dbo' AS schema_name",
            "concat('t', o_custkey) AS table_name",
            "CAST(round(o_totalprice) AS BIGINT) AS kb",
            "o_orderkey",
        )
        return sized.groupBy(
            "source_instance", "snapshot_date", "database_name", "schema_name", "table_name"
        ).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("kb").alias("data_kb"),
            F.sum(F.col("o_orderkey") % 1000).alias("index_kb"),
            F.min(F.col("o_orderkey") % 100).alias("unused_kb"),
        )

    @cached_property
    def usage(self) -> DataFrame:
        used = self.load("lineitem").selectExpr(
            "concat('srv-', l_suppkey % 4) AS source_instance",
            "to_date(l_shipdate) AS snapshot_date",
            "concat('db_', l_suppkey % 7) AS database_name",
            "'dbo' AS schema_name",
            "concat('t', l_suppkey) AS table_name",
            "l_returnflag",
            "CAST(l_quantity AS BIGINT) AS n",
            "l_shipdate",
            "l_linestatus",
        )

        def total(condition: str):
            return F.sum(F.when(F.expr(condition), F.col("n")).otherwise(0))

        return used.groupBy(
            "source_instance", "snapshot_date", "database_name", "schema_name", "table_name"
        ).agg(
            total("l_returnflag = 'A'").alias("seeks_cum"),
            total("l_returnflag = 'N'").alias("scans_cum"),
            total("l_returnflag = 'R'").alias("lookups_cum"),
            total("l_linestatus = 'F'").alias("updates_cum"),
            F.max("l_shipdate").alias("last_user_read_utc"),
            F.min("l_shipdate").alias("last_user_update_utc"),
        )

    @cached_property
    def index_ops(self) -> DataFrame:
        found = self.load("lineitem").selectExpr(
            "concat('srv-', l_suppkey % 4) AS source_instance",
            "to_date(date_trunc('YEAR', l_shipdate)) AS snapshot_date",
            "concat('db_', l_suppkey % 7) AS database_name",
            "IF(l_returnflag = 'N', 'missing', 'unused') AS kind",
            "concat('dbo.t', l_suppkey, IF(l_returnflag = 'A', concat('.ix_', l_partkey % 3), '')) AS object_name",
            "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents",
        )
        missing = F.col("kind") == "missing"
        return (
            found.groupBy("source_instance", "snapshot_date", "database_name", "kind", "object_name")
            .agg(F.sum("cents").alias("_cents"), F.count(F.lit(1)).alias("_n"))
            .select(
                "source_instance",
                "snapshot_date",
                "database_name",
                "kind",
                "object_name",
                F.when(missing, F.col("_cents").cast("decimal(20,0)") / 100)
                .cast("decimal(18,2)")
                .alias("impact_score"),
                F.when(~missing, F.lit(0)).cast("long").alias("reads"),
                F.when(~missing, F.col("_n")).alias("writes"),
                F.when(missing, F.concat(F.lit("EQUALITY: "), F.col("object_name"))).alias("detail"),
            )
        )

    @cached_property
    def health(self) -> DataFrame:
        rows = self.load("orders").selectExpr(
            "concat('srv-', o_custkey % 4) AS source_instance",
            "to_date(date_trunc('YEAR', o_orderdate)) AS snapshot_date",
            "concat('db_', o_custkey % 97) AS database_name",
            "o_orderstatus AS s",
            "o_orderkey AS k",
            "o_orderpriority AS p",
        )
        now = int(AS_OF.replace(tzinfo=dt.timezone.utc).timestamp())

        def ago(condition: str, hours: int):
            youngest = F.min(F.when(F.expr(condition), F.col("k") % hours))
            return F.timestamp_seconds(F.lit(now) - youngest * 3600 - 1860)

        return rows.groupBy("source_instance", "snapshot_date", "database_name").agg(
            ago("s = 'F'", 48).alias("last_full_backup_utc"),
            ago("s = 'O'", 9).alias("last_log_backup_utc"),
            F.when(F.min("p") < "2", "FULL").otherwise("SIMPLE").alias("recovery_model"),
            F.when(F.min("k") % 29 == 0, "SUSPECT").otherwise("ONLINE").alias("state_desc"),
            F.count_if((F.col("s") == "P") & (F.col("k") % 5 == 0)).cast("int").alias("job_failures_24h"),
        )

    @cached_property
    def workload(self) -> DataFrame:
        # Joined and summed by the numbers that names are made of; the names would be most of what is shuffled.
        lines = self.load("lineitem").selectExpr(
            "l_partkey AS p_partkey",
            "l_suppkey",
            "to_date(date_trunc('MONTH', l_shipdate)) AS month",
            "CAST(round(l_extendedprice * 100) AS BIGINT) AS cents",
            "l_orderkey % 1000 AS logical_reads",
            "CAST(l_linenumber AS BIGINT) AS writes",
            "CAST(l_quantity AS BIGINT) AS row_count",
        )
        programs = self.load("part").selectExpr("p_partkey", f"{PART_PROGRAM} AS program_name")
        sums = (
            lines.join(programs, "p_partkey")
            .withColumn("cpu_time", F.col("cents") * 10)
            .groupBy("month", "program_name", "l_suppkey", (F.col("p_partkey") % 3).alias("database"))
            .agg(*ingest._workload_sums(duration=F.sum("row_count") * 5000))
        )
        named = sums.withColumns(
            {
                "window_start_utc": F.col("month").cast("timestamp"),
                "source_instance": F.expr("concat('srv-', l_suppkey % 4)"),
                "login_name": F.expr("concat('login_', l_suppkey)"),
                "host_name": F.expr("concat('host_', l_suppkey % 5)"),
                "database_name": F.expr("concat('db_', database)"),
            }
        )
        return ingest.workload_columns(named)

    # ---- raw tables landed per poll ----
    @cached_property
    def query_stats(self) -> DataFrame:
        return self.load("lineitem").selectExpr(
            "concat('srv-', l_partkey % 4) AS source_instance",
            "date_trunc('MONTH', l_shipdate) AS snapshot_time_utc",
            "unhex(lpad(hex(l_partkey div 8), 16, '0')) AS query_hash",
            "CAST(l_partkey AS STRING) AS sql_handle",
            "CAST(l_quantity AS BIGINT) AS execution_count",
            "CAST(round(l_extendedprice * 100) AS BIGINT) AS total_worker_time",
            "CAST(round(l_extendedprice * 150) AS BIGINT) + l_orderkey % 1000 AS total_elapsed_time",
            "l_orderkey % 100000 AS total_logical_reads",
            "2 * (l_linenumber % 4) AS statement_start_offset",
            "IF(l_linenumber % 2 = 0, -1, 2 * (l_linenumber % 4) + 2 * l_linenumber) AS statement_end_offset",
        )

    @cached_property
    def sql_text(self) -> DataFrame:
        return self.load("part").selectExpr(
            "concat('srv-', p_partkey % 4) AS source_instance",
            "CAST(p_partkey AS STRING) AS sql_handle",
            "concat('select ', p_name, ' from ', p_brand, ' where kind = ', p_type) AS text",
        )

    def _activity(self) -> DataFrame:
        return self.load("events").withColumns(
            {
                "source_instance": F.expr("concat('srv-', user_id % 4)"),
                "snapshot_time_utc": F.expr("date_trunc('HOUR', ts) + INTERVAL 1 HOUR"),
                "session_id": F.expr("CAST(event_id % 2000000000 AS INT)"),
            }
        )

    @cached_property
    def sessions(self) -> DataFrame:
        return self._activity().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "session_id",
            "concat('login_', user_id % 50) AS login_name",
            "concat('host_', user_id % 9) AS host_name",
            f"{PROGRAM} AS program_name",
            "event_type <> 'signup' AS is_user_process",
        )

    @cached_property
    def requests(self) -> DataFrame:
        return self._activity().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "session_id",
            "IF(session_id % 5 = 0, 0, session_id - session_id % 17) AS blocking_session_id",
            "user_id % 25 AS database_id",
            "CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'runnable' "
            "WHEN 'purchase' THEN 'suspended' ELSE 'background' END AS status",
            "upper(event_type) AS command",
            f"{WAIT_TYPE} AS wait_type",
            "CAST(round(value * 10) AS BIGINT) AS wait_time",
            "concat('KEY: ', event_id) AS wait_resource",
            "IF(event_id % 10 = 0, NULL, CAST(round(value * 100) AS BIGINT)) AS cpu_time",
            "CAST(round(value * 200) AS BIGINT) AS total_elapsed_time",
            "event_id * 3 AS logical_reads",
            "event_id % 13 AS writes",
            "CAST(event_id % 64 AS INT) AS granted_query_memory",
            "CAST(CAST(floor(value) AS BIGINT) % 100 AS DOUBLE) AS percent_complete",
            "CAST(user_id % 4 + 4 * (event_id % 100) AS STRING) AS sql_handle",
            "CAST(2 * (event_id % 5) AS INT) AS statement_start_offset",
            "CAST(IF(event_id % 3 = 0, -1, 2 * (event_id % 5) + 16) AS INT) AS statement_end_offset",
        )

    @cached_property
    def waiting_tasks(self) -> DataFrame:
        return self._activity().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "session_id",
            "IF(session_id % 5 = 0, NULL, session_id - session_id % 17) AS blocking_session_id",
            f"{WAIT_TYPE} AS wait_type",
            "CAST(round(value * 10) AS BIGINT) AS wait_duration_ms",
            "concat('KEY: ', event_id) AS resource_description",
        )

    @cached_property
    def memory_grants(self) -> DataFrame:
        return self._activity().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "session_id",
            "event_id * 4 AS requested_memory_kb",
            "IF(event_id % 6 = 0, NULL, event_id * 4) AS granted_memory_kb",
            "IF(event_id % 6 = 0, NULL, ts) AS grant_time",
            "CAST(event_id % 8 AS INT) AS queue_id",
            "CAST(round(value) AS BIGINT) AS wait_time_ms",
            "CAST(event_id % 16 AS INT) AS dop",
        )

    @cached_property
    def space_usage(self) -> DataFrame:
        return self._activity().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "session_id",
            "event_id % 3 AS user_objects_alloc_page_count",
            "(event_id div 3) % 2 AS internal_objects_alloc_page_count",
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return self._activity().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "event_id AS transaction_id",
            "concat('tran_', event_type) AS name",
            "timestamp_micros(unix_micros(ts) - CAST(floor(value) AS BIGINT) * 1000000) AS transaction_begin_time",
        )

    @cached_property
    def session_transactions(self) -> DataFrame:
        return self._activity().selectExpr(
            "source_instance", "snapshot_time_utc", "event_id AS transaction_id", "session_id"
        )

    @cached_property
    def schedulers(self) -> DataFrame:
        return self._activity().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "CAST((user_id * 2) % 300 AS INT) AS scheduler_id",
            "CAST(event_id % 40 AS INT) AS current_tasks_count",
            "CAST(event_id % 7 AS INT) AS runnable_tasks_count",
            "event_id % 11 AS work_queue_count",
            "CAST(event_id % 3 AS INT) AS pending_disk_io_count",
        )

    @cached_property
    def databases(self) -> DataFrame:
        """Current database names per instance."""
        return self.load("nation").selectExpr(
            f"explode({INSTANCES}) AS source_instance",
            "CAST(n_nationkey AS BIGINT) AS database_id",
            "n_name AS name",
            "IF(n_nationkey % 6 = 5, 'OFFLINE', 'ONLINE') AS state_desc",
        )

    @cached_property
    def wait_stats(self) -> DataFrame:
        return self.waits.selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "wait_type",
            "wait_ms_cum AS wait_time_ms",
            "waiting_tasks_cum AS waiting_tasks_count",
        )

    def _spread_events(self) -> DataFrame:
        """Events over all cores: their file has one split, and XML is costly to make and parse."""
        return self.load("events").repartition(self.spark.sparkContext.defaultParallelism)

    def _polls(self) -> DataFrame:
        return self._spread_events().withColumns(
            {
                "source_instance": F.expr("concat('srv-', user_id % 4)"),
                "snapshot_time_utc": F.expr("date_trunc('DAY', ts) + INTERVAL 1 DAY"),
            }
        )

    @cached_property
    def sys_info(self) -> DataFrame:
        return (
            self._polls()
            .groupBy("source_instance", "snapshot_time_utc")
            .agg(F.lit(10_000_000_000).cast("long").alias("ms_ticks"))
        )

    @cached_property
    def ring_buffers(self) -> DataFrame:
        return self._polls().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "10000000000 - (unix_micros(snapshot_time_utc) - unix_micros(ts)) div 1000 AS timestamp",
            "IF(event_type = 'error', 'RING_BUFFER_EXCEPTION', 'RING_BUFFER_SCHEDULER_MONITOR') "
            "AS ring_buffer_type",
            "concat('<Record id=\"', event_id, '\"><SchedulerMonitorEvent><SystemHealth><ProcessUtilization>', "
            "CAST(floor(value) AS BIGINT) % 101, '</ProcessUtilization><SystemIdle>', event_id % 101, "
            "'</SystemIdle></SystemHealth></SchedulerMonitorEvent></Record>') AS record",
        )

    @cached_property
    def event_log(self) -> DataFrame:
        return event_xml(self._spread_events())

    @cached_property
    def event_marks(self) -> DataFrame:
        """Two of the instances ran before: their mark is ten days after their first event's day."""
        return (
            self.load("events")
            .selectExpr("concat('srv-', user_id % 4) AS source_instance", "ts")
            .groupBy("source_instance")
            .agg(F.expr("date_trunc('DAY', min(ts)) + INTERVAL 10 DAYS").alias("mark_utc"))
            .where("source_instance IN ('srv-0', 'srv-1')")
        )

    @cached_property
    def buffers(self) -> DataFrame:
        return deadlock_xml(self._spread_events())

    # ---- storage, usage and index sources ----
    @cached_property
    def partition_stats(self) -> DataFrame:
        return self.load("lineitem").selectExpr(
            "concat('srv-', l_partkey % 4) AS source_instance",
            "date_trunc('YEAR', l_shipdate) AS snapshot_time_utc",
            "concat('db_', l_partkey % 3) AS database_name",
            "l_partkey AS object_id",
            "l_linenumber % 4 AS index_id",
            "CAST(l_quantity AS BIGINT) AS row_count",
            "l_orderkey % 50 AS in_row_data_page_count",
            "l_orderkey % 7 AS lob_used_page_count",
            "l_orderkey % 3 AS row_overflow_used_page_count",
            "l_orderkey % 90 + 60 AS used_page_count",
            "l_orderkey % 90 + 75 AS reserved_page_count",
        )

    @cached_property
    def objects(self) -> DataFrame:
        return self.load("part").selectExpr(
            "concat('srv-', p_partkey % 4) AS source_instance",
            "concat('db_', p_partkey % 3) AS database_name",
            "p_partkey AS object_id",
            "p_name AS name",
            "p_size % 5 AS schema_id",
            "IF(p_size % 9 = 0, 'V', 'U') AS type",
            "p_size % 10 = 0 AS is_ms_shipped",
        )

    @cached_property
    def schemas(self) -> DataFrame:
        placed = self.load("region").selectExpr("*", f"explode({INSTANCES}) AS source_instance")
        return placed.selectExpr(
            "source_instance",
            f"explode({DATABASES}) AS database_name",
            "r_regionkey AS schema_id",
            "r_name AS name",
        )

    @cached_property
    def indexes(self) -> DataFrame:
        placed = self.load("part").selectExpr("*", "explode(array(0, 1, 2, 3)) AS index_id")
        return placed.selectExpr(
            "concat('srv-', p_partkey % 4) AS source_instance",
            "concat('db_', p_partkey % 3) AS database_name",
            "p_partkey AS object_id",
            "index_id",
            "IF(index_id = 0, NULL, concat('ix_', p_partkey, '_', index_id)) AS name",
        )

    @cached_property
    def usage_stats(self) -> DataFrame:
        return self.load("lineitem").selectExpr(
            "concat('srv-', l_partkey % 4) AS source_instance",
            "date_trunc('YEAR', l_shipdate) AS snapshot_time_utc",
            "concat('db_', l_partkey % 3) AS database_name",
            "l_partkey AS object_id",
            "l_linenumber % 4 AS index_id",
            "IF(l_returnflag = 'A', CAST(l_quantity AS BIGINT), 0) AS user_seeks",
            "IF(l_returnflag = 'N', CAST(l_quantity AS BIGINT) div 10, 0) AS user_scans",
            "0L AS user_lookups",
            "l_orderkey % 4 AS user_updates",
            "IF(l_returnflag = 'A', l_shipdate, NULL) AS last_user_seek",
            "IF(l_returnflag = 'N', l_shipdate, NULL) AS last_user_scan",
            "CAST(NULL AS TIMESTAMP) AS last_user_lookup",
            "IF(l_orderkey % 4 > 0, l_shipdate, NULL) AS last_user_update",
        )

    def _advice(self) -> DataFrame:
        return self.load("orders").withColumns(
            {
                "source_instance": F.expr("concat('srv-', o_custkey % 4)"),
                "snapshot_time_utc": F.expr("date_trunc('YEAR', o_orderdate)"),
                "database_name": F.expr("concat('db_', o_custkey % 3)"),
            }
        )

    @cached_property
    def missing_details(self) -> DataFrame:
        return self._advice().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "database_name",
            "o_orderkey AS index_handle",
            "o_custkey AS object_id",
            "IF(o_orderkey % 3 = 0, NULL, concat('[c', o_orderkey % 12, ']')) AS equality_columns",
            "IF(o_orderkey % 2 = 0, NULL, '[d]') AS inequality_columns",
            "o_orderpriority AS included_columns",
        )

    @cached_property
    def missing_groups(self) -> DataFrame:
        return self._advice().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "o_orderkey AS index_handle",
            "o_orderkey + 1000 AS index_group_handle",
        )

    @cached_property
    def missing_stats(self) -> DataFrame:
        return self._advice().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "o_orderkey + 1000 AS group_handle",
            "round(o_totalprice) AS avg_total_user_cost",
            "CAST(o_orderkey % 100 AS DOUBLE) AS avg_user_impact",
            "o_custkey % 50 AS user_seeks",
            "1L AS user_scans",
        )

    # ---- health and file sources ----
    def _month_polls(self) -> DataFrame:
        return self.load("orders").selectExpr(
            "*",
            "concat('srv-', o_custkey % 4) AS source_instance",
            "add_months(to_date(date_trunc('MONTH', o_orderdate)), 1)::timestamp AS snapshot_time_utc",
            "CAST(o_custkey % 25 AS INT) AS n_nationkey",
        )

    @cached_property
    def database_states(self) -> DataFrame:
        polled = self._month_polls().select("source_instance", "snapshot_time_utc", "n_nationkey").distinct()
        return polled.join(self.load("nation"), "n_nationkey").selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "n_nationkey AS database_id",
            "n_name AS name",
            "IF(n_nationkey % 6 = 5, 'OFFLINE', 'ONLINE') AS state_desc",
            "IF(n_regionkey % 2 = 0, 'FULL', 'SIMPLE') AS recovery_model_desc",
        )

    @cached_property
    def backups(self) -> DataFrame:
        return self._month_polls().join(self.load("nation"), "n_nationkey").selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "n_name AS database_name",
            "CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'L' ELSE 'I' END AS type",
            "timestamp_seconds(unix_seconds(o_orderdate) + (o_orderkey % 24) * 3600) AS backup_finish_date",
        )

    @cached_property
    def job_history(self) -> DataFrame:
        second = "(o_orderkey % 86400)"
        return self._month_polls().selectExpr(
            "source_instance",
            "snapshot_time_utc",
            "CAST(o_custkey % 30 AS INT) AS job_id",
            "CAST(o_orderkey % 3 AS INT) AS run_status",
            "CAST(date_format(o_orderdate, 'yyyyMMdd') AS INT) AS run_date",
            f"CAST({second} div 3600 * 10000 + {second} div 60 % 60 * 100 + {second} % 60 AS INT) AS run_time",
        )

    @cached_property
    def jobs(self) -> DataFrame:
        return self.load("nation").selectExpr(f"explode({INSTANCES}) AS source_instance", "n_nationkey AS job_id")

    @cached_property
    def file_stats(self) -> DataFrame:
        return self.load("events").selectExpr(
            "concat('srv-', user_id % 4) AS source_instance",
            "ts AS snapshot_time_utc",
            "user_id % 25 AS database_id",
            "CAST(user_id % 3 + 1 AS INT) AS file_id",
            "CAST(round(value * 100) AS BIGINT) AS num_of_reads",
            "event_id * 10 AS num_of_bytes_read",
            "CAST(round(value * 37) AS BIGINT) AS io_stall_read_ms",
            "event_id % 1000 AS num_of_writes",
            "event_id * 20 AS num_of_bytes_written",
            "event_id % 777 AS io_stall_write_ms",
            "event_id * 8192 AS size_on_disk_bytes",
        )

    @cached_property
    def master_files(self) -> DataFrame:
        placed = self.load("nation").selectExpr("*", f"explode({INSTANCES}) AS source_instance")
        return placed.selectExpr(
            "source_instance",
            "CAST(n_nationkey AS BIGINT) AS database_id",
            "explode(array(1, 2)) AS file_id",
            "n_name",
        ).selectExpr(
            "source_instance",
            "database_id",
            "file_id",
            "concat(n_name, '_', file_id) AS name",
            "IF(file_id = 2, 'LOG', 'ROWS') AS type_desc",
        )


# The texts are made in an explode so that filters on them cannot copy their making.
ISO = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"


def event_xml(events: DataFrame) -> DataFrame:
    """Each event as the XML of a completed query, with its instance."""
    stamp = ISO.format("ts")

    def data(name: str, value: str) -> str:
        return f"'<data name=\"{name}\"><value>', {value}, '</value></data>'"

    def action(name: str, value: str) -> str:
        return f"'<action name=\"{name}\"><value>', {value}, '</value></action>'"

    parts = [
        f"'<event name=\"sql_batch_completed\" package=\"server\" timestamp=\"', {stamp}, '\">'",
        data("cpu_time", "CAST(round(value * 1000) AS BIGINT)"),
        data("duration", "CAST(round(value * 2500) AS BIGINT)"),
        data("logical_reads", "event_id % 5000"),
        data("writes", "IF(event_id % 4 = 0, '', CAST(event_id % 9 AS STRING))"),
        "IF(event_type = 'view', '', concat(" + data("row_count", "event_id % 70") + "))",
        action("server_principal_name", "concat('DOMAIN\\\\login_', user_id % 50)"),
        "IF(event_type = 'signup', '', concat("
        + action("client_app_name", "CASE event_type WHEN 'error' THEN 'A &amp; B' ELSE event_type END")
        + "))",
        action("client_hostname", "concat('host_', user_id % 9)"),
        action("database_name", "concat('db_', user_id % 3)"),
        "'</event>'",
    ]
    return events.selectExpr(
        "concat('srv-', user_id % 4) AS source_instance", f"explode(array(concat({', '.join(parts)}))) AS event_data"
    )


def deadlock_xml(events: DataFrame) -> DataFrame:
    """Each event as a buffer that holds one unrelated event and one deadlock report."""
    stamp = ISO.format("ts")
    parts = [
        "'<RingBufferTarget truncated=\"0\"><event name=\"wait_info\" package=\"server\" timestamp=\"'",
        stamp,
        "'\"><data name=\"wait_type\"><value>CXPACKET</value></data></event>'",
        "'<event name=\"xml_deadlock_report\" package=\"server\" timestamp=\"'",
        stamp,
        "'\"><data name=\"xml_report\"><value><deadlock><victim-list><victimProcess id=\"p'",
        "event_id % 3",
        "'\"/></victim-list><process-list><process id=\"p0\" spid=\"'",
        "event_id",
        "'\" loginname=\"login_0\" clientapp=\"App &lt;0&gt;\" hostname=\"h0\"><inputbuf>select 1</inputbuf></process>'",
        "'<process id=\"p1\" spid=\"'",
        "event_id + 1",
        "'\" loginname=\"login_1\" clientapp=\"App1\"/></process-list><resource-list>'",
        "IF(event_id % 4 = 0, '', concat('<keylock hobtid=\"1\" objectname=\"db.dbo.t', user_id, "
        "'\" mode=\"X\"><owner-list><owner id=\"p0\"/></owner-list><waiter-list><waiter id=\"p1\"/></waiter-list>"
        "</keylock>'))",
        "IF(event_id % 8 < 4, '', '<exchangeEvent id=\"Pipe\"/>')",
        "'</resource-list></deadlock></value></data></event></RingBufferTarget>'",
    ]
    return events.selectExpr(
        "concat('srv-', user_id % 4) AS source_instance", f"explode(array(concat({', '.join(parts)}))) AS target_xml"
    )
