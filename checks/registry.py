"""Every registered query over the driver tables, by operator name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.shapes import AS_OF, EVENTS_AS_OF, Shapes, event_xml
from gaugeworks import operators as ops
from gaugeworks import settings
from gaugeworks.functions import scalar
from gaugeworks.functions.xml import parse_events
from gaugeworks.plans import ingest, live, reports
from gaugeworks.plans.jobs import Store, run_task, seed_rules
from gaugeworks.plans.rollups import Rollups
from gaugeworks.plans.views import Views
from gaugeworks.schemas import RUNS, TABLES
from gaugeworks.session import scratch_path
from gaugeworks.sources import FactTable, in_databases, read_events, stamp
from gaugeworks.sources.ledger import after_mark, last_states, recent_runs, run_marks
from gaugeworks.streaming import event_stream, stream_counter_deltas, stream_tables, stream_workload

Query = Callable[[Shapes], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name, less the underscore that keeps it apart from an imported one."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Types that engines hand out differently in a common form: binary as hex text, dates as text, decimals
    as doubles."""
    shown = []
    for field in df.schema.fields:
        kind, value = field.dataType.typeName(), F.col(field.name)
        if kind == "binary":
            value = F.hex(value)
        elif kind == "date":
            value = value.cast("string")
        elif kind == "decimal":
            value = value.cast("double")
        shown.append(value.alias(field.name))
    return df.select(*shown)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(build(Shapes(spark, sf_dir)))

    return {name: bound(build) for name, build in QUERIES.items()}


# ---- reports ----
@query
def cpu_timeline(s):
    return reports.cpu_timeline(s.cpu)


@query
def cpu_hour_heatmap(s):
    return reports.cpu_hour_heatmap(s.cpu)


@query
def wait_deltas(s):
    return reports.wait_deltas(s.waits, slot="hour", tie_break=["event_id"])


@query
def top_queries(s):
    path = scratch_path(s.spark, "query-perf")
    s.query_perf.write.parquet(path)  # reports read facts, not the plans that make them
    return reports.top_queries(s.spark.read.schema(s.query_perf.schema).parquet(path))


@query
def table_storage_latest(s):
    return reports.table_storage_latest(s.storage)


@query
def table_growth(s):
    return reports.table_growth(s.storage)


@query
def table_access_daily(s):
    return reports.table_access_daily(s.usage)


@query
def table_access_trend(s):
    return reports.table_access_trend(s.usage, AS_OF)


@query
def index_opportunities(s):
    return reports.index_opportunities(s.index_ops)


@query
def tuning_candidates(s):
    return reports.tuning_candidates(s.storage, s.usage, s.index_ops, AS_OF, large_kb=200_000)


@query
def health_summary(s):
    return reports.health_summary(s.health, AS_OF)


@query
def workload_by_category(s):
    return reports.workload_by_category(s.workload)


@query
def top_logins(s):
    return reports.top_logins(s.workload)


@query
def io_latency_deltas(s):
    return reports.io_latency_deltas(s.io, slot="hour", tie_break=["event_id"])


@query
def blocking_recent(s):
    return reports.blocking_recent(ingest.ingest_blocking(s.requests, s.sessions, s.databases))


@query
def deadlock_summary(s):
    return reports.deadlock_summary(ingest.ingest_deadlocks(s.buffers))


@query
def deadlock_trend(s):
    return reports.deadlock_trend(ingest.ingest_deadlocks(s.buffers))


# ---- live snapshots ----
@query
def active_requests(s):
    return live.active_requests(s.requests, s.sessions, s.sql_text, s.databases, own_session_id=7)


@query
def live_blocking(s):
    return live.live_blocking(s.waiting_tasks, s.sessions)


@query
def live_waits(s):
    return live.live_waits(s.waiting_tasks)


@query
def concurrency_now(s):
    return live.concurrency_now(s.sessions, s.requests, s.memory_grants, s.transactions)


@query
def memory_grants(s):
    return live.memory_grants(s.memory_grants)


@query
def tempdb_by_session(s):
    return live.tempdb_by_session(s.space_usage, s.sessions)


@query
def long_transactions(s):
    return live.long_transactions(s.transactions, s.session_transactions, s.sessions)


@query
def cpu_schedulers(s):
    return live.cpu_schedulers(s.schedulers)


# ---- ingest ----
@query
def ingest_cpu(s):
    return ingest.ingest_cpu(s.ring_buffers, s.sys_info)


@query
def ingest_waits(s):
    return ingest.ingest_waits(s.wait_stats)


@query
def ingest_query_perf(s):
    return ingest.ingest_query_perf(s.query_stats, s.sql_text)


@query
def ingest_workload(s):
    return ingest.ingest_workload(s.event_log, s.event_marks)


@query
def ingest_sessions(s):
    return ingest.ingest_sessions(s.requests, s.sessions, s.databases)


@query
def ingest_concurrency(s):
    return ingest.ingest_concurrency(s.sessions, s.requests, s.memory_grants, s.transactions)


@query
def ingest_storage(s):
    return ingest.ingest_storage(s.partition_stats, s.objects, s.schemas)


@query
def ingest_index_ops(s):
    return ingest.ingest_index_ops(
        s.missing_details, s.missing_groups, s.missing_stats, s.usage_stats, s.indexes, s.objects, s.schemas
    )


@query
def ingest_table_access(s):
    return ingest.ingest_table_access(s.usage_stats, s.objects, s.schemas)


@query
def ingest_health(s):
    return ingest.ingest_health(s.database_states, s.backups, s.job_history, s.jobs)


@query
def ingest_io_latency(s):
    return ingest.ingest_io_latency(s.file_stats, s.master_files, s.databases)


@query
def ingest_blocking(s):
    return ingest.ingest_blocking(s.requests, s.sessions, s.databases)


@query
def ingest_deadlocks(s):
    return ingest.ingest_deadlocks(s.buffers, s.event_marks)


# ---- table maintenance ----
def _cpu_minutes(s) -> DataFrame:
    return s.cpu.withColumn("event_time", F.col("sample_time_utc")).withColumn(
        "sample_time_utc", F.date_trunc("HOUR", "sample_time_utc")
    )


def _cpu_table(s) -> FactTable:
    return FactTable(s.spark, TABLES["fact_cpu"], scratch_path(s.spark, "fact-cpu"))


@query
def upsert(s):
    """All samples by hour, then a corrected batch for the busy ones, then that batch once more."""
    table = _cpu_table(s)
    table.upsert(_cpu_minutes(s), ["event_time"])
    busy = _cpu_minutes(s).where("sql_cpu_pct >= 50").withColumn("other_cpu_pct", F.lit(0).cast("short"))
    table.upsert(busy, ["event_time"])
    table.upsert(busy, ["event_time"])
    table.discard_staged()
    return table.read()


@query
def upsert_hash_key(s):
    names = ["login_name", "program_name", "host_name", "database_name"]
    return s.workload.select(*names, "attribution_hash").distinct()


@query
def incremental_watermark(s):
    """Marks of successful runs, and the events after them per instance."""
    marks = run_marks(_runs(s), "view")
    log = s.load("events").selectExpr("concat('srv-', user_id % 4) AS source_instance", "ts", "event_id")
    return (
        after_mark(log, marks, "ts")
        .groupBy("source_instance", "mark_utc")
        .agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_event"))
    )


@query
def run_task_workload(s):
    """Two runs over the event log: a third of the half day before the first one lands after it, behind its mark."""
    store = Store(s.spark, scratch_path(s.spark, "store"))
    landed = "ts <= TIMESTAMP'2024-01-20' AND NOT (ts > TIMESTAMP'2024-01-19 12:00:00' AND event_id % 3 = 0)"
    first = event_xml(s._spread_events().where(landed))
    run_task(store, "workload", {"event_log": first}, dt.datetime(2024, 1, 20), overlap=dt.timedelta(days=2))
    run_task(store, "workload", {"event_log": s.event_log}, EVENTS_AS_OF, overlap=dt.timedelta(days=2))
    return store.table("fact_workload").read()


@query
def rollup_after_upserts(s):
    """Logins from daily sums that followed an upsert of all windows, a corrected year, the same batch again, and a purge."""
    store = Store(s.spark, scratch_path(s.spark, "store"))
    rollups, table = Rollups(store), store.table("fact_workload")
    written = table.upsert(s.workload)  # the batch as written: its sums are not worked out again
    corrected = written.where("year(window_start_utc) = 1995").withColumn("total_cpu_ms", F.col("total_cpu_ms") * 2)
    for _ in range(2):
        fixes = store.table("fact_workload")  # an object of its own: its staged copy goes before the next round, `written` stays
        fixes.upsert(corrected)
        fixes.discard_staged()
    table.purge(dt.datetime(1993, 1, 1), days=0)
    table.discard_staged()
    return rollups.report("top_logins")


@query
def stamp_(s):
    raw = s.wait_stats.drop("source_instance", "snapshot_time_utc")
    return ingest.ingest_waits(stamp(raw, "srv-x", EVENTS_AS_OF))


@query
def per_database_union(s):
    rows = live.with_database_name(s.file_stats, s.databases)
    return in_databases(rows, databases=s.databases).select(
        "source_instance", "snapshot_time_utc", "database_name", "file_id", "num_of_reads"
    )


@query
def per_database_configured(s):
    rows = live.with_database_name(s.file_stats, s.databases)
    return in_databases(rows, configured=["NATION_3", "NATION_7"]).select(
        "source_instance", "snapshot_time_utc", "database_name", "file_id", "num_of_reads"
    )


@query
def retention(s):
    """Expire everything older than ten days and a half."""
    table = _cpu_table(s)
    table.upsert(s.cpu)
    table.purge(EVENTS_AS_OF - dt.timedelta(hours=12), days=10)
    table.discard_staged()
    return table.read()


def _run_states(s) -> DataFrame:
    """One run per event: task by type, a running state and, for most, a final one."""
    started = s.load("events").selectExpr(
        "event_id AS run_id",
        "concat('srv-', user_id % 4) AS source_instance",
        "event_type AS task",
        "ts AS started_at_utc",
        "CAST(NULL AS TIMESTAMP) AS ended_at_utc",
        "'running' AS status",
        "CAST(NULL AS BIGINT) AS row_count",
        "CAST(NULL AS STRING) AS error_message",
        "CAST(NULL AS TIMESTAMP) AS high_water_utc",
        "value",
    )
    ended = started.where("value < 100").selectExpr(
        "run_id",
        "source_instance",
        "task",
        "started_at_utc",
        "started_at_utc + INTERVAL 5 SECONDS AS ended_at_utc",
        "IF(value >= 40, 'failed', 'success') AS status",
        "IF(value >= 40, NULL, CAST(round(value * 10) AS BIGINT)) AS row_count",
        "IF(value >= 40, 'persist failed', NULL) AS error_message",
        "high_water_utc",
        "value",
    )
    return started.unionByName(ended).drop("value").select(*RUNS.names)


def _runs(s) -> DataFrame:
    return last_states(_run_states(s))


@query
def run_ledger(s):
    table = FactTable(s.spark, RUNS, scratch_path(s.spark, "runs"))
    table.append(_run_states(s))
    return last_states(table.read()).drop("high_water_utc")


@query
def recent_runs_(s):
    return recent_runs(_runs(s)).select(
        "task", "source_instance", "status", "row_count", "started_at_utc", "error_message"
    )


def _two_tasks(s) -> dict:
    return {"waits": {"wait_stats": s.wait_stats}, "blocking": {"requests": s.requests, "sessions": s.sessions, "databases": s.databases}}


@query
def dry_run(s):
    """Row counts that dry runs of two tasks report."""
    store = Store(s.spark, scratch_path(s.spark, "store"))
    counts = [(task, run_task(store, task, raw, EVENTS_AS_OF, dry_run=True)) for task, raw in _two_tasks(s).items()]
    return s.spark.createDataFrame(counts, "task string, row_count long")


@query
def run_task_ledger(s):
    """What two runs leave in the ledger: a row per instance and one for the fleet."""
    store = Store(s.spark, scratch_path(s.spark, "store"))
    for task, raw in _two_tasks(s).items():
        run_task(store, task, raw, EVENTS_AS_OF)
    return store.ledger.runs().select("source_instance", "task", "status", "row_count", "started_at_utc")


@query
def rpt_views(s):
    """A report through SQL, over views that follow a store written after they were defined."""
    store = Store(s.spark, scratch_path(s.spark, "store"))
    views = Views(store, lambda: AS_OF)
    views.refresh()
    table = store.table("fact_workload")
    table.upsert(s.workload)
    table.discard_staged()
    views.close()
    return s.spark.sql("SELECT * FROM rpt_top_logins")


@query
def seed_rules_(s):
    """Every seed rule with the executions it decides."""
    decided = ops.first_match(s.workload, settings.SEED_RULES, "program_name", "class_id", label=0)
    used = decided.groupBy("class_id").agg(F.sum("exec_count").alias("exec_count"))
    rules = seed_rules(s.spark).select("class_id", "priority", "program_like", "workload_category")
    return rules.join(used, "class_id", "left")


# ---- primitives ----
@query
def counter_delta(s):
    """Deltas over series cut into days, from a given day on."""
    return ops.counter_delta(
        s.io.select("source_instance", "database_name", "snapshot_time_utc", "event_id", "reads_cum", "writes_cum"),
        ["source_instance", "database_name"],
        ["snapshot_time_utc", "event_id"],
        {"reads_cum": "reads_delta", "writes_cum": "writes_delta"},
        slot="day",
        since=F.lit("2024-01-20").cast("timestamp"),
    )


@query
def latest_per_key(s):
    orders = s.load("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return ops.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def latest_date_per_group(s):
    orders = s.load("orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return ops.latest_date_per_group(orders, ["o_custkey"], "o_orderdate")


@query
def asof_lookback(s):
    """Each customer-day against the same customer at least 90 days before."""
    days = s.storage.groupBy("table_name", "snapshot_date").agg(F.max("data_kb").alias("data_kb"))
    return ops.asof_lookback(days, days, ["table_name"], "snapshot_date", 90, ["data_kb"])


@query
def first_match(s):
    rules = [(1, 10, "%WIDGET%", "a", None), (3, 20, "red%", "b", None), (2, 20, "%bolt", "c", None)]
    parts = s.load("part").select("p_partkey", "p_name")
    return ops.first_match(parts, rules, "p_name", "label", "none")


@query
def rank_within(s):
    """Ranks per supplier."""
    lines = s.load("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    ranks = {"quantity_rank": "l_quantity", "price_rank": "l_extendedprice"}
    return ops.rank_within(lines, ["l_suppkey"], ranks)


@query
def topk_union(s):
    lines = s.load("orders").selectExpr(
        "date_trunc('MONTH', o_orderdate) AS month", "o_orderkey", "o_custkey", "o_totalprice"
    )
    return ops.topk_union(lines, ["month"], ["o_orderkey"], ["o_totalprice", "o_custkey"], 3)


@query
def safe_ratio(s):
    sums = s.usage.groupBy("table_name").agg(
        F.sum("scans_cum").alias("scans"), F.sum((F.col("seeks_cum") > 200).cast("long")).alias("busy_days")
    )
    return sums.withColumn("ratio", scalar.safe_ratio(F.col("scans"), F.col("busy_days")))


@query
def case_label(s):
    return s.waits.groupBy("wait_type", scalar.wait_category(F.col("wait_type")).alias("wait_category")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def xml_extract(s):
    return parse_events(s.event_log).drop("event_data")


@query
def statement_slice(s):
    text = ingest.query_costs(s.query_stats, s.sql_text)
    return text.groupBy("query_sql_text").agg(F.count(F.lit(1)).alias("queries"))


@query
def event_files(s):
    """Exported event logs as text files, read back by glob and summed per login."""
    folder = scratch_path(s.spark, "event-files")
    s.event_log.select("event_data").write.text(folder)
    return (
        parse_events(read_events(s.spark, f"{folder}/part-*"))
        .groupBy("login_name")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("duration").alias("duration"))
    )


@query
def exclude_anti_join(s):
    idle = s.spark.createDataFrame([(w,) for w in settings.WAIT_EXCLUSIONS], "wait_type string")
    return ingest.ingest_waits(s.wait_stats, idle)


@query
def hour_boundaries(s):
    return s.load("events").select(
        "event_id", scalar.hour_boundaries(F.col("ts"), F.lit(EVENTS_AS_OF).cast("timestamp")).alias("hours")
    )


# ---- streams, run to the end of their input ----
@query
def streaming_workload(s):
    """Events through a file stream into fact_workload by 30-minute windows."""
    table = FactTable(s.spark, TABLES["fact_workload"], scratch_path(s.spark, "fact-workload"))
    log = event_xml(_event_stream(s))
    stream_workload(log, table, scratch_path(s.spark, "stream"), late="40 days").awaitTermination()
    return table.read()


@query
def streaming_counter_deltas(s):
    """Wait counters through a file stream; with in-order input the deltas equal the batch ones."""
    stream = _event_stream(s).selectExpr(
        "concat('srv-', user_id % 4) AS source_instance",
        "event_type AS wait_type",
        "ts AS snapshot_time_utc",
        "event_id",
        "CAST(round(value * 100) AS BIGINT) AS wait_ms_cum",
    )
    out, state = scratch_path(s.spark, "deltas"), scratch_path(s.spark, "state")
    stream_counter_deltas(
        stream,
        ["source_instance", "wait_type"],
        ["snapshot_time_utc", "event_id"],
        {"wait_ms_cum": "wait_ms_delta"},
        out,
        state,
        scratch_path(s.spark, "stream"),
        slot="hour",
    ).awaitTermination()
    return s.spark.read.parquet(f"{out}/deltas").drop("batch")


WEEKS = 4
FILE_ROWS = 50_000


def _week(time: str) -> str:
    return f"least({WEEKS - 1}, greatest(0, datediff({time}, DATE'2024-01-01') div 8))"


def _landed(s, rows: DataFrame, part: str, behind: int = 0) -> DataFrame:
    """Rows in a landing folder by ascending part, read as a stream of one part per micro-batch; `behind` micro-batches late."""
    folder = scratch_path(s.spark, "landed")
    staged = scratch_path(s.spark, "parts")
    rows.withColumn("_part", F.expr(part).cast("int")).write.partitionBy("_part").parquet(staged)
    parts = s.spark.read.schema(f"{_ddl(rows)}, _part int").parquet(staged)
    last, count = parts.agg(F.max("_part"), F.count(F.lit(1))).first()
    files = max(2, min(s.spark.sparkContext.defaultParallelism, count // FILE_ROWS))  # all cores write and read a part of many rows
    for n in range(-behind, (last or 0) + 1):  # a few parts
        parts.where(F.col("_part") == n).drop("_part").repartition(files).write.parquet(f"{folder}/part={n + behind}")
    return event_stream(s.spark, f"{folder}/*", _ddl(rows), files_per_batch=files)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)


@query
def streaming_blocking(s):
    """Requests and sessions on streams of their own, by weeks; a poll's sessions land one micro-batch after its requests."""
    table = FactTable(s.spark, TABLES["fact_blocking_snapshot"], scratch_path(s.spark, "fact-blocking"))
    week = _week("snapshot_time_utc")
    raw = {"requests": _landed(s, s.requests, week), "sessions": _landed(s, s.sessions, week, behind=1), "databases": s.databases}
    stream_tables(raw, ingest.ingest_blocking, table, scratch_path(s.spark, "stream"), late="10 days").awaitTermination()
    return table.read()


@query
def streaming_io_latency(s):
    """File figures and the names of each poll's files and databases, three streams; the names of files land a micro-batch later."""
    table = FactTable(s.spark, TABLES["fact_io_latency"], scratch_path(s.spark, "fact-io"))
    week = _week("snapshot_time_utc")
    polls = s.file_stats.select("source_instance", "snapshot_time_utc", "database_id", "file_id")
    files = polls.distinct().join(s.master_files, ["source_instance", "database_id", "file_id"])
    names = polls.drop("file_id").distinct().join(s.databases.drop("state_desc"), ["source_instance", "database_id"])
    raw = {
        "file_stats": _landed(s, s.file_stats, week),
        "master_files": _landed(s, files, week, behind=1),
        "databases": _landed(s, names, week),
    }
    stream_tables(raw, ingest.ingest_io_latency, table, scratch_path(s.spark, "stream"), late="10 days").awaitTermination()
    return table.read()


@query
def streaming_workload_late(s):
    """Events by weeks; a fifth of the first days' events lands last, behind the watermark, and is dropped."""
    table = FactTable(s.spark, TABLES["fact_workload"], scratch_path(s.spark, "fact-workload"))
    events = s.load("events")
    late = "ts < TIMESTAMP'2024-01-04' AND event_id % 5 = 0"
    stream = _landed(s, events, f"IF({late}, {WEEKS}, {_week('ts')})")
    stream_workload(event_xml(stream), table, scratch_path(s.spark, "stream"), late="2 days").awaitTermination()
    return table.read()


def _event_stream(s) -> DataFrame:
    path = f"{s.dir}/events.parquet"
    rows = s.spark.read.parquet(path)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    if rows.inputFiles()[0].endswith("/events.parquet"):  # one file: a stream reads its folder
        stream = event_stream(s.spark, s.dir, columns, name_filter="events.parquet")
    else:
        stream = event_stream(s.spark, path, columns)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))
