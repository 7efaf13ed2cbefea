"""Raw monitoring tables to fact rows. Every raw table carries (source_instance, snapshot_time_utc) and,
where it belongs to one database, database_name; one plan covers all instances and databases at once.

Name tables (databases, tables, objects, schemas, indexes, files, jobs) are landed like any other: with a poll time they are read
as of each row's poll, without one they hold one current row per id and instance (and database)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import settings
from gaugeworks.functions.scalar import (
    MS2,
    agent_timestamp,
    attribution_hash,
    micros_to_ms,
    statement_slice,
    truncated_mean,
)
from gaugeworks.functions.xml import (
    head_time,
    parse_cpu_records,
    parse_deadlocks,
    parse_events,
    split_deadlocks,
)
from gaugeworks.operators import exclude, names_at, topk_union
from gaugeworks.plans.live import SNAPSHOT, concurrency, user_requests, with_database_name
from gaugeworks.schemas import TABLES
from gaugeworks.sources.ledger import later, with_mark

SEQUENCE = "_polled_at"
DATABASE = ["source_instance", "database_name"]
WHO = ["login_name", "program_name", "host_name", "database_name"]


def shaped(df: DataFrame, table: str, sequenced: bool = False) -> DataFrame:
    """Exactly the table's columns, in its order and types; with the poll time too if `sequenced`, so that of several polls of
    a day the last one wins."""
    polled = [F.col("snapshot_time_utc").alias(SEQUENCE)] if sequenced else []
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in TABLES[table].types.items()], *polled)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("snapshot_date", F.to_date("snapshot_time_utc"))


def cpu_rows(samples: DataFrame) -> DataFrame:
    """CPU samples with the share of other processes, never below zero; unknown where a reading is."""
    rest = F.lit(100) - F.col("sql_cpu_pct") - F.col("idle_pct")
    other = F.when(rest.isNotNull(), F.greatest(F.lit(0), rest))
    return shaped(samples.withColumn("other_cpu_pct", other), "fact_cpu")


def ingest_cpu(ring_buffers: DataFrame, sys_info: DataFrame) -> DataFrame:
    """Per-minute CPU history from scheduler records. A record's time is the snapshot time less its age in
    ticks, cut to the minute so that overlapping polls agree."""
    records = ring_buffers.where(
        (F.col("ring_buffer_type") == "RING_BUFFER_SCHEDULER_MONITOR") & F.col("record").contains("<SystemHealth>")
    )
    clock = sys_info.select(*SNAPSHOT, "ms_ticks")
    age_us = (F.col("ms_ticks") - F.col("timestamp")) * 1000
    moment = F.timestamp_micros(F.unix_micros("snapshot_time_utc") - age_us)
    # Parsed before the join, so the join moves two numbers per record and not its XML.
    samples = parse_cpu_records(records).join(clock, SNAPSHOT)
    return cpu_rows(samples.withColumn("sample_time_utc", F.date_trunc("minute", moment)))


def ingest_waits(
    wait_stats: DataFrame, exclusions: Sequence[str] | DataFrame = settings.WAIT_EXCLUSIONS
) -> DataFrame:
    """Cumulative waits without the idle ones."""
    kept = exclude(wait_stats, "wait_type", exclusions)
    renamed = kept.withColumnsRenamed({"wait_time_ms": "wait_ms_cum", "waiting_tasks_count": "waiting_tasks_cum"})
    return shaped(renamed, "fact_wait_stats")


_QUERY = [*SNAPSHOT, "query_hash"]
_PLAN = ["source_instance", "sql_handle"]
_OFFSETS = ["statement_start_offset", "statement_end_offset"]


def _plan_sums() -> list:
    return [
        F.sum("execution_count").alias("exec_count"),
        F.sum("total_worker_time").alias("_cpu"),
        F.sum("total_elapsed_time").alias("_elapsed"),
        F.sum("total_logical_reads").alias("_reads"),
    ]


def _first_statement():
    return F.min(statement_slice(F.col("text"), *[F.col(c) for c in _OFFSETS])).alias("query_sql_text")


def _cost_columns(sums: DataFrame, *more: str) -> DataFrame:
    """Integer-division means (in microseconds, before milliseconds) and totals."""
    runs = F.col("exec_count")
    return sums.select(
        *_QUERY,
        "exec_count",
        micros_to_ms(truncated_mean(F.col("_cpu"), runs)).alias("avg_cpu_ms"),
        micros_to_ms(truncated_mean(F.col("_elapsed"), runs)).alias("avg_duration_ms"),
        truncated_mean(F.col("_reads"), runs).cast(MS2).alias("avg_logical_reads"),
        micros_to_ms(F.col("_cpu")).alias("total_cpu_ms"),
        *more,
    )


def query_costs(query_stats: DataFrame, sql_text: DataFrame) -> DataFrame:
    """Cost and alphabetically first statement of every query hash and snapshot. Plans whose text is gone
    are left out."""
    texts = sql_text.select(*_PLAN, "text").dropDuplicates(_PLAN)  # several polls hold the same text
    sums = query_stats.join(texts, _PLAN).groupBy(*_QUERY).agg(*_plan_sums(), _first_statement())
    return shaped(_cost_columns(sums, "query_sql_text"), "fact_query_perf")


def ingest_query_perf(
    query_stats: DataFrame, sql_text: DataFrame, top_n: int = settings.TOP_QUERIES
) -> DataFrame:
    """Per snapshot, the top queries by total CPU and the top ones by mean reads, each once.

    Numbers first: the top queries are picked from hash-aggregated sums, and only their statements are
    looked up, so the wide texts are never joined to, or sorted with, all plans.
    """
    known = query_stats.join(sql_text.select(*_PLAN), _PLAN, "left_semi")
    costs = _cost_columns(known.groupBy(*_QUERY).agg(*_plan_sums()), "_cpu")
    top = topk_union(costs, SNAPSHOT, ["query_hash"], ["_cpu", "avg_logical_reads"], top_n)
    named = (
        query_stats.select(*_QUERY, "sql_handle", *_OFFSETS)
        .join(top, _QUERY)
        .join(sql_text.select(*_PLAN, "text"), _PLAN)
        .groupBy(*top.columns)  # the costs ride along with their key, so `top` is used, and computed, once
        .agg(_first_statement())
    )
    return shaped(named, "fact_query_perf")


def query_perf_rows(rowset: DataFrame) -> DataFrame:
    """Collapse repeated query hashes of an already aggregated rowset; duplicates are identical rows."""
    return shaped(rowset.dropDuplicates([*SNAPSHOT, "query_hash"]), "fact_query_perf")


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined) parsed events."""
    return events.where("is_valid"), events.where(~F.col("is_valid"))


def _workload_sums(duration: Column | None = None) -> list:
    """`duration`: its sum, where it follows from the other sums."""
    return [
        F.count(F.lit(1)).alias("exec_count"),
        F.sum("cpu_time").alias("_cpu"),
        (F.sum("duration") if duration is None else duration).alias("_duration"),
        F.sum("logical_reads").alias("total_logical_reads"),
        F.sum("writes").alias("total_writes"),
        F.sum("row_count").alias("total_rows"),
    ]


def workload_columns(sums: DataFrame) -> DataFrame:
    """Finish grouped event sums: milliseconds and the hash that stands for the four names."""
    return shaped(
        sums.withColumns(
            {
                "total_cpu_ms": micros_to_ms(F.col("_cpu")),
                "total_duration_ms": micros_to_ms(F.col("_duration")),
                "attribution_hash": attribution_hash(*[F.col(c) for c in WHO]),
            }
        ),
        "fact_workload",
    )


def ingest_workload(
    event_log: DataFrame, marks: DataFrame | None = None, min_duration_ms: int | None = None
) -> DataFrame:
    """Completed-query events after each instance's mark, summed per (login, program, host, database).

    The window starts at the mark; on an instance's first run, at its earliest event. `min_duration_ms`
    drops faster queries.
    """
    return workload_rows(workload_events(event_log, marks), min_duration_ms)


def workload_events(event_log: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Parsed events after each instance's mark, usable or not (`is_valid`)."""
    log = with_mark(event_log, marks)
    if marks is not None:
        # Most of a log is older than the mark: drop that part by the opening tag, before the XML parser.
        log = later(log, head_time(F.col("event_data")), keep_unknown=True)
    return later(parse_events(log), F.col("event_time_utc"), keep_unknown=True)


def workload_rows(parsed: DataFrame, min_duration_ms: int | None = None) -> DataFrame:
    """Sums of the usable ones of parsed events, see `ingest_workload`."""
    events, _ = split_valid(parsed)
    if min_duration_ms is not None:
        events = events.where(F.col("duration") > min_duration_ms * 1000)
    sums = events.groupBy("source_instance", "mark_utc", *WHO).agg(F.min("event_time_utc").alias("_first"), *_workload_sums())
    # The earliest event per instance comes from the same sums. Both branches use all of their columns (the
    # minimum here is of whole rows, `least` below changes nothing), so that they share one shuffle and
    # events are parsed once.
    measures = [c for c in sums.columns if c not in ("source_instance", "_first")]
    starts = (
        sums.groupBy("source_instance")
        .agg(F.min(F.struct("_first", *measures)).alias("_row"))
        .select("source_instance", F.col("_row._first").alias("_start"))
    )
    windows = sums.join(starts, "source_instance").withColumn(
        "window_start_utc", F.coalesce("mark_utc", F.least("_start", "_first"))
    )
    return workload_columns(windows)


def ingest_workload_windows(events: DataFrame, width: str = "30 minutes") -> DataFrame:
    """Parsed events summed per fixed collection window instead of per run; also valid on a stream."""
    grouped = events.groupBy(F.window("event_time_utc", width), "source_instance", *WHO).agg(*_workload_sums())
    return workload_columns(grouped.withColumn("window_start_utc", F.col("window.start")))


def session_rows(requests: DataFrame) -> DataFrame:
    """Active requests summed per (login, program, host, database) and sample; missing figures count as 0."""
    sums = requests.groupBy(*SNAPSHOT, *WHO).agg(
        F.count(F.lit(1)).alias("active_requests"),
        F.sum(F.coalesce("cpu_time", F.lit(0))).alias("cpu_ms_inflight"),
        F.sum(F.coalesce("logical_reads", F.lit(0))).alias("reads_inflight"),
    )
    return shaped(sums.withColumnRenamed("snapshot_time_utc", "sample_time_utc"), "fact_session_sample")


def ingest_sessions(
    requests: DataFrame, sessions: DataFrame, databases: DataFrame, own_session_id: int | DataFrame | None = None
) -> DataFrame:
    return session_rows(with_database_name(user_requests(requests, sessions, own_session_id), databases))


def ingest_concurrency(
    sessions: DataFrame, requests: DataFrame, memory_grants: DataFrame, transactions: DataFrame
) -> DataFrame:
    figures = concurrency(sessions, requests, memory_grants, transactions)
    return shaped(figures.withColumnRenamed("snapshot_time_utc", "sample_time_utc"), "fact_concurrency")


def ingest_storage(
    partition_stats: DataFrame, tables: DataFrame, schemas: DataFrame, sequenced: bool = False
) -> DataFrame:
    """Rows and space per table. Rows count once (heap or clustered index); the data share takes in-row,
    large-object and overflow pages of all indexes, and the index share is the rest of the used pages."""
    user_tables = tables.where(~F.col("is_ms_shipped"))
    data = F.col("in_row_data_page_count") + F.col("lob_used_page_count") + F.col("row_overflow_used_page_count")
    # Partitions are summed to their object before any name is looked up.
    pages = (
        _dated(partition_stats)
        .groupBy(*SNAPSHOT, "snapshot_date", "database_name", "object_id")
        .agg(
            F.sum(F.when(F.col("index_id").isin(0, 1), F.col("row_count")).otherwise(0)).alias("row_count"),
            F.sum(data).alias("_data"),
            F.sum("used_page_count").alias("_used"),
            F.sum("reserved_page_count").alias("_reserved"),
        )
    )
    sums = (
        _table_names(pages, user_tables, schemas)
        .groupBy(*SNAPSHOT, "snapshot_date", "database_name", "schema_name", "table_name")
        .agg(*[F.sum(c).alias(c) for c in ["row_count", "_data", "_used", "_reserved"]])
    )
    return shaped(
        sums.withColumns(
            {
                "data_kb": F.col("_data") * settings.PAGE_KB,
                "index_kb": (F.col("_used") - F.col("_data")) * settings.PAGE_KB,
                "unused_kb": (F.col("_reserved") - F.col("_used")) * settings.PAGE_KB,
            }
        ),
        "fact_table_storage",
        sequenced,
    )


def _table_names(rows: DataFrame, tables: DataFrame, schemas: DataFrame) -> DataFrame:
    """Rows of known objects with table_name and schema_name."""
    found = names_at(
        rows, tables, [*DATABASE, "object_id"], {"table_name": "name", "schema_id": "schema_id"}, "inner", large=True
    )
    return names_at(found, schemas, [*DATABASE, "schema_id"], {"schema_name": "name"}, "inner")


def _object_names(rows: DataFrame, objects: DataFrame, schemas: DataFrame) -> DataFrame:
    """Rows with `_object`, the full name; NULL where it is unknown."""
    found = names_at(
        rows, objects, [*DATABASE, "object_id"], {"_name": "name", "schema_id": "schema_id"}, large=True
    )
    owned = names_at(found, schemas, [*DATABASE, "schema_id"], {"_schema": "name"})
    return owned.withColumn("_object", F.concat(F.col("_schema"), F.lit("."), F.col("_name")))


def ingest_index_ops(
    missing_details: DataFrame,
    missing_groups: DataFrame,
    missing_stats: DataFrame,
    usage_stats: DataFrame,
    indexes: DataFrame,
    objects: DataFrame,
    schemas: DataFrame,
    sequenced: bool = False,
) -> DataFrame:
    """Missing indexes with their estimated gain, and unused ones (never read, still written)."""

    def listed(column: str):
        return F.coalesce(F.col(column), F.lit(""))

    gain = F.col("avg_total_user_cost") * F.col("avg_user_impact") * (F.col("user_seeks") + F.col("user_scans"))
    missing = (
        missing_details.join(missing_groups, [*SNAPSHOT, "index_handle"])
        .join(
            missing_stats.withColumnRenamed("group_handle", "index_group_handle"),
            [*SNAPSHOT, "index_group_handle"],
        )
        .select(
            *SNAPSHOT,
            "database_name",
            "object_id",
            F.lit("missing").alias("kind"),
            F.lit(None).cast("string").alias("_index"),
            gain.cast(MS2).alias("impact_score"),
            F.lit(None).cast("long").alias("reads"),
            F.lit(None).cast("long").alias("writes"),
            F.concat(
                F.lit("EQUALITY: "),
                listed("equality_columns"),
                F.lit(" INEQUALITY: "),
                listed("inequality_columns"),
                F.lit(" INCLUDED: "),
                listed("included_columns"),
            ).alias("detail"),
        )
    )
    reads = F.col("user_seeks") + F.col("user_scans") + F.col("user_lookups")
    idle = usage_stats.where((reads == 0) & (F.col("user_updates") > 0))
    named_indexes = indexes.where(F.col("name").isNotNull())
    unused = (
        names_at(idle, named_indexes, [*DATABASE, "object_id", "index_id"], {"_index": "name"}, "inner", large=True)
        .select(
            *SNAPSHOT,
            "database_name",
            "object_id",
            F.lit("unused").alias("kind"),
            "_index",
            F.lit(None).cast(MS2).alias("impact_score"),
            reads.alias("reads"),
            F.col("user_updates").alias("writes"),
            F.lit(None).cast("string").alias("detail"),
        )
    )
    # Object names are looked up once, for both kinds of finding.
    found = _object_names(missing.unionByName(unused), objects, schemas)
    named = found.withColumn("object_name", F.concat("_object", F.when(F.col("kind") == "unused", F.concat(F.lit("."), "_index")).otherwise("")))
    return shaped(_dated(named), "fact_index_ops", sequenced)


def ingest_table_access(
    usage_stats: DataFrame, objects: DataFrame, schemas: DataFrame, sequenced: bool = False
) -> DataFrame:
    """Cumulative accesses per user table, all of its indexes together."""
    user_tables = objects.where((F.col("type") == "U") & ~F.col("is_ms_shipped"))
    last_read = F.greatest("last_user_seek", "last_user_scan", "last_user_lookup")
    per_object = (
        _dated(usage_stats)
        .groupBy("snapshot_date", *SNAPSHOT, "database_name", "object_id")
        .agg(
            F.sum("user_seeks").alias("seeks_cum"),
            F.sum("user_scans").alias("scans_cum"),
            F.sum("user_lookups").alias("lookups_cum"),
            F.sum("user_updates").alias("updates_cum"),
            F.max(last_read).alias("last_user_read_utc"),
            F.max("last_user_update").alias("last_user_update_utc"),
        )
    )
    sums = ["seeks_cum", "scans_cum", "lookups_cum", "updates_cum"]
    times = ["last_user_read_utc", "last_user_update_utc"]
    rolled = (
        _table_names(per_object, user_tables, schemas)
        .groupBy("snapshot_date", *SNAPSHOT, "database_name", "schema_name", "table_name")
        .agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in times])
    )
    return shaped(rolled, "fact_table_usage", sequenced)


def ingest_health(
    databases: DataFrame, backups: DataFrame, job_history: DataFrame, jobs: DataFrame, sequenced: bool = False
) -> DataFrame:
    """Backup times, state and failed jobs per user database and snapshot. `backups` and `job_history` are
    the histories as seen by that snapshot; times are UTC. Failed jobs of the last 24 hours are counted per
    server and repeat on each of its databases."""
    users = _dated(databases).where(F.col("database_id") > settings.LAST_SYSTEM_DATABASE_ID)
    last_backups = backups.groupBy(*SNAPSHOT, "database_name").agg(
        F.max(F.when(F.col("type") == "D", F.col("backup_finish_date"))).alias("last_full_backup_utc"),
        F.max(F.when(F.col("type") == "L", F.col("backup_finish_date"))).alias("last_log_backup_utc"),
    )
    started = agent_timestamp(F.col("run_date"), F.col("run_time"))
    failures = (
        job_history.where(
            (F.col("run_status") == 0) & (started >= F.col("snapshot_time_utc") - F.expr("INTERVAL 24 HOURS"))
        )
        .join(jobs.select("source_instance", "job_id"), ["source_instance", "job_id"], "left_semi")
        .groupBy(*SNAPSHOT)
        .agg(F.count(F.lit(1)).alias("_failures"))
    )
    joined = (
        users.withColumnRenamed("name", "database_name")
        .join(last_backups, [*SNAPSHOT, "database_name"], "left")
        .join(failures, SNAPSHOT, "left")
        .withColumn("job_failures_24h", F.coalesce("_failures", F.lit(0)))
    )
    return shaped(joined.withColumnRenamed("recovery_model_desc", "recovery_model"), "fact_health", sequenced)


def ingest_io_latency(file_stats: DataFrame, master_files: DataFrame, databases: DataFrame) -> DataFrame:
    """Cumulative IO per file of the user databases."""
    stats = file_stats.where(F.col("database_id") > settings.LAST_SYSTEM_DATABASE_ID)
    file = ["source_instance", "database_id", "file_id"]
    files = names_at(stats, master_files, file, {"logical_file_name": "name", "file_type": "type_desc"}, "inner")
    named = with_database_name(files, databases)
    counters = {
        "num_of_reads": "reads_cum",
        "num_of_bytes_read": "bytes_read_cum",
        "io_stall_read_ms": "read_stall_ms_cum",
        "num_of_writes": "writes_cum",
        "num_of_bytes_written": "bytes_written_cum",
        "io_stall_write_ms": "write_stall_ms_cum",
    }
    return shaped(named.withColumnsRenamed(counters), "fact_io_latency")


def ingest_blocking(requests: DataFrame, sessions: DataFrame, databases: DataFrame) -> DataFrame:
    """One row per blocked session and sample."""
    people = sessions.select(*SNAPSHOT, "session_id", "login_name", "program_name")
    blocked = requests.where(F.col("blocking_session_id") != 0).join(people, [*SNAPSHOT, "session_id"])
    named = with_database_name(blocked, databases)
    renamed = named.withColumnsRenamed({"snapshot_time_utc": "sample_time_utc", "wait_time": "wait_time_ms"})
    return shaped(renamed, "fact_blocking_snapshot")


def pick_event_buffers(targets: DataFrame, sessions: DataFrame) -> DataFrame:
    """The in-memory event buffer of the health session, as target_xml."""
    health = sessions.where("name = 'system_health'").select(
        *SNAPSHOT, F.col("address").alias("event_session_address")
    )
    return (
        targets.where("target_name = 'ring_buffer'")
        .join(health, [*SNAPSHOT, "event_session_address"])
        .select(*SNAPSHOT, F.col("target_data").alias("target_xml"))
    )


def ingest_deadlocks(buffers: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Deadlock reports after each instance's mark. All buffers are read; reports that several polls still
    hold collapse on upsert. The mark is applied before graphs are parsed, as most reports of a poll are old."""
    return deadlock_rows(deadlock_reports(buffers, marks))


def deadlock_reports(buffers: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Reports after each instance's mark, also those whose time cannot be read; their graphs are not parsed yet."""
    reports = split_deadlocks(buffers.select("source_instance", "target_xml"))
    return later(with_mark(reports, marks), F.col("event_time_utc"), keep_unknown=True)


def deadlock_rows(reports: DataFrame) -> DataFrame:
    return shaped(parse_deadlocks(reports), "fact_deadlock")


# Task name -> (target table, builder over named raw frames and options).
TASKS: Mapping[str, tuple] = {
    "cpu": ("fact_cpu", ingest_cpu),
    "waits": ("fact_wait_stats", ingest_waits),
    "query_perf": ("fact_query_perf", ingest_query_perf),
    "storage": ("fact_table_storage", ingest_storage),
    "index_ops": ("fact_index_ops", ingest_index_ops),
    "table_access": ("fact_table_usage", ingest_table_access),
    "health": ("fact_health", ingest_health),
    "workload": ("fact_workload", ingest_workload),
    "sessions": ("fact_session_sample", ingest_sessions),
    "concurrency": ("fact_concurrency", ingest_concurrency),
    "io_latency": ("fact_io_latency", ingest_io_latency),
    "blocking": ("fact_blocking_snapshot", ingest_blocking),
    "deadlocks": ("fact_deadlock", ingest_deadlocks),
}
# Tasks that continue after a mark: the pass that takes events in, and the one that makes facts of them.
INCREMENTAL = {"workload": (workload_events, workload_rows), "deadlocks": (deadlock_reports, deadlock_rows)}
# What tells their events apart, and whether equal ones of one log are several events (else one that several polls hold).
IDENTITY = {"workload": ("event_data", True), "deadlocks": ("deadlock_graph_xml", False)}
# Tasks whose tables keep one row per day: their builders can carry the poll time, which orders polls of one day.
DAILY = {"storage", "index_ops", "table_access", "health"}
