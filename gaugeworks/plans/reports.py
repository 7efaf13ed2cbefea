"""Reporting operators over the fact tables. Each takes and returns DataFrames; "now" is an argument."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks import settings
from gaugeworks.functions.scalar import case_label, hour_boundaries, mean, safe_ratio, wait_category
from gaugeworks.operators import (
    counter_delta,
    expand_dotted,
    first_match,
    latest_date_per_group,
    latest_per_key,
    rank_within,
)

TABLE = ["source_instance", "database_name", "schema_name", "table_name"]
FILE = ["source_instance", "database_name", "logical_file_name"]


def _moment(as_of: dt.datetime):
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def cpu_timeline(cpu: DataFrame) -> DataFrame:
    return cpu.select("source_instance", "sample_time_utc", "sql_cpu_pct", "other_cpu_pct", "idle_pct")


def cpu_hour_heatmap(cpu: DataFrame) -> DataFrame:
    """Mean CPU by weekday name and hour of day (UTC)."""
    return cpu.groupBy(
        "source_instance",
        F.date_format("sample_time_utc", "EEEE").alias("day_of_week"),
        F.hour("sample_time_utc").alias("hour_of_day"),
    ).agg(mean(F.col("sql_cpu_pct")).alias("avg_sql_cpu_pct"))


def wait_deltas(
    waits: DataFrame,
    slot: str | None = "day",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Wait time per snapshot interval, restart-safe, with its category."""
    deltas = counter_delta(
        waits,
        keys=["source_instance", "wait_type"],
        order=["snapshot_time_utc", *tie_break],
        counters={"wait_ms_cum": "wait_ms_delta"},
        slot=slot,
    )
    return deltas.select(
        "source_instance",
        "snapshot_time_utc",
        "wait_type",
        "wait_ms_delta",
        wait_category(F.col("wait_type")).alias("wait_category"),
    )


def top_queries(queries: DataFrame) -> DataFrame:
    """Queries ranked within their snapshot by mean CPU and by mean duration."""
    return rank_within(
        queries,
        ["source_instance", "snapshot_time_utc"],
        {"cpu_rank": "avg_cpu_ms", "duration_rank": "avg_duration_ms"},
    ).select(
        "source_instance",
        "snapshot_time_utc",
        "query_hash",
        "exec_count",
        "avg_cpu_ms",
        "avg_duration_ms",
        "avg_logical_reads",
        "total_cpu_ms",
        "query_sql_text",
        "cpu_rank",
        "duration_rank",
    )


def table_storage_latest(storage: DataFrame) -> DataFrame:
    """Newest size of every table."""
    sizes = ["row_count", "data_kb", "index_kb", "unused_kb"]
    newest = latest_per_key(storage.select(*TABLE, "snapshot_date", *sizes), TABLE, ["snapshot_date", *sizes])
    return newest.select(
        "source_instance", "snapshot_date", "database_name", "schema_name", "table_name", *sizes
    )


def table_growth(storage: DataFrame, days: int = settings.GROWTH_LOOKBACK_DAYS) -> DataFrame:
    """Newest size against the closest snapshot at least `days` earlier; tables without one are kept.

    Both sides come from the same history. The newest date per table is a map-side combined aggregate of
    one row per table; the history meets it in one equi join, and the aggregate that picks both rows uses
    the join's partitioning. The history is shuffled once at most.
    """
    history = storage.select(*TABLE, "snapshot_date", "data_kb")
    newest = history.groupBy(*TABLE).agg(F.max("snapshot_date").alias("_newest"))
    date = F.col("snapshot_date")
    current = date == F.col("_newest")
    earlier = date <= F.date_sub("_newest", days)
    return (
        history.join(newest, TABLE)
        .where(current | earlier)
        .groupBy(*TABLE)
        .agg(
            F.max(F.when(current, date)).alias("current_snapshot_date"),
            F.max_by(F.when(current, F.col("data_kb")), F.when(current, date)).alias("current_data_kb"),
            F.max(F.when(earlier, date)).alias("prior_snapshot_date"),
            F.max_by(F.when(earlier, F.col("data_kb")), F.when(earlier, date)).alias("prior_data_kb"),
        )
        .withColumn("data_kb_growth", F.col("current_data_kb") - F.col("prior_data_kb"))
        .withColumn("growth_pct", safe_ratio(F.col("data_kb_growth"), F.col("prior_data_kb")))
    )


def table_access_daily(usage: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Accesses per table and day from the cumulative counters. A series has one row per day, so a table's
    history is a small window group. `since` limits the output, and the shuffle, to the days from then on."""
    counters = {
        "scans_cum": "scans_day",
        "seeks_cum": "seeks_day",
        "lookups_cum": "lookups_day",
        "updates_cum": "writes_day",
    }
    deltas = counter_delta(
        usage.select(*TABLE, "snapshot_date", *counters),
        keys=TABLE,
        order=["snapshot_date"],
        counters=counters,
        since=None if since is None else F.lit(since),
    )
    return deltas.select(
        "source_instance",
        "snapshot_date",
        "database_name",
        "schema_name",
        "table_name",
        "scans_day",
        "seeks_day",
        "lookups_day",
        "writes_day",
        (F.col("scans_day") + F.col("seeks_day") + F.col("lookups_day")).alias("reads_day"),
    )


def table_access_trend(usage: DataFrame, as_of: dt.datetime, days: int = settings.TREND_DAYS) -> DataFrame:
    """Access means, totals and scan/seek ratio over the last `days` days."""
    daily = table_access_daily(usage, since=as_of.date() - dt.timedelta(days=days))
    return (
        daily.groupBy(*TABLE)
        .agg(
            mean(F.col("reads_day")).alias("avg_reads_per_day"),
            mean(F.col("scans_day")).alias("avg_scans_per_day"),
            mean(F.col("writes_day")).alias("avg_writes_per_day"),
            F.sum("scans_day").alias("total_scans"),
            F.sum("seeks_day").alias("total_seeks"),
        )
        .withColumn("scan_ratio", safe_ratio(F.col("total_scans"), F.col("total_seeks")))
    )


def index_opportunities(index_ops: DataFrame) -> DataFrame:
    """The latest day's index findings per database; only missing indexes are ranked."""
    latest = latest_date_per_group(index_ops, ["source_instance", "database_name"], "snapshot_date")
    missing = rank_within(
        latest.where("kind = 'missing'"),
        ["source_instance", "database_name", "kind"],
        {"impact_rank": "impact_score"},
    )
    others = latest.where("kind <> 'missing' OR kind IS NULL").withColumn("impact_rank", F.lit(None).cast("int"))
    return missing.unionByName(others).select(
        "source_instance",
        "snapshot_date",
        "database_name",
        "kind",
        "object_name",
        "impact_score",
        "reads",
        "writes",
        "detail",
        "impact_rank",
    )


def tuning_candidates(
    storage: DataFrame,
    usage: DataFrame,
    index_ops: DataFrame,
    as_of: dt.datetime,
    min_kb: int = settings.TUNING_MIN_KB,
    large_kb: int = settings.TUNING_LARGE_KB,
) -> DataFrame:
    """Larger tables with their access trend and one row per index finding that names them."""
    sizes = table_storage_latest(storage).where(F.col("data_kb") > min_kb)
    trend = table_access_trend(usage, as_of).select(*TABLE, "avg_reads_per_day", "avg_writes_per_day", "scan_ratio")
    latest = latest_date_per_group(index_ops, ["source_instance", "database_name"], "snapshot_date")
    issues = expand_dotted(latest, "object_name", "_table").select(
        "source_instance",
        "database_name",
        "_table",
        F.col("kind").alias("index_issue_kind"),
        F.col("object_name").alias("index_issue_object"),
        "impact_score",
        F.col("reads").alias("index_reads"),
        F.col("writes").alias("index_writes"),
        "detail",
    )
    named = F.concat_ws(".", "schema_name", "table_name")
    recommendation = case_label(
        [
            (F.col("index_issue_kind") == "missing", "add index"),
            (F.col("index_issue_kind") == "unused", "drop index"),
            (
                (F.col("avg_writes_per_day") > 0) & (F.col("data_kb") > large_kb),
                "review fill factor / fragmentation",
            ),
        ],
        default=None,
    )
    return (
        sizes.join(trend, TABLE, "left")
        .withColumn("_table", named)
        .join(issues, ["source_instance", "database_name", "_table"], "left")
        .select(
            *TABLE,
            "data_kb",
            "row_count",
            "avg_reads_per_day",
            "avg_writes_per_day",
            "scan_ratio",
            "index_issue_kind",
            "index_issue_object",
            "impact_score",
            "index_reads",
            "index_writes",
            "detail",
            recommendation.alias("recommendation"),
        )
    )


def health_summary(
    health: DataFrame,
    as_of: dt.datetime,
    full_max_age_hours: int = settings.FULL_BACKUP_MAX_AGE_HOURS,
    log_max_age_hours: int = settings.LOG_BACKUP_MAX_AGE_HOURS,
) -> DataFrame:
    """Latest health row per database with its red/amber/green status. The failed-job count is per server
    and repeats on each of its databases."""
    now = _moment(as_of)

    def stale(column: str, limit: int):
        return F.col(column).isNull() | (hour_boundaries(F.col(column), now) > limit)

    status = case_label(
        [
            (F.col("state_desc") != "ONLINE", "RED"),
            (F.col("job_failures_24h") > 0, "RED"),
            (stale("last_full_backup_utc", full_max_age_hours), "RED"),
            ((F.col("recovery_model") == "FULL") & stale("last_log_backup_utc", log_max_age_hours), "AMBER"),
        ],
        default="GREEN",
    )
    latest = latest_date_per_group(health, ["source_instance", "database_name"], "snapshot_date")
    return latest.select(
        "source_instance",
        "snapshot_date",
        "database_name",
        "recovery_model",
        "state_desc",
        "last_full_backup_utc",
        "last_log_backup_utc",
        "job_failures_24h",
        status.alias("rag_status"),
    )


def workload_by_category(
    workload: DataFrame,
    rules: DataFrame | Sequence[tuple] = settings.SEED_RULES,
    case_sensitive: bool = False,
) -> DataFrame:
    """Workload per window and category; programs that match no rule, or are NULL, count as Unknown."""
    labelled = first_match(
        workload, rules, "program_name", "workload_category", settings.UNKNOWN_CATEGORY, case_sensitive
    )
    return labelled.groupBy("source_instance", "window_start_utc", "workload_category").agg(
        F.sum("total_cpu_ms").alias("total_cpu_ms"),
        F.sum("total_logical_reads").alias("total_logical_reads"),
        F.sum("exec_count").alias("exec_count"),
    )


def top_logins(workload: DataFrame) -> DataFrame:
    """Logins by total CPU and by total reads, ranked per instance."""
    totals = workload.groupBy("source_instance", "login_name").agg(
        F.sum("total_cpu_ms").alias("total_cpu_ms"),
        F.sum("total_logical_reads").alias("total_logical_reads"),
        F.sum("exec_count").alias("exec_count"),
    )
    ranks = {"cpu_rank": "total_cpu_ms", "reads_rank": "total_logical_reads"}
    return rank_within(totals, ["source_instance"], ranks)


def io_latency_deltas(
    io: DataFrame,
    slot: str | None = "day",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Reads, writes and stall time per snapshot interval and file, with the mean latency per IO."""
    counters = {
        "reads_cum": "reads_delta",
        "read_stall_ms_cum": "read_stall_ms_delta",
        "writes_cum": "writes_delta",
        "write_stall_ms_cum": "write_stall_ms_delta",
    }
    kept = [*FILE, "snapshot_time_utc", "file_type", "size_on_disk_bytes", *counters, *tie_break]
    deltas = counter_delta(
        io.select(*kept), FILE, ["snapshot_time_utc", *tie_break], counters, slot=slot
    )
    return deltas.select(
        "source_instance",
        "snapshot_time_utc",
        "database_name",
        "logical_file_name",
        "file_type",
        "reads_delta",
        "read_stall_ms_delta",
        safe_ratio(F.col("read_stall_ms_delta"), F.col("reads_delta")).alias("avg_read_latency_ms"),
        "writes_delta",
        "write_stall_ms_delta",
        safe_ratio(F.col("write_stall_ms_delta"), F.col("writes_delta")).alias("avg_write_latency_ms"),
        "size_on_disk_bytes",
    )


def blocking_recent(blocking: DataFrame) -> DataFrame:
    return blocking.select(
        "source_instance",
        "sample_time_utc",
        "session_id",
        "blocking_session_id",
        "wait_type",
        "wait_time_ms",
        "wait_resource",
        "login_name",
        "program_name",
        "database_name",
    )


def deadlock_summary(deadlocks: DataFrame) -> DataFrame:
    return deadlocks.select(
        "source_instance",
        "event_time_utc",
        "victim_session_id",
        "victim_login",
        "victim_program",
        "process_count",
        "resource_summary",
    )


def deadlock_trend(deadlocks: DataFrame, unit: str = "day") -> DataFrame:
    """Deadlocks per instance and day (or week)."""
    period = F.date_trunc(unit, "event_time_utc").alias("period_start_utc")
    return deadlocks.groupBy("source_instance", period).agg(F.count(F.lit(1)).alias("deadlocks"))


def register_views(
    spark: SparkSession,
    facts: Mapping[str, DataFrame],
    as_of: dt.datetime,
    rules: DataFrame | Sequence[tuple] = settings.SEED_RULES,
    prefix: str = "rpt_",
    changed: str | None = None,
) -> list[str]:
    """Expose every report whose facts are given as a temporary view, for SQL users and dashboards; with `changed`, only those
    that read that table. The views keep the files that the frames had listed, see `plans.views` for such that follow them."""
    reports: dict[str, tuple[list[str], Callable[..., DataFrame]]] = {
        "cpu_timeline": (["fact_cpu"], cpu_timeline),
        "cpu_hour_heatmap": (["fact_cpu"], cpu_hour_heatmap),
        "wait_deltas": (["fact_wait_stats"], wait_deltas),
        "top_queries": (["fact_query_perf"], top_queries),
        "table_storage_latest": (["fact_table_storage"], table_storage_latest),
        "table_growth": (["fact_table_storage"], table_growth),
        "table_access_daily": (["fact_table_usage"], table_access_daily),
        "table_access_trend": (["fact_table_usage"], lambda u: table_access_trend(u, as_of)),
        "index_opportunities": (["fact_index_ops"], index_opportunities),
        "tuning_candidates": (
            ["fact_table_storage", "fact_table_usage", "fact_index_ops"],
            lambda s, u, i: tuning_candidates(s, u, i, as_of),
        ),
        "health_summary": (["fact_health"], lambda h: health_summary(h, as_of)),
        "workload_by_category": (["fact_workload"], lambda w: workload_by_category(w, rules)),
        "top_logins": (["fact_workload"], top_logins),
        "io_latency_deltas": (["fact_io_latency"], io_latency_deltas),
        "blocking_recent": (["fact_blocking_snapshot"], blocking_recent),
        "deadlock_summary": (["fact_deadlock"], deadlock_summary),
    }
    made = []
    for name, (needed, build) in reports.items():
        if all(table in facts for table in needed) and (changed is None or changed in needed):
            build(*[facts[table] for table in needed]).createOrReplaceTempView(prefix + name)
            made.append(prefix + name)
    return made
