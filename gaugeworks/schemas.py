"""Fact tables: columns, natural key, time column, retention and landing cadence."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: str  # DDL, in table order
    key: tuple[str, ...]  # natural key; upserts match on it
    time: str  # column that dates a row; always part of the key
    retention_days: int

    @property
    def types(self) -> dict[str, str]:
        return dict(part.split(" ") for part in self.columns.split(", "))

    @property
    def names(self) -> list[str]:
        return list(self.types)


def _spec(name: str, columns: str, key: str, time: str, days: int) -> TableSpec:
    return TableSpec(name, " ".join(columns.split()), tuple(key.split()), time, days)


_TABLES = [
    _spec(
        "fact_cpu",
        """source_instance string, sample_time_utc timestamp, sql_cpu_pct short, other_cpu_pct short,
        idle_pct short""",
        "source_instance sample_time_utc",
        "sample_time_utc",
        30,
    ),
    _spec(
        "fact_wait_stats",
        """source_instance string, snapshot_time_utc timestamp, wait_type string, wait_ms_cum long,
        waiting_tasks_cum long""",
        "source_instance snapshot_time_utc wait_type",
        "snapshot_time_utc",
        30,
    ),
    _spec(
        "fact_query_perf",
        """source_instance string, snapshot_time_utc timestamp, query_hash binary, exec_count long,
        avg_cpu_ms decimal(18,2), avg_duration_ms decimal(18,2), avg_logical_reads decimal(18,2),
        total_cpu_ms decimal(18,2), query_sql_text string""",
        "source_instance snapshot_time_utc query_hash",
        "snapshot_time_utc",
        120,
    ),
    _spec(
        "fact_workload",
        """source_instance string, window_start_utc timestamp, login_name string, program_name string,
        host_name string, database_name string, exec_count long, total_cpu_ms decimal(18,2),
        total_duration_ms decimal(18,2), total_logical_reads long, total_writes long, total_rows long,
        attribution_hash binary""",
        "source_instance window_start_utc attribution_hash",
        "window_start_utc",
        120,
    ),
    _spec(
        "fact_session_sample",
        """source_instance string, sample_time_utc timestamp, login_name string, program_name string,
        host_name string, database_name string, active_requests int, cpu_ms_inflight long,
        reads_inflight long""",
        "source_instance sample_time_utc login_name program_name host_name database_name",
        "sample_time_utc",
        14,
    ),
    _spec(
        "fact_concurrency",
        """source_instance string, sample_time_utc timestamp, user_sessions int, running int, runnable int,
        suspended int, blocked int, memory_grants_pending int, longest_open_tran_sec int""",
        "source_instance sample_time_utc",
        "sample_time_utc",
        7,
    ),
    _spec(
        "fact_table_storage",
        """source_instance string, snapshot_date date, database_name string, schema_name string,
        table_name string, row_count long, data_kb long, index_kb long, unused_kb long""",
        "source_instance snapshot_date database_name schema_name table_name",
        "snapshot_date",
        365,
    ),
    _spec(
        "fact_table_usage",
        """source_instance string, snapshot_date date, database_name string, schema_name string,
        table_name string, seeks_cum long, scans_cum long, lookups_cum long, updates_cum long,
        last_user_read_utc timestamp, last_user_update_utc timestamp""",
        "source_instance snapshot_date database_name schema_name table_name",
        "snapshot_date",
        365,
    ),
    _spec(
        "fact_index_ops",
        """source_instance string, snapshot_date date, database_name string, kind string,
        object_name string, impact_score decimal(18,2), reads long, writes long, detail string""",
        "source_instance snapshot_date database_name kind object_name",
        "snapshot_date",
        365,
    ),
    _spec(
        "fact_health",
        """source_instance string, snapshot_date date, database_name string,
        last_full_backup_utc timestamp, last_log_backup_utc timestamp, recovery_model string,
        state_desc string, job_failures_24h int""",
        "source_instance snapshot_date database_name",
        "snapshot_date",
        365,
    ),
    _spec(
        "fact_io_latency",
        """source_instance string, snapshot_time_utc timestamp, database_name string,
        logical_file_name string, file_type string, reads_cum long, bytes_read_cum long,
        read_stall_ms_cum long, writes_cum long, bytes_written_cum long, write_stall_ms_cum long,
        size_on_disk_bytes long""",
        "source_instance snapshot_time_utc database_name logical_file_name",
        "snapshot_time_utc",
        30,
    ),
    _spec(
        "fact_blocking_snapshot",
        """source_instance string, sample_time_utc timestamp, session_id int, blocking_session_id int,
        wait_type string, wait_time_ms long, wait_resource string, login_name string, program_name string,
        database_name string""",
        "source_instance sample_time_utc session_id",
        "sample_time_utc",
        7,
    ),
    _spec(
        "fact_deadlock",
        """source_instance string, event_time_utc timestamp, victim_session_id int, victim_login string,
        victim_program string, process_count int, resource_summary string, deadlock_graph_xml string""",
        "source_instance event_time_utc",
        "event_time_utc",
        180,
    ),
]

TABLES: dict[str, TableSpec] = {t.name: t for t in _TABLES}

# The run ledger holds one row per run and state; readers keep the last state of each run.
RUNS = _spec(
    "collection_run",
    """run_id long, source_instance string, task string, started_at_utc timestamp, ended_at_utc timestamp,
    status string, row_count long, error_message string, high_water_utc timestamp""",
    "run_id status started_at_utc",
    "started_at_utc",
    90,
)

# Events that incremental runs took in, so that what is read again behind a mark counts once. Expires with the overlap, see `Store.purge`.
TAKEN = _spec(
    "taken_event",
    "source_instance string, task string, run_id long, event_time_utc timestamp, event_id string, n long",
    "source_instance task run_id event_id event_time_utc",
    "event_time_utc",
    2,
)

RULE_COLUMNS = "class_id int, priority int, program_like string, workload_category string, notes string"
