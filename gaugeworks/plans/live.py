"""Point-in-time operators over landed monitoring snapshots. Every table carries (source_instance,
snapshot_time_utc); each operator works per snapshot over the whole fleet, and "now" is the snapshot time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks import settings
from gaugeworks.functions.scalar import second_boundaries, statement_slice
from gaugeworks.operators import names_at

SNAPSHOT = ["source_instance", "snapshot_time_utc"]


def with_database_name(df: DataFrame, databases: DataFrame) -> DataFrame:
    """Add database_name by id, as of the row's poll; rows whose id is unknown stay, with a NULL name."""
    return names_at(df, databases, ["source_instance", "database_id"], {"database_name": "name"})


def user_requests(
    requests: DataFrame, sessions: DataFrame, own_session_id: int | DataFrame | None = None
) -> DataFrame:
    """Requests of user sessions, without the polling session itself: one id for all instances, or a frame of
    (source_instance, snapshot_time_utc, session_id) for a fleet, where each poll has a session of its own."""
    users = sessions.where("is_user_process").select(
        *SNAPSHOT, "session_id", "login_name", "host_name", "program_name"
    )
    if isinstance(own_session_id, DataFrame):
        own = [*SNAPSHOT, "session_id"]
        requests = requests.join(own_session_id.select(*own), own, "left_anti")
    elif own_session_id is not None:
        requests = requests.where(F.col("session_id") != own_session_id)
    return requests.join(users, [*SNAPSHOT, "session_id"])


def active_requests(
    requests: DataFrame,
    sessions: DataFrame,
    sql_text: DataFrame,
    databases: DataFrame,
    own_session_id: int | DataFrame | None = None,
) -> DataFrame:
    """What runs in each snapshot: session, progress, cost so far and the running statement. Statement texts
    are keyed by (source_instance, sql_handle); a handle stands for one text, which several polls may hold."""
    running = with_database_name(user_requests(requests, sessions, own_session_id), databases)
    texts = sql_text.select("source_instance", "sql_handle", "text").dropDuplicates(["source_instance", "sql_handle"])
    return running.join(texts, ["source_instance", "sql_handle"], "left").select(
        *SNAPSHOT,
        "session_id",
        "login_name",
        "host_name",
        "program_name",
        "database_name",
        "status",
        "command",
        "wait_type",
        F.col("wait_time").alias("wait_time_ms"),
        "blocking_session_id",
        F.col("cpu_time").alias("cpu_ms"),
        F.col("total_elapsed_time").alias("elapsed_ms"),
        "logical_reads",
        "writes",
        (F.col("granted_query_memory") * settings.PAGE_KB).alias("granted_mem_kb"),
        "percent_complete",
        statement_slice(
            F.col("text"), F.col("statement_start_offset"), F.col("statement_end_offset")
        ).alias("running_sql"),
    )


def live_blocking(waiting_tasks: DataFrame, sessions: DataFrame) -> DataFrame:
    """Who blocks whom. Self-blocks (parallel tasks of one session) and unblocked tasks are dropped."""

    def people(role: str, columns: list[str]) -> DataFrame:
        renamed = [F.col(c).alias(f"{role}_{c.removesuffix('_name')}") for c in columns]
        return sessions.select(*SNAPSHOT, F.col("session_id").alias(f"{role}_spid"), *renamed)

    waiting = waiting_tasks.where(F.col("blocking_session_id") != F.col("session_id")).select(
        *SNAPSHOT,
        F.col("blocking_session_id").alias("blocker_spid"),
        F.col("session_id").alias("blocked_spid"),
        "wait_type",
        "wait_duration_ms",
        "resource_description",
    )
    blockers = people("blocker", ["login_name", "program_name", "host_name"])
    blocked = people("blocked", ["login_name", "program_name"])
    return waiting.join(blockers, [*SNAPSHOT, "blocker_spid"], "left").join(
        blocked, [*SNAPSHOT, "blocked_spid"], "left"
    )


def live_waits(waiting_tasks: DataFrame, first_session: int = settings.FIRST_USER_SESSION) -> DataFrame:
    """Tasks and total wait per wait type, user sessions only."""
    return (
        waiting_tasks.where(F.col("session_id") >= first_session)
        .groupBy(*SNAPSHOT, "wait_type")
        .agg(F.count(F.lit(1)).alias("waiting_tasks"), F.sum("wait_duration_ms").alias("total_wait_ms"))
    )


CONCURRENCY = [
    "user_sessions",
    "running",
    "runnable",
    "suspended",
    "blocked",
    "memory_grants_pending",
    "longest_open_tran_sec",
]


def concurrency(
    sessions: DataFrame, requests: DataFrame, memory_grants: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Seven figures per snapshot. The four tables contribute flag rows to one union, so there is a single
    map-side combined aggregate and no join; snapshots missing from some of the tables need no care."""

    def flags(df: DataFrame, **measures: Column) -> DataFrame:
        absent = {c: F.lit(0) for c in CONCURRENCY[:-1]} | {CONCURRENCY[-1]: F.lit(None)}
        picked = absent | measures
        return df.select(*SNAPSHOT, *[picked[c].cast("long").alias(c) for c in CONCURRENCY])

    def one_if(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    status = F.col("status")
    parts = [
        flags(sessions, user_sessions=one_if(F.col("is_user_process"))),
        flags(
            requests,
            running=one_if(status == "running"),
            runnable=one_if(status == "runnable"),
            suspended=one_if(status == "suspended"),
            blocked=one_if(F.col("blocking_session_id") != 0),
        ),
        flags(memory_grants, memory_grants_pending=one_if(F.col("grant_time").isNull())),
        flags(
            transactions,
            longest_open_tran_sec=second_boundaries(
                F.col("transaction_begin_time"), F.col("snapshot_time_utc")
            ),
        ),
    ]
    counts = [F.sum(c).cast("int").alias(c) for c in CONCURRENCY[:-1]]
    longest = F.coalesce(F.max(CONCURRENCY[-1]), F.lit(0)).cast("int").alias(CONCURRENCY[-1])
    return reduce(DataFrame.unionByName, parts).groupBy(*SNAPSHOT).agg(*counts, longest)


def concurrency_now(
    sessions: DataFrame, requests: DataFrame, memory_grants: DataFrame, transactions: DataFrame
) -> DataFrame:
    figures = concurrency(sessions, requests, memory_grants, transactions)
    return figures.withColumnsRenamed(
        {"runnable": "runnable_cpu_pressure", "suspended": "suspended_waiting"}
    )


def memory_grants(grants: DataFrame) -> DataFrame:
    return grants.select(
        *SNAPSHOT,
        "session_id",
        "requested_memory_kb",
        "granted_memory_kb",
        "grant_time",
        "queue_id",
        "wait_time_ms",
        "dop",
    )


def tempdb_by_session(space_usage: DataFrame, sessions: DataFrame) -> DataFrame:
    """Scratch space per session, sessions without any left out."""
    pages = F.col("user_objects_alloc_page_count") + F.col("internal_objects_alloc_page_count")
    used = space_usage.where(pages > 0).select(
        *SNAPSHOT, "session_id", (pages * settings.PAGE_KB).alias("tempdb_alloc_kb")
    )
    people = sessions.select(*SNAPSHOT, "session_id", "login_name", "program_name")
    return used.join(people, [*SNAPSHOT, "session_id"]).select(
        *SNAPSHOT, "session_id", "login_name", "program_name", "tempdb_alloc_kb"
    )


def long_transactions(transactions: DataFrame, owners: DataFrame, sessions: DataFrame) -> DataFrame:
    """Open transactions with their session and age."""
    people = sessions.select(*SNAPSHOT, "session_id", "login_name", "program_name")
    held = transactions.select(*SNAPSHOT, "transaction_id", "name", "transaction_begin_time")
    return (
        held.join(owners.select(*SNAPSHOT, "transaction_id", "session_id"), [*SNAPSHOT, "transaction_id"])
        .join(people, [*SNAPSHOT, "session_id"])
        .select(
            *SNAPSHOT,
            "session_id",
            "login_name",
            "program_name",
            F.col("name").alias("tran_name"),
            "transaction_begin_time",
            second_boundaries(F.col("transaction_begin_time"), F.col("snapshot_time_utc")).alias("open_seconds"),
        )
    )


def cpu_schedulers(schedulers: DataFrame, id_limit: int = settings.SCHEDULER_ID_LIMIT) -> DataFrame:
    return schedulers.where(F.col("scheduler_id") < id_limit).select(
        *SNAPSHOT,
        "scheduler_id",
        "current_tasks_count",
        "runnable_tasks_count",
        "work_queue_count",
        "pending_disk_io_count",
    )
