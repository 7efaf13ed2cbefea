"""The same results in DuckDB SQL, written from the semantics and not from the Spark plans.

SHAPES holds the fact and raw shapes as common table expressions; each statement takes the ones it names.
"""

from __future__ import annotations

import re

from gaugeworks import settings

AS_OF = "TIMESTAMP '2001-08-02 12:30:00'"
EVENTS_AS_OF = "TIMESTAMP '2024-01-31 00:30:00'"
INSTANCES = "unnest(['srv-0', 'srv-1', 'srv-2', 'srv-3'])"

WAIT_TYPE = """CASE event_type
    WHEN 'view' THEN CASE WHEN (user_id // 4) % 2 = 0 THEN 'PAGEIOLATCH_SH' ELSE 'WRITELOG' END
    WHEN 'click' THEN CASE WHEN (user_id // 4) % 2 = 0 THEN 'LCK_M_X' ELSE 'LCKXM_S' END
    WHEN 'purchase' THEN CASE WHEN (user_id // 4) % 2 = 0 THEN 'CXPACKET' ELSE 'ASYNC_NETWORK_IO' END
    WHEN 'signup' THEN CASE WHEN (user_id // 4) % 2 = 0 THEN 'SOS_SCHEDULER_YIELD' ELSE 'SLEEP_TASK' END
    ELSE CASE WHEN (user_id // 4) % 2 = 0 THEN 'RESOURCE_SEMAPHORE' ELSE 'LAZYWRITER_SLEEP' END END"""
PROGRAM = """CASE event_type WHEN 'view' THEN 'Tableau Desktop' WHEN 'click' THEN 'sqlcmd'
    WHEN 'purchase' THEN 'MyApp' WHEN 'error' THEN 'SSIS-Nightly' END"""
PART_PROGRAM = """CASE WHEN p_partkey % 7 = 0 THEN NULL
    WHEN p_name LIKE '%widget' THEN 'Tableau ' || p_name
    WHEN p_name LIKE '%bolt' THEN 'ssis-' || p_name
    WHEN p_name LIKE '%ring' THEN 'Microsoft Power BI'
    WHEN p_name LIKE '%gear' THEN 'python odbc'
    WHEN p_name LIKE '%plate' THEN '.Net SqlClient Data Provider'
    ELSE p_name END"""


def wait_category() -> str:
    branches = []
    for label, pattern, names in settings.WAIT_CATEGORIES:
        tests = [f"wait_type LIKE '{pattern}' ESCAPE '\\'"] if pattern else []
        tests += [f"wait_type = '{n}'" for n in names]
        branches.append(f"WHEN {' OR '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(branches)} ELSE '{settings.OTHER_WAIT_CATEGORY}' END"


def deciding_rule(column: str) -> str:
    """The class id of the seed rule that decides a program."""
    ordered = sorted(settings.SEED_RULES, key=lambda r: (r[1], r[0]))
    return "CASE " + " ".join(f"WHEN {column} ILIKE '{r[2]}' THEN {r[0]}" for r in ordered) + " END"


RULES = "(VALUES " + ", ".join(f"({r[0]}, {r[1]}, '{r[2]}', '{r[3]}')" for r in settings.SEED_RULES)
RULES += ") rules(class_id, priority, program_like, workload_category)"
WAIT_CATEGORY = wait_category()


def cents(units: str) -> str:
    """Integer hundredths to DECIMAL(18,2)."""
    return f"CAST(CAST({units} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def us_to_ms(micros: str) -> str:
    """Microseconds (not negative) to milliseconds with two decimals, half up."""
    return cents(f"(CAST({micros} AS BIGINT) + 5) // 10")


def step(counter: str) -> str:
    """Growth of a counter since the row before in window w; a fallen counter restarted from zero."""
    before = f"lag({counter}) OVER w"
    return f"CASE WHEN {counter} < {before} THEN {counter} ELSE {counter} - {before} END"


def ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN round(CAST({top} AS DOUBLE) / {bottom}, 6) END"


def hours_between(earlier: str, later: str) -> str:
    return f"date_diff('hour', {earlier}, {later})"


SHAPES = {
    "cpu": """SELECT 'srv-' || (user_id % 4) AS source_instance, ts AS sample_time_utc,
        CAST(CAST(floor(value) AS BIGINT) % 101 AS SMALLINT) AS sql_cpu_pct,
        CAST(greatest(0, 100 - CAST(floor(value) AS BIGINT) % 101 - event_id % 101) AS SMALLINT) AS other_cpu_pct,
        CAST(event_id % 101 AS SMALLINT) AS idle_pct FROM events""",
    "waits": f"""SELECT 'srv-' || (user_id % 4) AS source_instance, ts AS snapshot_time_utc,
        {WAIT_TYPE} AS wait_type, CAST(round(value * 100) AS BIGINT) AS wait_ms_cum,
        event_id % 1000 AS waiting_tasks_cum, event_id FROM events""",
    "io": """SELECT 'srv-' || (user_id % 3) AS source_instance, ts AS snapshot_time_utc,
        event_type AS database_name, 'file_' || (user_id % 10) AS logical_file_name,
        CASE WHEN user_id % 10 = 9 THEN 'LOG' ELSE 'ROWS' END AS file_type,
        CAST(round(value * 100) AS BIGINT) AS reads_cum,
        CAST(round(value * 37) AS BIGINT) + event_id % 50 AS read_stall_ms_cum,
        event_id % 1000 AS writes_cum, event_id % 777 AS write_stall_ms_cum,
        event_id * 8192 AS size_on_disk_bytes, event_id FROM events""",
    "query_costs": f"""SELECT q.source_instance, q.snapshot_time_utc, q.query_hash,
        CAST(sum(runs) AS BIGINT) AS exec_count,
        {us_to_ms('CAST(sum(cpu) AS BIGINT) // CAST(sum(runs) AS BIGINT)')} AS avg_cpu_ms,
        {us_to_ms('CAST(sum(elapsed) AS BIGINT) // CAST(sum(runs) AS BIGINT)')} AS avg_duration_ms,
        CAST(CAST(sum(reads) AS BIGINT) // CAST(sum(runs) AS BIGINT) AS DECIMAL(18,2)) AS avg_logical_reads,
        {us_to_ms('sum(cpu)')} AS total_cpu_ms, CAST(sum(cpu) AS BIGINT) AS cpu_us,
        min(substring(t.text, first // 2 + 1,
            (CASE WHEN last = -1 THEN 2 * length(t.text) ELSE last END - first) // 2 + 1)) AS query_sql_text
        FROM (SELECT 'srv-' || (l_partkey % 4) AS source_instance,
                date_trunc('month', l_shipdate)::TIMESTAMP AS snapshot_time_utc,
                printf('%016X', l_partkey // 8) AS query_hash, CAST(l_partkey AS VARCHAR) AS sql_handle,
                CAST(l_quantity AS BIGINT) AS runs, CAST(round(l_extendedprice * 100) AS BIGINT) AS cpu,
                CAST(round(l_extendedprice * 150) AS BIGINT) + l_orderkey % 1000 AS elapsed,
                l_orderkey % 100000 AS reads, 2 * (l_linenumber % 4) AS first,
                CASE WHEN l_linenumber % 2 = 0 THEN -1
                     ELSE 2 * (l_linenumber % 4) + 2 * l_linenumber END AS last FROM lineitem) q
        JOIN texts t ON t.source_instance = q.source_instance AND t.sql_handle = q.sql_handle
        GROUP BY ALL""",
    "texts": """SELECT 'srv-' || (p_partkey % 4) AS source_instance, CAST(p_partkey AS VARCHAR) AS sql_handle,
        'select ' || p_name || ' from ' || p_brand || ' where kind = ' || p_type AS text FROM part""",
    "storage": """SELECT 'srv-' || (o_custkey % 4) AS source_instance, CAST(o_orderdate AS DATE) AS snapshot_date,
        'db_' || (o_custkey % 7) AS database_name, 'dbo' AS schema_name, 't' || o_custkey AS table_name,
        count(*) AS row_count, max(CAST(round(o_totalprice) AS BIGINT)) AS data_kb,
        CAST(sum(o_orderkey % 1000) AS BIGINT) AS index_kb, min(o_orderkey % 100) AS unused_kb
        FROM orders GROUP BY ALL""",
    "storage_latest": """SELECT s.* FROM storage s JOIN (SELECT source_instance, database_name, table_name,
          max(snapshot_date) AS d FROM storage GROUP BY ALL) m
        ON m.source_instance = s.source_instance AND m.database_name = s.database_name
        AND m.table_name = s.table_name AND m.d = s.snapshot_date""",
    "usage": """SELECT 'srv-' || (l_suppkey % 4) AS source_instance, CAST(l_shipdate AS DATE) AS snapshot_date,
        'db_' || (l_suppkey % 7) AS database_name, 'dbo' AS schema_name, 't' || l_suppkey AS table_name,
        CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'A'), 0) AS BIGINT) AS seeks_cum,
        CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'N'), 0) AS BIGINT) AS scans_cum,
        CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS lookups_cum,
        CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_linestatus = 'F'), 0) AS BIGINT) AS updates_cum
        FROM lineitem GROUP BY ALL""",
    "access_daily": f"""SELECT source_instance, snapshot_date, database_name, schema_name, table_name,
        {step('scans_cum')} AS scans_day, {step('seeks_cum')} AS seeks_day, {step('lookups_cum')} AS lookups_day,
        {step('updates_cum')} AS writes_day, scans_day + seeks_day + lookups_day AS reads_day FROM usage
        WINDOW w AS (PARTITION BY source_instance, database_name, table_name ORDER BY snapshot_date)
        QUALIFY row_number() OVER w > 1""",
    "access_trend": f"""SELECT source_instance, database_name, schema_name, table_name,
        round(avg(reads_day), 6) AS avg_reads_per_day, round(avg(scans_day), 6) AS avg_scans_per_day,
        round(avg(writes_day), 6) AS avg_writes_per_day, CAST(sum(scans_day) AS BIGINT) AS total_scans,
        CAST(sum(seeks_day) AS BIGINT) AS total_seeks, {ratio('sum(scans_day)', 'sum(seeks_day)')} AS scan_ratio
        FROM access_daily WHERE snapshot_date >= CAST({AS_OF} AS DATE) - 90 GROUP BY ALL""",
    "index_ops": f"""SELECT 'srv-' || (l_suppkey % 4) AS source_instance,
        CAST(date_trunc('year', l_shipdate) AS DATE) AS snapshot_date, 'db_' || (l_suppkey % 7) AS database_name,
        CASE WHEN l_returnflag = 'N' THEN 'missing' ELSE 'unused' END AS kind,
        'dbo.t' || l_suppkey || CASE WHEN l_returnflag = 'A' THEN '.ix_' || (l_partkey % 3) ELSE '' END
          AS object_name,
        CASE WHEN kind = 'missing' THEN {cents('sum(CAST(round(l_extendedprice * 100) AS BIGINT))')} END
          AS impact_score,
        CASE WHEN kind = 'unused' THEN CAST(0 AS BIGINT) END AS reads,
        CASE WHEN kind = 'unused' THEN count(*) END AS writes,
        CASE WHEN kind = 'missing' THEN 'EQUALITY: ' || object_name END AS detail
        FROM lineitem GROUP BY 1, 2, 3, 4, 5""",
    "index_latest": """SELECT f.*, CASE WHEN kind = 'missing' THEN CAST(rank() OVER (
          PARTITION BY source_instance, database_name, kind ORDER BY impact_score DESC NULLS LAST) AS INTEGER) END
          AS impact_rank
        FROM index_ops f WHERE snapshot_date = (SELECT max(snapshot_date) FROM index_ops g
          WHERE g.source_instance = f.source_instance AND g.database_name = f.database_name)""",
    "health": f"""SELECT 'srv-' || (o_custkey % 4) AS source_instance,
        CAST(date_trunc('year', o_orderdate) AS DATE) AS snapshot_date, 'db_' || (o_custkey % 97) AS database_name,
        {AS_OF} - to_seconds(min(o_orderkey % 48) FILTER (o_orderstatus = 'F') * 3600 + 1860)
          AS last_full_backup_utc,
        {AS_OF} - to_seconds(min(o_orderkey % 9) FILTER (o_orderstatus = 'O') * 3600 + 1860)
          AS last_log_backup_utc,
        CASE WHEN min(o_orderpriority) < '2' THEN 'FULL' ELSE 'SIMPLE' END AS recovery_model,
        CASE WHEN min(o_orderkey) % 29 = 0 THEN 'SUSPECT' ELSE 'ONLINE' END AS state_desc,
        CAST(count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 5 = 0) AS INTEGER) AS job_failures_24h
        FROM orders GROUP BY 1, 2, 3""",
    "workload": f"""SELECT 'srv-' || (l_suppkey % 4) AS source_instance,
        date_trunc('month', l_shipdate)::TIMESTAMP AS window_start_utc, 'login_' || l_suppkey AS login_name,
        {PART_PROGRAM} AS program_name, 'host_' || (l_suppkey % 5) AS host_name,
        'db_' || (l_partkey % 3) AS database_name, count(*) AS exec_count,
        {cents('sum(CAST(round(l_extendedprice * 100) AS BIGINT))')} AS total_cpu_ms,
        CAST(sum(l_orderkey % 1000) AS BIGINT) AS total_logical_reads
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4, 5, 6""",
    "activity": """SELECT *, 'srv-' || (user_id % 4) AS source_instance,
        date_trunc('hour', ts) + INTERVAL 1 HOUR AS snapshot_time_utc,
        CAST(event_id % 2000000000 AS INTEGER) AS session_id FROM events""",
    "sessions": f"""SELECT source_instance, snapshot_time_utc, session_id, 'login_' || (user_id % 50) AS login_name,
        'host_' || (user_id % 9) AS host_name, {PROGRAM} AS program_name, event_type <> 'signup' AS is_user
        FROM activity""",
    "requests": f"""SELECT *, CASE WHEN session_id % 5 = 0 THEN 0 ELSE session_id - session_id % 17 END
          AS blocking_session_id, user_id % 25 AS database_id,
        CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'runnable' WHEN 'purchase' THEN 'suspended'
          ELSE 'background' END AS status, {WAIT_TYPE} AS wait_type,
        CAST(round(value * 10) AS BIGINT) AS wait_time_ms, 'KEY: ' || event_id AS wait_resource,
        CASE WHEN event_id % 10 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS cpu_ms,
        event_id * 3 AS logical_reads FROM activity""",
    "waiting": f"""SELECT source_instance, snapshot_time_utc, session_id,
        CASE WHEN session_id % 5 <> 0 THEN session_id - session_id % 17 END AS blocking_session_id,
        {WAIT_TYPE} AS wait_type, CAST(round(value * 10) AS BIGINT) AS wait_duration_ms,
        'KEY: ' || event_id AS resource_description FROM activity""",
    "grants": """SELECT source_instance, snapshot_time_utc, session_id, event_id * 4 AS requested_memory_kb,
        CASE WHEN event_id % 6 <> 0 THEN event_id * 4 END AS granted_memory_kb,
        CASE WHEN event_id % 6 <> 0 THEN ts END AS grant_time, CAST(event_id % 8 AS INTEGER) AS queue_id,
        CAST(round(value) AS BIGINT) AS wait_time_ms, CAST(event_id % 16 AS INTEGER) AS dop
        FROM activity""",
    "transactions": """SELECT source_instance, snapshot_time_utc, event_id, session_id,
        'tran_' || event_type AS tran_name,
        ts - to_seconds(CAST(floor(value) AS BIGINT)) AS transaction_begin_time
        FROM activity""",
    "concurrency": """SELECT k.source_instance, k.snapshot_time_utc,
        (SELECT count(*) FROM sessions t WHERE t.source_instance = k.source_instance
           AND t.snapshot_time_utc = k.snapshot_time_utc AND is_user)::INTEGER AS user_sessions,
        (SELECT count(*) FROM requests t WHERE t.source_instance = k.source_instance
           AND t.snapshot_time_utc = k.snapshot_time_utc AND status = 'running')::INTEGER AS running,
        (SELECT count(*) FROM requests t WHERE t.source_instance = k.source_instance
           AND t.snapshot_time_utc = k.snapshot_time_utc AND status = 'runnable')::INTEGER AS runnable,
        (SELECT count(*) FROM requests t WHERE t.source_instance = k.source_instance
           AND t.snapshot_time_utc = k.snapshot_time_utc AND status = 'suspended')::INTEGER AS suspended,
        (SELECT count(*) FROM requests t WHERE t.source_instance = k.source_instance
           AND t.snapshot_time_utc = k.snapshot_time_utc AND blocking_session_id <> 0)::INTEGER AS blocked,
        (SELECT count(*) FROM grants t WHERE t.source_instance = k.source_instance
           AND t.snapshot_time_utc = k.snapshot_time_utc AND grant_time IS NULL)::INTEGER
           AS memory_grants_pending,
        (SELECT coalesce(max(date_diff('second', transaction_begin_time, snapshot_time_utc)), 0)
           FROM transactions t WHERE t.source_instance = k.source_instance
           AND t.snapshot_time_utc = k.snapshot_time_utc)::INTEGER AS longest_open_tran_sec
        FROM (SELECT DISTINCT source_instance, snapshot_time_utc FROM activity) k""",
    "blocking": """SELECT r.source_instance, r.snapshot_time_utc AS sample_time_utc, r.session_id,
        r.blocking_session_id, r.wait_type, r.wait_time_ms, r.wait_resource, s.login_name, s.program_name,
        n_name AS database_name
        FROM requests r JOIN sessions s ON s.source_instance = r.source_instance
          AND s.snapshot_time_utc = r.snapshot_time_utc AND s.session_id = r.session_id
        LEFT JOIN nation ON n_nationkey = r.database_id WHERE r.blocking_session_id <> 0""",
    "parsed_events": """SELECT event_id, 'srv-' || (user_id % 4) AS source_instance,
        date_trunc('millisecond', ts) AS event_time_utc,
        CAST(round(value * 1000) AS BIGINT) AS cpu_time, CAST(round(value * 2500) AS BIGINT) AS duration,
        event_id % 5000 AS logical_reads,
        CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 9 END AS writes,
        CASE WHEN event_type = 'view' THEN 0 ELSE event_id % 70 END AS row_count,
        'DOMAIN\\login_' || (user_id % 50) AS login_name,
        CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 'A & B' ELSE event_type END AS program_name,
        'host_' || (user_id % 9) AS host_name, 'db_' || (user_id % 3) AS database_name FROM events""",
    "marks": """SELECT 'srv-' || (user_id % 4) AS source_instance,
        date_trunc('day', min(ts)) + INTERVAL 10 DAY AS mark_utc FROM events
        GROUP BY 1 HAVING source_instance IN ('srv-0', 'srv-1')""",
    "deadlocks": """SELECT 'srv-' || (user_id % 4) AS source_instance,
        date_trunc('millisecond', ts) AS event_time_utc,
        CAST(CASE event_id % 3 WHEN 0 THEN event_id WHEN 1 THEN event_id + 1 END AS INTEGER)
          AS victim_session_id,
        CASE event_id % 3 WHEN 0 THEN 'login_0' WHEN 1 THEN 'login_1' END AS victim_login,
        CASE event_id % 3 WHEN 0 THEN 'App <0>' WHEN 1 THEN 'App1' END AS victim_program,
        CAST(2 AS INTEGER) AS process_count,
        nullif(concat_ws(', ', CASE WHEN event_id % 4 <> 0 THEN 'keylock:db.dbo.t' || user_id END,
          CASE WHEN event_id % 8 >= 4 THEN 'exchangeEvent' END), '') AS resource_summary,
        '<deadlock><victim-list><victimProcess id="p' || (event_id % 3) ||
          '"/></victim-list><process-list><process id="p0" spid="' || event_id ||
          '" loginname="login_0" clientapp="App &lt;0&gt;" hostname="h0"><inputbuf>select 1</inputbuf></process>' ||
          '<process id="p1" spid="' || (event_id + 1) ||
          '" loginname="login_1" clientapp="App1"/></process-list><resource-list>' ||
          CASE WHEN event_id % 4 = 0 THEN '' ELSE '<keylock hobtid="1" objectname="db.dbo.t' || user_id ||
            '" mode="X"><owner-list><owner id="p0"/></owner-list><waiter-list><waiter id="p1"/></waiter-list>' ||
            '</keylock>' END ||
          CASE WHEN event_id % 8 < 4 THEN '' ELSE '<exchangeEvent id="Pipe"/>' END ||
          '</resource-list></deadlock>' AS deadlock_graph_xml FROM events""",
    "objects": """SELECT 'srv-' || (p_partkey % 4) AS source_instance, 'db_' || (p_partkey % 3) AS database_name,
        p_partkey AS object_id, p_name AS object_name, r_name AS schema_name,
        p_size % 9 <> 0 AS is_table, p_size % 10 = 0 AS is_shipped
        FROM part LEFT JOIN region ON r_regionkey = p_size % 5""",
    "month_orders": """SELECT *, 'srv-' || (o_custkey % 4) AS source_instance,
        date_trunc('month', o_orderdate)::TIMESTAMP + INTERVAL 1 MONTH AS snapshot_time_utc,
        o_custkey % 25 AS dbid FROM orders""",
    "named_stats": """SELECT 'srv-' || (user_id % 4) AS source_instance, ts AS snapshot_time_utc,
        n_name AS database_name, n_nationkey, CAST(user_id % 3 + 1 AS INTEGER) AS file_id,
        CAST(round(value * 100) AS BIGINT) AS num_of_reads FROM events JOIN nation ON n_nationkey = user_id % 25""",
    "run_results": """SELECT event_id, 'srv-' || (user_id % 4) AS source_instance, event_type AS task,
        ts AS started_at_utc, CASE WHEN value < 100 THEN ts + INTERVAL 5 SECOND END AS ended_at_utc,
        CASE WHEN value < 40 THEN 'success' WHEN value < 100 THEN 'failed' ELSE 'running' END AS status,
        CASE WHEN value < 40 THEN CAST(round(value * 10) AS BIGINT) END AS row_count,
        CASE WHEN value >= 40 AND value < 100 THEN 'persist failed' END AS error_message FROM events""",
}



def workload_sum(events: str, window: str, group: str) -> str:
    hashed = "coalesce(login_name, '') || '|' || coalesce(program_name, '') || '|' || coalesce(host_name, '')"
    hashed += " || '|' || coalesce(database_name, '')"
    # UTF-16LE of ASCII text: every byte followed by a zero byte.
    wide = f"unhex(regexp_replace(hex(encode({hashed})), '(..)', '\\1' || '00', 'g'))"
    return f"""SELECT source_instance, {window} AS window_start_utc, login_name, program_name, host_name,
        database_name, count(*) AS exec_count, {us_to_ms('sum(cpu_time)')} AS total_cpu_ms,
        {us_to_ms('sum(duration)')} AS total_duration_ms, CAST(sum(logical_reads) AS BIGINT) AS total_logical_reads,
        CAST(sum(writes) AS BIGINT) AS total_writes, CAST(sum(row_count) AS BIGINT) AS total_rows,
        upper(sha256({wide})) AS attribution_hash FROM {events} GROUP BY {group}"""


WHO = "login_name, program_name, host_name, database_name"
EXCLUDED = "('SLEEP_TASK', 'LAZYWRITER_SLEEP')"

_cpu_hours = """(SELECT source_instance, date_trunc('hour', sample_time_utc) AS h, sql_cpu_pct, other_cpu_pct,
    idle_pct, row_number() OVER (PARTITION BY source_instance, date_trunc('hour', sample_time_utc){0}
      ORDER BY sample_time_utc DESC) AS n FROM cpu {1})"""

STATEMENTS = {
    "cpu_timeline": "SELECT * FROM cpu",
    "cpu_hour_heatmap": """SELECT source_instance, dayname(sample_time_utc) AS day_of_week,
        CAST(hour(sample_time_utc) AS INTEGER) AS hour_of_day, round(avg(sql_cpu_pct), 6) AS avg_sql_cpu_pct
        FROM cpu GROUP BY ALL""",
    "wait_deltas": f"""SELECT source_instance, snapshot_time_utc, wait_type,
        {step('wait_ms_cum')} AS wait_ms_delta, {WAIT_CATEGORY} AS wait_category FROM waits
        WINDOW w AS (PARTITION BY source_instance, wait_type ORDER BY snapshot_time_utc, event_id)
        QUALIFY row_number() OVER w > 1""",
    "top_queries": """SELECT source_instance, snapshot_time_utc, query_hash, exec_count, avg_cpu_ms,
        avg_duration_ms, avg_logical_reads, total_cpu_ms, query_sql_text,
        CAST(rank() OVER (PARTITION BY source_instance, snapshot_time_utc ORDER BY avg_cpu_ms DESC) AS INTEGER)
          AS cpu_rank,
        CAST(rank() OVER (PARTITION BY source_instance, snapshot_time_utc ORDER BY avg_duration_ms DESC)
          AS INTEGER) AS duration_rank FROM query_costs""",
    "table_storage_latest": "SELECT * FROM storage_latest",
    "table_growth": f"""SELECT c.source_instance, c.database_name, c.schema_name, c.table_name,
        c.snapshot_date AS current_snapshot_date, c.data_kb AS current_data_kb,
        p.snapshot_date AS prior_snapshot_date, p.data_kb AS prior_data_kb,
        c.data_kb - p.data_kb AS data_kb_growth, {ratio('(c.data_kb - p.data_kb)', 'p.data_kb')} AS growth_pct
        FROM storage_latest c LEFT JOIN storage p ON p.source_instance = c.source_instance
          AND p.database_name = c.database_name AND p.table_name = c.table_name
          AND p.snapshot_date = (SELECT max(h.snapshot_date) FROM storage h WHERE h.table_name = c.table_name
            AND h.source_instance = c.source_instance AND h.database_name = c.database_name
            AND h.snapshot_date <= c.snapshot_date - 30)""",
    "table_access_daily": "SELECT * FROM access_daily",
    "table_access_trend": "SELECT * FROM access_trend",
    "index_opportunities": "SELECT * FROM index_latest",
    "tuning_candidates": """SELECT z.source_instance, z.database_name, z.schema_name, z.table_name, z.data_kb,
        z.row_count, t.avg_reads_per_day, t.avg_writes_per_day, t.scan_ratio, i.kind AS index_issue_kind,
        i.object_name AS index_issue_object, i.impact_score, i.reads AS index_reads, i.writes AS index_writes,
        i.detail, CASE WHEN i.kind = 'missing' THEN 'add index' WHEN i.kind = 'unused' THEN 'drop index'
          WHEN t.avg_writes_per_day > 0 AND z.data_kb > 200000 THEN 'review fill factor / fragmentation' END
          AS recommendation
        FROM storage_latest z
        LEFT JOIN access_trend t ON t.source_instance = z.source_instance AND t.database_name = z.database_name
          AND t.schema_name = z.schema_name AND t.table_name = z.table_name
        LEFT JOIN index_latest i ON i.source_instance = z.source_instance AND i.database_name = z.database_name
          AND (i.object_name = z.schema_name || '.' || z.table_name
            OR starts_with(i.object_name, z.schema_name || '.' || z.table_name || '.'))
        WHERE z.data_kb > 10240""",
    "health_summary": f"""SELECT source_instance, snapshot_date, database_name, recovery_model, state_desc,
        last_full_backup_utc, last_log_backup_utc, job_failures_24h,
        CASE WHEN state_desc <> 'ONLINE' THEN 'RED' WHEN job_failures_24h > 0 THEN 'RED'
          WHEN last_full_backup_utc IS NULL OR {hours_between('last_full_backup_utc', AS_OF)} > 24 THEN 'RED'
          WHEN recovery_model = 'FULL' AND (last_log_backup_utc IS NULL
            OR {hours_between('last_log_backup_utc', AS_OF)} > 4) THEN 'AMBER' ELSE 'GREEN' END AS rag_status
        FROM health h WHERE snapshot_date = (SELECT max(snapshot_date) FROM health g
          WHERE g.source_instance = h.source_instance AND g.database_name = h.database_name)""",
    "workload_by_category": f"""SELECT source_instance, window_start_utc,
        coalesce(rules.workload_category, 'Unknown') AS workload_category,
        CAST(sum(total_cpu_ms) AS DECIMAL(28,2)) AS total_cpu_ms,
        CAST(sum(total_logical_reads) AS BIGINT) AS total_logical_reads,
        CAST(sum(exec_count) AS BIGINT) AS exec_count
        FROM workload LEFT JOIN {RULES} ON rules.class_id = {deciding_rule('program_name')} GROUP BY 1, 2, 3""",
    "top_logins": """SELECT *, CAST(rank() OVER (PARTITION BY source_instance ORDER BY total_cpu_ms DESC)
          AS INTEGER) AS cpu_rank,
        CAST(rank() OVER (PARTITION BY source_instance ORDER BY total_logical_reads DESC) AS INTEGER)
          AS reads_rank
        FROM (SELECT source_instance, login_name, CAST(sum(total_cpu_ms) AS DECIMAL(28,2)) AS total_cpu_ms,
          CAST(sum(total_logical_reads) AS BIGINT) AS total_logical_reads,
          CAST(sum(exec_count) AS BIGINT) AS exec_count FROM workload GROUP BY 1, 2) t""",
    "io_latency_deltas": f"""SELECT source_instance, snapshot_time_utc, database_name, logical_file_name,
        file_type, {step('reads_cum')} AS reads_delta, {step('read_stall_ms_cum')} AS read_stall_ms_delta,
        {ratio('read_stall_ms_delta', 'reads_delta')} AS avg_read_latency_ms, {step('writes_cum')} AS writes_delta,
        {step('write_stall_ms_cum')} AS write_stall_ms_delta,
        {ratio('write_stall_ms_delta', 'writes_delta')} AS avg_write_latency_ms, size_on_disk_bytes FROM io
        WINDOW w AS (PARTITION BY source_instance, database_name, logical_file_name
          ORDER BY snapshot_time_utc, event_id) QUALIFY row_number() OVER w > 1""",
    "blocking_recent": "SELECT * FROM blocking",
    "deadlock_summary": "SELECT * EXCLUDE (deadlock_graph_xml) FROM deadlocks",
    "deadlock_trend": """SELECT source_instance, date_trunc('day', event_time_utc)::TIMESTAMP AS period_start_utc,
        count(*) AS deadlocks FROM deadlocks GROUP BY ALL""",
    "active_requests": """SELECT r.source_instance, r.snapshot_time_utc, r.session_id, s.login_name, s.host_name,
        s.program_name, n_name AS database_name, r.status, upper(event_type) AS command, r.wait_type,
        r.wait_time_ms, r.blocking_session_id, r.cpu_ms, CAST(round(value * 200) AS BIGINT) AS elapsed_ms,
        r.logical_reads, event_id % 13 AS writes, CAST(event_id % 64 * 8 AS INTEGER) AS granted_mem_kb,
        CAST(CAST(floor(value) AS BIGINT) % 100 AS DOUBLE) AS percent_complete,
        substring(t.text, event_id % 5 + 1, CASE WHEN event_id % 3 = 0 THEN length(t.text) - event_id % 5 + 1
          ELSE 9 END) AS running_sql
        FROM requests r JOIN sessions s ON s.source_instance = r.source_instance
          AND s.snapshot_time_utc = r.snapshot_time_utc AND s.session_id = r.session_id
        LEFT JOIN texts t ON t.source_instance = r.source_instance
          AND t.sql_handle = CAST(user_id % 4 + 4 * (event_id % 100) AS VARCHAR)
        LEFT JOIN nation ON n_nationkey = r.database_id WHERE s.is_user AND r.session_id <> 7""",
    "live_blocking": """SELECT w.source_instance, w.snapshot_time_utc, w.blocking_session_id AS blocker_spid,
        w.session_id AS blocked_spid, w.wait_type, w.wait_duration_ms, w.resource_description,
        b.login_name AS blocker_login, b.program_name AS blocker_program, b.host_name AS blocker_host,
        s.login_name AS blocked_login, s.program_name AS blocked_program
        FROM waiting w
        LEFT JOIN sessions b ON b.source_instance = w.source_instance AND b.snapshot_time_utc = w.snapshot_time_utc
          AND b.session_id = w.blocking_session_id
        LEFT JOIN sessions s ON s.source_instance = w.source_instance AND s.snapshot_time_utc = w.snapshot_time_utc
          AND s.session_id = w.session_id
        WHERE w.blocking_session_id IS NOT NULL AND w.blocking_session_id <> w.session_id""",
    "live_waits": """SELECT source_instance, snapshot_time_utc, wait_type, count(*) AS waiting_tasks,
        CAST(sum(wait_duration_ms) AS BIGINT) AS total_wait_ms FROM waiting WHERE session_id > 50 GROUP BY ALL""",
    "concurrency_now": """SELECT source_instance, snapshot_time_utc, user_sessions, running,
        runnable AS runnable_cpu_pressure, suspended AS suspended_waiting, blocked, memory_grants_pending,
        longest_open_tran_sec FROM concurrency""",
    "memory_grants": "SELECT * FROM grants",
    "tempdb_by_session": """SELECT source_instance, snapshot_time_utc, session_id,
        'login_' || (user_id % 50) AS login_name, """ + PROGRAM + """ AS program_name,
        (event_id % 3 + (event_id // 3) % 2) * 8 AS tempdb_alloc_kb FROM activity
        WHERE event_id % 3 + (event_id // 3) % 2 > 0""",
    "long_transactions": """SELECT t.source_instance, t.snapshot_time_utc, t.session_id, s.login_name,
        s.program_name, tran_name, transaction_begin_time,
        date_diff('second', transaction_begin_time, t.snapshot_time_utc) AS open_seconds
        FROM transactions t JOIN sessions s ON s.source_instance = t.source_instance
          AND s.snapshot_time_utc = t.snapshot_time_utc AND s.session_id = t.session_id""",
    "cpu_schedulers": """SELECT source_instance, snapshot_time_utc,
        CAST(user_id * 2 % 300 AS INTEGER) AS scheduler_id, CAST(event_id % 40 AS INTEGER) AS current_tasks_count,
        CAST(event_id % 7 AS INTEGER) AS runnable_tasks_count, event_id % 11 AS work_queue_count,
        CAST(event_id % 3 AS INTEGER) AS pending_disk_io_count FROM activity WHERE user_id * 2 % 300 < 255""",
    "ingest_cpu": """SELECT source_instance, date_trunc('minute', (date_trunc('day', sample_time_utc)::TIMESTAMP
          + INTERVAL 1 DAY) - to_milliseconds((epoch_us(date_trunc('day', sample_time_utc)::TIMESTAMP
          + INTERVAL 1 DAY) - epoch_us(sample_time_utc)) // 1000)) AS sample_time_utc,
        sql_cpu_pct, other_cpu_pct, idle_pct
        FROM (SELECT c.*, e.event_type FROM cpu c POSITIONAL JOIN events e) z WHERE event_type <> 'error'""",
    "ingest_waits": f"""SELECT source_instance, snapshot_time_utc, wait_type, wait_ms_cum, waiting_tasks_cum
        FROM waits WHERE wait_type NOT IN {EXCLUDED}""",
    "ingest_query_perf": """SELECT source_instance, snapshot_time_utc, query_hash, exec_count, avg_cpu_ms,
        avg_duration_ms, avg_logical_reads, total_cpu_ms, query_sql_text
        FROM (SELECT *, row_number() OVER (PARTITION BY source_instance, snapshot_time_utc
              ORDER BY cpu_us DESC, query_hash) AS a,
            row_number() OVER (PARTITION BY source_instance, snapshot_time_utc
              ORDER BY avg_logical_reads DESC, query_hash) AS b FROM query_costs) z
        WHERE a <= 50 OR b <= 50""",
    "ingest_workload": workload_sum(
        """(SELECT e.*, coalesce(m.mark_utc, f.first) AS start FROM parsed_events e
            LEFT JOIN marks m ON m.source_instance = e.source_instance
            JOIN (SELECT source_instance, min(event_time_utc) AS first FROM parsed_events GROUP BY 1) f
              ON f.source_instance = e.source_instance
            WHERE m.mark_utc IS NULL OR e.event_time_utc > m.mark_utc) x""",
        "start",
        f"source_instance, start, {WHO}",
    ),
    "ingest_sessions": """SELECT r.source_instance, r.snapshot_time_utc AS sample_time_utc, s.login_name,
        s.program_name, s.host_name, n_name AS database_name, CAST(count(*) AS INTEGER) AS active_requests,
        CAST(sum(coalesce(cpu_ms, 0)) AS BIGINT) AS cpu_ms_inflight,
        CAST(sum(logical_reads) AS BIGINT) AS reads_inflight
        FROM requests r JOIN sessions s ON s.source_instance = r.source_instance
          AND s.snapshot_time_utc = r.snapshot_time_utc AND s.session_id = r.session_id
        LEFT JOIN nation ON n_nationkey = r.database_id WHERE s.is_user GROUP BY ALL""",
    "ingest_concurrency": "SELECT * RENAME (snapshot_time_utc AS sample_time_utc) FROM concurrency",
    "ingest_storage": """SELECT o.source_instance, CAST(date_trunc('year', l_shipdate) AS DATE) AS snapshot_date,
        o.database_name, o.schema_name, o.object_name AS table_name,
        CAST(sum(CASE WHEN l_linenumber % 4 IN (0, 1) THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT)
          AS row_count,
        CAST(sum(l_orderkey % 50 + l_orderkey % 7 + l_orderkey % 3) * 8 AS BIGINT) AS data_kb,
        CAST((sum(l_orderkey % 90 + 60) - sum(l_orderkey % 50 + l_orderkey % 7 + l_orderkey % 3)) * 8 AS BIGINT)
          AS index_kb,
        CAST((sum(l_orderkey % 90 + 75) - sum(l_orderkey % 90 + 60)) * 8 AS BIGINT) AS unused_kb
        FROM lineitem JOIN objects o ON o.object_id = l_partkey
        WHERE NOT o.is_shipped AND o.schema_name IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    "ingest_index_ops": """SELECT 'srv-' || (o_custkey % 4) AS source_instance,
          CAST(date_trunc('year', o_orderdate) AS DATE) AS snapshot_date,
          'db_' || (o_custkey % 3) AS database_name, 'missing' AS kind,
          n.schema_name || '.' || n.object_name AS object_name,
          CAST(round(o_totalprice) * (o_orderkey % 100) * (o_custkey % 50 + 1) AS DECIMAL(18,2)) AS impact_score,
          CAST(NULL AS BIGINT) AS reads, CAST(NULL AS BIGINT) AS writes,
          'EQUALITY: ' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '[c' || (o_orderkey % 12) || ']' END ||
          ' INEQUALITY: ' || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '[d]' END ||
          ' INCLUDED: ' || o_orderpriority AS detail
        FROM orders LEFT JOIN objects n ON n.object_id = o_custkey
        UNION ALL
        SELECT n.source_instance, CAST(date_trunc('year', l_shipdate) AS DATE), n.database_name, 'unused',
          n.schema_name || '.' || n.object_name || '.ix_' || l_partkey || '_' || (l_linenumber % 4), NULL,
          CAST(0 AS BIGINT), l_orderkey % 4, NULL
        FROM lineitem JOIN objects n ON n.object_id = l_partkey
        WHERE l_linenumber % 4 <> 0 AND l_orderkey % 4 > 0 AND NOT (l_returnflag = 'A' AND l_quantity > 0)
          AND NOT (l_returnflag = 'N' AND l_quantity >= 10)""",
    "ingest_table_access": """SELECT o.source_instance, CAST(date_trunc('year', l_shipdate) AS DATE)
          AS snapshot_date, o.database_name, o.schema_name, o.object_name AS table_name,
        CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS seeks_cum,
        CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) // 10 ELSE 0 END) AS BIGINT)
          AS scans_cum, CAST(0 AS BIGINT) AS lookups_cum, CAST(sum(l_orderkey % 4) AS BIGINT) AS updates_cum,
        max(CASE WHEN l_returnflag IN ('A', 'N') THEN l_shipdate END) AS last_user_read_utc,
        max(CASE WHEN l_orderkey % 4 > 0 THEN l_shipdate END) AS last_user_update_utc
        FROM lineitem JOIN objects o ON o.object_id = l_partkey
        WHERE o.is_table AND NOT o.is_shipped AND o.schema_name IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
    "ingest_health": """SELECT d.source_instance, CAST(d.snapshot_time_utc AS DATE) AS snapshot_date,
        n_name AS database_name, b.f AS last_full_backup_utc, b.l AS last_log_backup_utc,
        CASE WHEN n_regionkey % 2 = 0 THEN 'FULL' ELSE 'SIMPLE' END AS recovery_model,
        CASE WHEN n_nationkey % 6 = 5 THEN 'OFFLINE' ELSE 'ONLINE' END AS state_desc,
        CAST(coalesce(j.n, 0) AS INTEGER) AS job_failures_24h
        FROM (SELECT DISTINCT source_instance, snapshot_time_utc, dbid FROM month_orders) d
        JOIN nation ON n_nationkey = d.dbid
        LEFT JOIN (SELECT source_instance, snapshot_time_utc, dbid,
            max(o_orderdate + to_hours(o_orderkey % 24)) FILTER (o_orderstatus = 'F') AS f,
            max(o_orderdate + to_hours(o_orderkey % 24)) FILTER (o_orderstatus = 'O') AS l
          FROM month_orders GROUP BY ALL) b ON b.source_instance = d.source_instance
          AND b.snapshot_time_utc = d.snapshot_time_utc AND b.dbid = d.dbid
        LEFT JOIN (SELECT source_instance, snapshot_time_utc, count(*) AS n FROM month_orders
          WHERE o_orderkey % 3 = 0 AND o_custkey % 30 < 25
            AND CAST(o_orderdate AS DATE) + to_seconds(o_orderkey % 86400) >= snapshot_time_utc - INTERVAL 24 HOUR
          GROUP BY ALL) j ON j.source_instance = d.source_instance AND j.snapshot_time_utc = d.snapshot_time_utc
        WHERE d.dbid > 4""",
    "ingest_io_latency": """SELECT 'srv-' || (user_id % 4) AS source_instance, ts AS snapshot_time_utc,
        n_name AS database_name, n_name || '_' || (user_id % 3 + 1) AS logical_file_name,
        CASE WHEN user_id % 3 = 1 THEN 'LOG' ELSE 'ROWS' END AS file_type,
        CAST(round(value * 100) AS BIGINT) AS reads_cum, event_id * 10 AS bytes_read_cum,
        CAST(round(value * 37) AS BIGINT) AS read_stall_ms_cum, event_id % 1000 AS writes_cum,
        event_id * 20 AS bytes_written_cum, event_id % 777 AS write_stall_ms_cum,
        event_id * 8192 AS size_on_disk_bytes
        FROM events JOIN nation ON n_nationkey = user_id % 25 WHERE user_id % 25 > 4 AND user_id % 3 < 2""",
    "ingest_blocking": "SELECT * FROM blocking",
    "ingest_deadlocks": """SELECT d.* FROM deadlocks d LEFT JOIN marks m ON m.source_instance = d.source_instance
        WHERE m.mark_utc IS NULL OR d.event_time_utc > m.mark_utc""",
    "upsert": f"""SELECT a.source_instance, a.h AS sample_time_utc,
        coalesce(b.sql_cpu_pct, a.sql_cpu_pct) AS sql_cpu_pct,
        CASE WHEN b.h IS NULL THEN a.other_cpu_pct ELSE CAST(0 AS SMALLINT) END AS other_cpu_pct,
        coalesce(b.idle_pct, a.idle_pct) AS idle_pct
        FROM {_cpu_hours.format('', '')} a
        LEFT JOIN {_cpu_hours.format('', 'WHERE sql_cpu_pct >= 50')} b
          ON b.source_instance = a.source_instance AND b.h = a.h AND b.n = 1 WHERE a.n = 1""",
    "upsert_hash_key": "SELECT DISTINCT login_name, program_name, host_name, database_name, attribution_hash FROM ("
    + workload_sum(
        f"""(SELECT 'srv' AS source_instance, 'login_' || l_suppkey AS login_name, {PART_PROGRAM} AS program_name,
          'host_' || (l_suppkey % 5) AS host_name, 'db_' || (l_partkey % 3) AS database_name, 0 AS cpu_time,
          0 AS duration, 0 AS logical_reads, 0 AS writes, 0 AS row_count
          FROM lineitem JOIN part ON p_partkey = l_partkey) x""",
        "1",
        f"source_instance, {WHO}",
    )
    + ") y",
    "incremental_watermark": """SELECT e.source_instance, m.mark_utc, count(*) AS events, min(ts) AS first_event
        FROM (SELECT 'srv-' || (user_id % 4) AS source_instance, ts FROM events) e
        LEFT JOIN (SELECT source_instance, max(started_at_utc) AS mark_utc FROM run_results
          WHERE task = 'view' AND status = 'success' GROUP BY 1) m ON m.source_instance = e.source_instance
        WHERE m.mark_utc IS NULL OR ts > m.mark_utc GROUP BY 1, 2""",
    "stamp": f"""SELECT 'srv-x' AS source_instance, {EVENTS_AS_OF} AS snapshot_time_utc, wait_type,
        wait_ms_cum, waiting_tasks_cum FROM waits WHERE wait_type NOT IN {EXCLUDED}""",
    "per_database_union": """SELECT source_instance, snapshot_time_utc, database_name, file_id, num_of_reads
        FROM named_stats WHERE n_nationkey > 4 AND n_nationkey % 6 <> 5""",
    "per_database_configured": """SELECT source_instance, snapshot_time_utc, database_name, file_id, num_of_reads
        FROM named_stats WHERE database_name IN ('NATION_3', 'NATION_7')""",
    "retention": f"""SELECT * FROM cpu WHERE sample_time_utc >= {EVENTS_AS_OF} - INTERVAL 12 HOUR
        - INTERVAL 10 DAY""",
    "run_ledger": "SELECT event_id AS run_id, * EXCLUDE (event_id) FROM run_results",
    "recent_runs": """SELECT task, source_instance, status, row_count, started_at_utc, error_message
        FROM run_results ORDER BY started_at_utc DESC, event_id DESC LIMIT 50""",
    "dry_run": f"""SELECT 'waits' AS task, count(*) AS row_count FROM waits WHERE wait_type NOT IN {EXCLUDED}
        UNION ALL SELECT 'blocking', count(*) FROM blocking""",
    "case_label": f"""SELECT wait_type, {WAIT_CATEGORY} AS wait_category, count(*) AS rows FROM waits
        GROUP BY ALL""",
    "counter_delta": f"""SELECT source_instance, database_name, snapshot_time_utc, event_id, reads_cum, writes_cum,
        {step('reads_cum')} AS reads_delta, {step('writes_cum')} AS writes_delta FROM io
        WINDOW w AS (PARTITION BY source_instance, database_name ORDER BY snapshot_time_utc, event_id)
        QUALIFY row_number() OVER w > 1 AND snapshot_time_utc >= TIMESTAMP '2024-01-20 00:00:00'""",
    "latest_per_key": """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "latest_date_per_group": """SELECT o_custkey, o_orderdate, o_orderkey FROM orders
        QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)""",
    "asof_lookback": """SELECT d.table_name, d.snapshot_date, d.data_kb, p.snapshot_date AS prior_snapshot_date,
        p.data_kb AS prior_data_kb FROM storage d ASOF LEFT JOIN storage p ON p.table_name = d.table_name
        AND p.snapshot_date <= d.snapshot_date - 90""",
    "first_match": """SELECT p_partkey, p_name, CASE WHEN p_name ILIKE '%widget%' THEN 'a'
        WHEN p_name LIKE '%bolt' THEN 'c' WHEN p_name LIKE 'red%' THEN 'b' ELSE 'none' END AS label FROM part""",
    "rank_within": """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
        CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS INTEGER) AS quantity_rank,
        CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS INTEGER) AS price_rank
        FROM lineitem""",
    "topk_union": """SELECT month, o_orderkey, o_custkey, o_totalprice FROM (
        SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, o_orderkey, o_custkey, o_totalprice,
          row_number() OVER (PARTITION BY date_trunc('month', o_orderdate)
            ORDER BY o_totalprice DESC, o_orderkey) AS a,
          row_number() OVER (PARTITION BY date_trunc('month', o_orderdate)
            ORDER BY o_custkey DESC, o_orderkey) AS b FROM orders) z WHERE a <= 3 OR b <= 3""",
    "safe_ratio": f"""SELECT *, {ratio('scans', 'busy_days')} AS ratio FROM (
        SELECT table_name, CAST(sum(scans_cum) AS BIGINT) AS scans,
          count(*) FILTER (seeks_cum > 200) AS busy_days FROM usage GROUP BY 1) z""",
    "xml_extract": "SELECT * EXCLUDE (event_id), true AS is_valid FROM parsed_events",
    "statement_slice": "SELECT query_sql_text, count(*) AS queries FROM query_costs GROUP BY 1",
    "event_files": """SELECT login_name, count(*) AS events, CAST(sum(duration) AS BIGINT) AS duration
        FROM parsed_events GROUP BY 1""",
    "hour_boundaries": f"SELECT event_id, {hours_between('ts', EVENTS_AS_OF)} AS hours FROM events",
    "streaming_workload": workload_sum(
        "parsed_events",
        "time_bucket(INTERVAL 30 MINUTE, event_time_utc)",
        f"source_instance, time_bucket(INTERVAL 30 MINUTE, event_time_utc), {WHO}",
    ),
    "streaming_counter_deltas": f"""SELECT source_instance, wait_type, snapshot_time_utc, event_id, wait_ms_cum,
        {step('wait_ms_cum')} AS wait_ms_delta
        FROM (SELECT 'srv-' || (user_id % 4) AS source_instance, event_type AS wait_type,
          ts AS snapshot_time_utc, event_id, CAST(round(value * 100) AS BIGINT) AS wait_ms_cum FROM events) counters
        WINDOW w AS (PARTITION BY source_instance, wait_type ORDER BY snapshot_time_utc, event_id)
        QUALIFY row_number() OVER w > 1""",
}
STATEMENTS["streaming_blocking"] = STATEMENTS["ingest_blocking"]
STATEMENTS["streaming_io_latency"] = STATEMENTS["ingest_io_latency"]
STATEMENTS["streaming_workload_late"] = workload_sum(
    """(SELECT * FROM parsed_events
        WHERE NOT (event_time_utc < TIMESTAMP '2024-01-04 00:00:00' AND event_id % 5 = 0)) kept""",
    "time_bucket(INTERVAL 30 MINUTE, event_time_utc)",
    f"source_instance, time_bucket(INTERVAL 30 MINUTE, event_time_utc), {WHO}",
)
STATEMENTS["rpt_views"] = STATEMENTS["top_logins"]
_kept_waits = f"(SELECT DISTINCT source_instance, snapshot_time_utc, wait_type FROM waits WHERE wait_type NOT IN {EXCLUDED})"
STATEMENTS["run_task_ledger"] = f"""SELECT i.source_instance, task, status, row_count, started_at_utc FROM (
      SELECT 'waits' AS task, source_instance, count(*) AS row_count FROM {_kept_waits} GROUP BY ALL
      UNION ALL SELECT 'waits', '*', count(*) FROM {_kept_waits}
      UNION ALL SELECT 'blocking', source_instance, count(*) FROM blocking GROUP BY ALL
      UNION ALL SELECT 'blocking', '*', count(*) FROM blocking) i,
    (SELECT 'success' AS status, TIMESTAMP '2024-01-31 00:30:00' AS started_at_utc)"""
STATEMENTS["rollup_after_upserts"] = STATEMENTS["top_logins"].replace(
    "CAST(sum(total_cpu_ms) AS DECIMAL(28,2))",
    "CAST(sum(CASE WHEN year(window_start_utc) = 1995 THEN 2 * total_cpu_ms ELSE total_cpu_ms END) AS DECIMAL(28,2))",
).replace("FROM workload GROUP", "FROM workload WHERE window_start_utc >= TIMESTAMP '1993-01-01' GROUP")
STATEMENTS["run_task_workload"] = workload_sum(
    """(WITH first_run AS (
          SELECT event_id FROM parsed_events WHERE event_time_utc <= TIMESTAMP '2024-01-20'
            AND NOT (event_time_utc > TIMESTAMP '2024-01-19 12:00:00' AND event_id % 3 = 0)),
        marks AS (
          SELECT source_instance, max(event_time_utc) AS mark, min(event_time_utc) AS first
          FROM parsed_events JOIN first_run USING (event_id) GROUP BY 1),
        kept AS (SELECT *, event_id IN (SELECT event_id FROM first_run) AS early FROM parsed_events)
        SELECT kept.*, CASE WHEN early THEN first ELSE coalesce(mark, min(event_time_utc) OVER (PARTITION BY source_instance)) END AS start
        FROM kept LEFT JOIN marks USING (source_instance)) runs""",
    "start",
    f"source_instance, start, {WHO}",
)
STATEMENTS["exclude_anti_join"] = STATEMENTS["ingest_waits"]
STATEMENTS["seed_rules"] = f"""SELECT rules.*, used.exec_count FROM {RULES}
    LEFT JOIN (SELECT {deciding_rule('program_name')} AS rule, CAST(sum(exec_count) AS BIGINT) AS exec_count
      FROM workload GROUP BY 1) used ON used.rule = rules.class_id"""


def with_shapes(statement: str) -> str:
    """Prefix the shapes a statement uses, directly or through other shapes."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in SHAPES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(body)
                needed.append(name)

    visit(statement)
    if not needed:
        return statement
    return "WITH " + ",\n".join(f"{n} AS ({SHAPES[n]})" for n in needed) + "\n" + statement


# Columns shown as text (dates) or doubles (decimals), as the queries show them.
SHOWN = {
    "VARCHAR": ["snapshot_date", "current_snapshot_date", "prior_snapshot_date"],
    "DOUBLE": [
        "avg_cpu_ms",
        "avg_duration_ms",
        "avg_logical_reads",
        "total_cpu_ms",
        "total_duration_ms",
        "impact_score",
    ],
}
COLUMNS = {
    "top_queries": "avg_cpu_ms avg_duration_ms avg_logical_reads total_cpu_ms",
    "ingest_query_perf": "avg_cpu_ms avg_duration_ms avg_logical_reads total_cpu_ms",
    "table_storage_latest": "snapshot_date",
    "table_growth": "current_snapshot_date prior_snapshot_date",
    "table_access_daily": "snapshot_date",
    "index_opportunities": "snapshot_date impact_score",
    "tuning_candidates": "impact_score",
    "health_summary": "snapshot_date",
    "workload_by_category": "total_cpu_ms",
    "top_logins": "total_cpu_ms",
    "ingest_workload": "total_cpu_ms total_duration_ms",
    "streaming_workload": "total_cpu_ms total_duration_ms",
    "streaming_workload_late": "total_cpu_ms total_duration_ms",
    "run_task_workload": "total_cpu_ms total_duration_ms",
    "rollup_after_upserts": "total_cpu_ms",
    "rpt_views": "total_cpu_ms",
    "ingest_storage": "snapshot_date",
    "ingest_index_ops": "snapshot_date impact_score",
    "ingest_table_access": "snapshot_date",
    "ingest_health": "snapshot_date",
    "asof_lookback": "snapshot_date prior_snapshot_date",
}


def shown(name: str, statement: str) -> str:
    kinds = {column: kind for kind, columns in SHOWN.items() for column in columns}
    casts = [f"CAST({c} AS {kinds[c]}) AS {c}" for c in COLUMNS.get(name, "").split()]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM (\n{statement}\n) shown" if casts else statement


def statements() -> dict[str, str]:
    return {name: with_shapes(shown(name, sql)) for name, sql in STATEMENTS.items()}
