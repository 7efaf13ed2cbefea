"""XML payloads to columns: CPU records, query events and deadlock reports. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.scalar import iso_timestamp

_NAMED = "array<struct<_name:string,value:string>>"
EVENT_SCHEMA = f"_name string, _timestamp string, data {_NAMED}, action {_NAMED}"
CPU_SCHEMA = "SchedulerMonitorEvent struct<SystemHealth:struct<ProcessUtilization:string,SystemIdle:string>>"
_PROCESS = "struct<_id:string,_spid:string,_loginname:string,_clientapp:string>"
DEADLOCK_SCHEMA = (
    "`victim-list` struct<victimProcess:array<struct<_id:string>>>, "
    f"`process-list` struct<process:array<{_PROCESS}>>"
)

EVENT_NUMBERS = ["cpu_time", "duration", "logical_reads", "writes", "row_count"]
EVENT_TEXTS = {
    "login_name": "server_principal_name",
    "program_name": "client_app_name",
    "host_name": "client_hostname",
    "database_name": "database_name",
}
DEADLOCK_EVENT = "xml_deadlock_report"
# The time in an event's opening tag.
EVENT_TIME = r"""<event\s[^>]*?\btimestamp\s*=\s*["']([^"']*)["']"""


def head_time(xml: Column) -> Column:
    """The event time from the opening tag alone, NULL if it is not there: a cheap test before parsing."""
    return iso_timestamp(F.regexp_extract(xml, EVENT_TIME, 1))


def parsed_once(df: DataFrame, column: str, schema: str, row_tag: str, output: str) -> DataFrame:
    """Add a parsed XML column. The one-element explode keeps filters on parsed fields above the parser; as a
    plain projection, filter pushdown would copy the parser into every predicate."""
    parsed = F.from_xml(F.col(column), schema, {"rowTag": row_tag})
    return df.select("*", F.explode(F.array(parsed)).alias(output))


def _last_named(pairs: Column, name: str) -> Column:
    """Value of the last pair with this name (a repeated name overrides earlier ones)."""
    return F.try_element_at(F.filter(pairs, lambda p: p["_name"] == name), F.lit(-1))["value"]


def _number(text: Column) -> Column:
    """Missing or empty is 0; text that is no number stays NULL so that it can be set aside."""
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit(0).cast("long")).otherwise(
        F.trim(text).try_cast("long")
    )


def parse_cpu_records(df: DataFrame, column: str = "record") -> DataFrame:
    """Replace the XML column with sql_cpu_pct and idle_pct."""
    health = F.col("_record.SchedulerMonitorEvent.SystemHealth")
    return (
        parsed_once(df, column, CPU_SCHEMA, "Record", "_record")
        .withColumn("sql_cpu_pct", health["ProcessUtilization"].try_cast("short"))
        .withColumn("idle_pct", health["SystemIdle"].try_cast("short"))
        .drop(column, "_record")
    )


def parse_events(df: DataFrame, column: str = "event_data") -> DataFrame:
    """Replace the XML column with event_time, five numbers, four names and `is_valid` (time and numbers
    readable)."""
    parsed = parsed_once(df, column, EVENT_SCHEMA, "event", "_event")
    numbers = [_number(_last_named(F.col("_event.data"), n)).alias(n) for n in EVENT_NUMBERS]
    texts = [_last_named(F.col("_event.action"), source).alias(name) for name, source in EVENT_TEXTS.items()]
    rest = [c for c in df.columns if c != column]
    time = iso_timestamp(F.col("_event._timestamp")).alias("event_time_utc")
    # inline() computes the fields once, for the validity filter and for everything after it.
    out = parsed.select(*rest, column, F.inline(F.array(F.struct(time, *numbers, *texts))))
    valid = F.col("event_time_utc").isNotNull()
    for n in EVENT_NUMBERS:
        valid = valid & F.col(n).isNotNull()
    return out.withColumn("is_valid", valid)


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's text from an opening tag; empty when absent."""
    return _unescape(F.regexp_extract(tag, rf"""(?s)\s{name}\s*=\s*(["'])(.*?)\1""", 2))


def _unescape(text: Column) -> Column:
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _resource_summary(graph: Column) -> Column:
    """`tag:object` of every resource in document order, comma separated; empty without resources.

    Resource tags are open-ended, so they are read from the opening tags. Owner and waiter lists are cut
    out first, which leaves the resources as the only children.
    """
    block = F.regexp_extract(graph, r"(?s)<resource-list\b[^>]*>(.*)</resource-list>", 1)
    flat = F.regexp_replace(block, r"(?s)<(owner-list|waiter-list)\b[^>]*?(/>|>.*?</\1>)", "")
    tags = F.regexp_extract_all(flat, F.lit(r"""(<[A-Za-z_](?:[^<>"']|"[^"]*"|'[^']*')*>)"""), 1)
    named = r"""(?s)^<([^\s/>]+)\s(?:.*?\s)?objectname\s*=\s*(["'])(.+?)\2.*$"""
    labels = F.transform(
        tags,
        lambda tag: F.when(tag.rlike(named), F.regexp_replace(tag, named, "$1:$3")).otherwise(
            F.regexp_extract(tag, r"^<([^\s/>]+)", 1)
        ),
    )
    return _unescape(F.array_join(labels, ", "))


def split_deadlocks(df: DataFrame, column: str = "target_xml") -> DataFrame:
    """One row per deadlock report inside an event buffer: its time and graph. Other columns are kept, the
    buffer is dropped."""
    rest = [c for c in df.columns if c != column]
    event_pattern = r"(?s)(<event\s(?:[^<>]*)(?<!/)>.*?</event>)"
    events = df.select(
        *rest, F.explode(F.regexp_extract_all(F.col(column), F.lit(event_pattern), 1)).alias("_event")
    )
    # The cheap test drops most other events before any pattern runs on them.
    head = F.regexp_extract("_event", r"^(<event\s[^>]*>)", 1)
    named = F.col("_event").contains(DEADLOCK_EVENT) & (_attribute(head, "name") == DEADLOCK_EVENT)
    return events.where(named).select(
        *rest,
        iso_timestamp(_attribute(head, "timestamp")).alias("event_time_utc"),
        F.regexp_extract("_event", r"(?s)(<deadlock\b.*</deadlock>)", 1).alias("deadlock_graph_xml"),
    )


def parse_deadlocks(reports: DataFrame) -> DataFrame:
    """Add the victim (the first listed process that is one), process count and resources of each graph."""
    parsed = parsed_once(reports, "deadlock_graph_xml", DEADLOCK_SCHEMA, "deadlock", "_graph")
    processes = F.coalesce(F.col("_graph.process-list.process"), F.array())
    victims = F.transform(F.col("_graph.victim-list.victimProcess"), lambda v: v["_id"])
    listed = parsed.withColumns({"_processes": processes, "_victims": victims})
    victim = F.try_element_at(
        F.filter("_processes", lambda p: F.array_contains(F.col("_victims"), p["_id"])), F.lit(1)
    )
    return listed.withColumn("_victim", victim).select(
        *reports.columns,
        F.col("_victim._spid").try_cast("int").alias("victim_session_id"),
        F.col("_victim._loginname").alias("victim_login"),
        F.col("_victim._clientapp").alias("victim_program"),
        F.size("_processes").alias("process_count"),
        F.nullif(_resource_summary(F.col("deadlock_graph_xml")), F.lit("")).alias("resource_summary"),
    )
