"""Landing folders as streams: events and raw snapshots flow into fact tables through idempotent upserts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.functions.xml import parse_events
from gaugeworks.plans.ingest import ingest_deadlocks, ingest_workload_windows
from gaugeworks.sources.fact_table import FactTable


def event_stream(
    spark: SparkSession,
    path: str,
    columns: str,
    format: str = "parquet",
    files_per_batch: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """A landing folder as a stream with declared columns. The file limit bounds a micro-batch."""
    reader = spark.readStream.format(format).schema(columns)
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _upsert(table: FactTable, batch: DataFrame) -> None:
    table.upsert(batch)
    table.discard_staged()


def _start(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str | None, mode: str
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def stream_workload(
    event_log: DataFrame,
    table: FactTable,
    checkpoint: str,
    width: str = "30 minutes",
    late: str = "1 hour",
    every: str | None = None,
    distinct_on: list[str] | None = None,
) -> StreamingQuery:
    """Query events into fact_workload, one row per window and attribution group.

    Windows are updated as events arrive and dropped from state once the watermark has passed them; events
    later than `late` are ignored, as events before the mark are in a batch run. Partial sums are combined
    before the shuffle, so one busy group costs one row per task. `distinct_on` names an event id to drop
    redelivered events within the watermark. Without `every` the stream stops when the folder is read.
    """
    events = parse_events(event_log).where("is_valid").withWatermark("event_time_utc", late)
    if distinct_on:
        events = events.dropDuplicatesWithinWatermark(distinct_on)
    return _start(
        ingest_workload_windows(events, width), lambda batch, _: _upsert(table, batch), checkpoint, every, "update"
    )


def stream_deadlocks(
    buffers: DataFrame, table: FactTable, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Event buffers into fact_deadlock. Reports that several buffers hold collapse on their natural key."""
    return _start(
        ingest_deadlocks(buffers), lambda batch, _: _upsert(table, batch), checkpoint, every, "append"
    )


def stream_facts(
    raw: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    table: FactTable,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Any ingest plan per micro-batch of raw snapshots, for example `ingest_waits`. A snapshot has to land
    in one file or folder drop, so that a micro-batch holds it whole."""
    return _start(raw, lambda batch, _: _upsert(table, build(batch)), checkpoint, every, "append")


def stream_tables(
    raw: Mapping[str, DataFrame],
    build: Callable[..., DataFrame],
    table: FactTable,
    checkpoint: str,
    late: str = "10 minutes",
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """An ingest plan over several raw tables that arrive on their own, for example `ingest_blocking`.

    Each stream among `raw` carries a poll time and is joined to the others on (instance, poll, ids), so a micro-batch may hold one table
    of a poll and a later one the rest: rows wait in state until their partners land. State is bounded by `late`: a row whose partner lands
    later than that behind the slowest table is dropped from it, and a row without a partner goes out of an outer join then. Frames
    that are no streams are name tables of current rows. Sums over a poll go out once the watermark has passed it.
    """
    timed = {n: f.withWatermark("snapshot_time_utc", late) if f.isStreaming else f for n, f in raw.items()}
    return _start(build(**timed, **options), lambda batch, _: _upsert(table, batch), checkpoint, every, "append")


def stream_unreadable(event_log: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Events of a log that `stream_workload` leaves out, as their time or numbers cannot be read: instance, time and text, below `path`.

    A retried micro-batch overwrites its own folder, so each landed event is kept once.
    """
    bad = parse_events(event_log).where("NOT is_valid").select("source_instance", "event_time_utc", "event_data")
    return _start(bad, lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch={n}"), checkpoint, every, "append")
