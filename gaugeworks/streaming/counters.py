"""Counter deltas on a stream of cumulative snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.operators.deltas import counter_delta
from gaugeworks.operators.ranking import latest_per_key
from gaugeworks.sources.files import remove


def stream_counter_deltas(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counters: Mapping[str, str],
    out: str,
    state: str,
    checkpoint: str,
    slot: str | None = "day",
    every: str | None = None,
) -> StreamingQuery:
    """Deltas of every snapshot against the one before it, micro-batch by micro-batch.

    Ordinary window functions are not allowed on streams, and Python state would pull one series through
    one worker. So each micro-batch is a batch plan: its rows plus the last row of every series so far go
    through `counter_delta`, whose time slots spread a dominant series. `state` keeps one row per series,
    written per batch id; a retried batch reads the state its predecessor left and overwrites its own
    output, so retries change nothing.

    Deltas land in `out`/deltas/batch=N. A row not later than its series' state arrived late: it lands in
    `out`/late/batch=N and does not touch the state.
    """
    names = stream.columns

    def read_or_empty(rows: DataFrame, path: str) -> DataFrame:
        try:
            return rows.sparkSession.read.schema(rows.schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return rows.limit(0)

    def step(batch: DataFrame, number: int) -> None:
        last = read_or_empty(batch, f"{state}/batch={number - 1}")
        held = last.select(*keys, F.struct(*order).alias("_held"))
        joined = batch.join(held, list(keys), "left")
        ahead = F.col("_held").isNull() | (F.struct(*order) > F.col("_held"))
        # Read three times below; a lost executor's share is computed again from the files.
        marked = joined.withColumn("_ahead", ahead).drop("_held").persist()
        fresh = marked.where("_ahead").select(*names)

        history = fresh.withColumn("_new", F.lit(True)).unionByName(last.withColumn("_new", F.lit(False)))
        deltas = counter_delta(history, keys, order, counters, slot=slot).where("_new").drop("_new")
        deltas.write.mode("overwrite").parquet(f"{out}/deltas/batch={number}")
        marked.where(~F.col("_ahead")).select(*names).write.mode("overwrite").parquet(f"{out}/late/batch={number}")
        newest = latest_per_key(fresh.unionByName(last), keys, order)
        newest.write.mode("overwrite").parquet(f"{state}/batch={number}")
        marked.unpersist()
        remove(batch.sparkSession, f"{state}/batch={number - 2}")  # a retry needs the previous state only

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
