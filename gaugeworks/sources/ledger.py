"""The run ledger: an append-only table of run states, and the marks incremental runs start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeworks.operators.ranking import latest_per_key
from gaugeworks.schemas import RUNS
from gaugeworks.settings import RECENT_RUNS
from gaugeworks.sources.fact_table import FactTable

# Run states in the order they follow each other.
STATES = ["running", "success", "failed"]


class RunLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.table = FactTable(spark, RUNS, path)

    def append(self, rows: DataFrame) -> None:
        """Add run states; each row belongs to the run named by (source_instance, task, started_at_utc)."""
        self.table.append(rows.withColumn("run_id", run_id()))

    def runs(self) -> DataFrame:
        return last_states(self.table.read())


def run_id() -> Column:
    return F.xxhash64("source_instance", "task", F.unix_micros("started_at_utc"))


def last_states(states: DataFrame) -> DataFrame:
    """One row per run, in its last state."""
    step = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("status"))
    return latest_per_key(states.withColumn("_step", step), ["run_id"], ["_step"]).drop("_step")


def recent_runs(runs: DataFrame, count: int = RECENT_RUNS) -> DataFrame:
    """The last runs by start time."""
    newest = [F.col("started_at_utc").desc(), F.col("run_id").desc()]
    return runs.orderBy(*newest).limit(count)


def run_marks(runs: DataFrame, task: str) -> DataFrame:
    """Per instance, the newest event time that successful runs of the task have taken in; runs that noted
    none count with their start time."""
    return (
        runs.where((F.col("task") == task) & (F.col("status") == "success"))
        .groupBy("source_instance")
        .agg(F.max(F.coalesce("high_water_utc", "started_at_utc")).alias("mark_utc"))
    )


def with_mark(events: DataFrame, marks: DataFrame | None) -> DataFrame:
    """Attach each instance's mark; NULL on a first run. Marks are as few as instances: events stay where they are, as a shuffle would bring
    all events of an instance into one task."""
    if marks is None:
        return events.withColumn("mark_utc", F.lit(None).cast("timestamp"))
    return events.join(F.broadcast(marks), "source_instance", "left")  # one mark per instance


def later(marked: DataFrame, time: Column, keep_unknown: bool = False) -> DataFrame:
    """Marked rows strictly later than their mark; `keep_unknown` also keeps those without a time."""
    wanted = F.col("mark_utc").isNull() | (time > F.col("mark_utc"))
    return marked.where(wanted | time.isNull() if keep_unknown else wanted)


def after_mark(events: DataFrame, marks: DataFrame | None, time: str) -> DataFrame:
    """Events strictly later than their instance's mark, with the mark attached."""
    return later(with_mark(events, marks), F.col(time))


def untaken(events: DataFrame, taken: DataFrame, identity: str, counted: bool) -> DataFrame:
    """Events of an overlapping read that no run has taken in yet: all behind their mark, and of those not later than it the ones that
    `taken` (source_instance, event_id, n) lacks.

    Equal events are `counted`: of five in the log and three taken in, two are new; or else they are one. Only the
    overlap is grouped, and equal events are combined before the shuffle. Events without a time are passed on.
    """
    ahead = F.col("mark_utc").isNull() | F.col("event_time_utc").isNull() | (F.col("event_time_utc") > F.col("mark_utc"))
    again = events.where(~ahead).withColumn("_id", event_id(identity))
    seen = again.groupBy("source_instance", "_id").agg(F.count(F.lit(1)).alias("_seen"), F.any_value(F.struct(*events.columns)).alias("_event"))
    known = taken.select(F.col("source_instance").alias("_instance"), F.col("event_id").alias("_known"), F.col("n").alias("_n"))
    same = F.col("source_instance").eqNullSafe(F.col("_instance")) & (F.col("_id") == F.col("_known"))
    left = F.col("_seen") - F.coalesce("_n", F.lit(0)) if counted else F.when(F.col("_n").isNull(), F.lit(1)).otherwise(0)
    fresh = seen.join(known, same, "left").withColumn("_left", left.cast("int")).where("_left > 0")
    return events.where(ahead).unionByName(fresh.select("_event.*", F.explode(F.sequence(F.lit(1), "_left")).alias("_copy")).drop("_copy"))


def event_id(identity: str) -> Column:
    return F.sha2(F.coalesce(F.col(identity), F.lit("")), 256)
