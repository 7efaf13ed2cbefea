"""Running an ingest task: compute, upsert, record. One run covers the whole fleet."""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeworks import settings
from gaugeworks.plans.ingest import DAILY, IDENTITY, INCREMENTAL, SEQUENCE, TASKS
from gaugeworks.schemas import RULE_COLUMNS, TABLES, TAKEN
from gaugeworks.session import scratch_path
from gaugeworks.sources.fact_table import FactTable
from gaugeworks.sources.files import remove
from gaugeworks.sources.ledger import RunLedger, event_id, run_id, run_marks, untaken

FLEET = "*"  # instance name of a ledger row that stands for a whole run


class Store:
    """The fact tables and the run ledger below one root path."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ledger = RunLedger(spark, f"{self.root}/collection_run")
        self.on_write: list[Callable[[str], None]] = []

    def table(self, name: str) -> FactTable:
        return FactTable(self.spark, TABLES[name], f"{self.root}/{name}", self._written)

    def _written(self, name: str) -> None:
        for follow in self.on_write:
            follow(name)

    def facts(self, since: dt.date | None = None, until: dt.date | None = None) -> dict[str, DataFrame]:
        """Every fact table; the bounds (inclusive days) prune its partitions."""
        return {name: self.table(name).read(since, until) for name in TABLES}

    def rules(self) -> DataFrame:
        """The rule table, seeded with the default rules while it does not exist."""
        path = f"{self.root}/dim_workload_class"
        seed_rules(self.spark).write.mode("ignore").parquet(path)
        return self.spark.read.schema(RULE_COLUMNS).parquet(path)

    def quarantine_path(self, task: str) -> str:
        return f"{self.root}/quarantine_{task}"

    def quarantine(self, task: str) -> DataFrame:
        """Events that runs of the task could not read, with the time of the run that set them aside."""
        columns = "source_instance string, event_time_utc timestamp, event_data string, started_at_utc timestamp"
        try:
            return self.spark.read.schema(columns).parquet(self.quarantine_path(task))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], columns)

    def _taken(self) -> FactTable:
        return FactTable(self.spark, TAKEN, f"{self.root}/{TAKEN.name}")

    def taken(self, task: str, since: dt.date | None = None) -> DataFrame:
        """source_instance, event_id and n: events that successful runs of an incremental task have taken in, from a day on."""
        done = self.ledger.runs().where((F.col("task") == task) & (F.col("status") == "success")).select("run_id")
        rows = self._taken().read(since).where(F.col("task") == task).join(done, "run_id", "left_semi")
        once = rows.groupBy("source_instance", "event_id", "run_id").agg(F.max("n").alias("n"))  # a run that was repeated noted them twice
        return once.groupBy("source_instance", "event_id").agg(F.sum("n").alias("n"))

    def _expire_taken(self, as_of: dt.datetime) -> None:
        """What lies two days before every mark is read by no run again."""
        runs = self.ledger.runs().where("high_water_utc IS NOT NULL AND status = 'success'")
        newest = runs.groupBy("source_instance", "task").agg(F.max("high_water_utc").alias("mark"))
        oldest = newest.agg(F.min("mark")).first()[0]
        taken = self._taken()
        taken.purge(as_of if oldest is None else min(as_of, oldest))
        taken.discard_staged()

    def purge(self, as_of: dt.datetime, retention_days: Mapping[str, int] | None = None) -> dict[str, list[str]]:
        """Expire every fact table and the ledger; `retention_days` overrides the tables' own."""
        days = retention_days or {}
        dropped = {}
        self._expire_taken(as_of)
        for table in [*map(self.table, TABLES), self.ledger.table]:
            dropped[table.spec.name] = table.purge(as_of, days.get(table.spec.name))
            table.discard_staged()
        return dropped


def seed_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(settings.SEED_RULES, RULE_COLUMNS)


def run_task(
    store: Store,
    task: str,
    raw: Mapping[str, DataFrame],
    started_at: dt.datetime,
    dry_run: bool = False,
    overlap: dt.timedelta = dt.timedelta(seconds=settings.EVENT_OVERLAP_SECONDS),
    **options,
) -> int:
    """Ingest one task and return its row count. A dry run computes and counts, and writes nothing.

    The ledger gets a `running` row per run, then one `success` row per instance of the raw input, also for those with
    nothing to report. One plan covers the fleet; if it fails while running, the instances are halved and tried again until
    those that cannot be ingested stand alone: they get a `failed` row each and do not stop the others. The error is raised
    if no instance is left, or if the plan itself cannot be built.

    Incremental tasks start from the ledger's marks, less the `overlap`: events that reached the log late, or share the mark's time, are
    found there, and those that an earlier run took in are left out by their ids. They count in the window of the run that finds
    them. What is taken in is parsed once into a staged copy, and the new mark, the facts and the events set aside all come from that
    copy, so that events that arrive meanwhile wait for the next run. Events that cannot be read go to `store.quarantine(task)`.
    """
    raw = dict(raw)
    if task in INCREMENTAL and "marks" not in raw:
        # An incremental run without a noted time has seen no event yet, so it moves no mark.
        raw["marks"] = run_marks(store.ledger.runs().where("high_water_utc IS NOT NULL"), task)
    run = _Run(store, task, started_at, options, overlap)
    if dry_run:
        return run.build(raw).count()
    run.note([FLEET], "running")
    try:
        instances = _instances(raw)
        total = run.attempt(raw, instances)
    except Exception as error:
        run.note([FLEET], "failed", error=_text(error))
        raise
    finally:
        run.discard_staged()
    if not run.failed:
        run.note([FLEET], "success", total)
        return total
    names = ", ".join(sorted(str(name) for name in run.failed))
    first = next(iter(run.failed.values()))
    run.note([FLEET], "failed", total, f"{len(run.failed)} of {len(instances)} instances: {names}\n{_text(first)}")
    if len(run.failed) == len(instances):
        raise first
    return total


def _text(error: Exception) -> str:
    return f"{error}\n" + "".join(traceback.format_exception(error))


def _instances(raw: Mapping[str, DataFrame]) -> list[str | None]:
    """Names of the servers in the raw input (one column of each frame; a fleet's names fit the driver)."""
    frames = [f.select("source_instance") for name, f in raw.items() if name != "marks" and "source_instance" in f.columns]
    return [row[0] for row in reduce(DataFrame.unionByName, frames).distinct().collect()]


class _Run:
    """One run of a task: its ledger rows, its staged copies and the instances that failed."""

    def __init__(self, store: Store, task: str, started_at: dt.datetime, options: Mapping, overlap: dt.timedelta):
        self.store, self.task, self.started_at, self.options, self.overlap = store, task, started_at, options, overlap
        self.target = store.table(TASKS[task][0])
        self.failed: dict[str | None, Exception] = {}
        self._staged: list[str] = []

    def note(self, instances: list, status: str, rows: int | None = None, error: str | None = None) -> None:
        names = self.store.spark.createDataFrame([(name,) for name in instances], "source_instance string")
        self._append(names, status, F.lit(rows), F.lit(error), F.lit(None))

    def _append(self, names: DataFrame, status: str, rows: Column, error: Column, mark: Column) -> None:
        self.store.ledger.append(
            names.select(
                "source_instance",
                F.lit(self.task).alias("task"),
                F.lit(self.started_at).cast("timestamp").alias("started_at_utc"),
                (F.lit(None).cast("timestamp") if status == "running" else F.current_timestamp()).alias("ended_at_utc"),
                F.lit(status).alias("status"),
                rows.cast("long").alias("row_count"),
                error.cast("string").alias("error_message"),
                mark.cast("timestamp").alias("high_water_utc"),
            )
        )

    def attempt(self, raw: Mapping[str, DataFrame], instances: list) -> int:
        try:
            return self._ingest(raw, instances)
        except AnalysisException:  # the plan is wrong, for every instance
            raise
        except Exception as error:
            if len(instances) <= 1:
                self.note(instances or [FLEET], "failed", error=_text(error))
                self.failed[instances[0] if instances else FLEET] = error
                return 0
            half = len(instances) // 2
            return sum(self.attempt(_only(raw, part), part) for part in (instances[:half], instances[half:]))

    def build(self, raw: Mapping[str, DataFrame]) -> DataFrame:
        """The run's fact rows, nothing written or staged."""
        if self.task in INCREMENTAL:
            return INCREMENTAL[self.task][1](self._events(raw), **self.options)
        daily = {"sequenced": True} if self.task in DAILY else {}
        return TASKS[self.task][1](**raw, **daily, **self.options)

    def _events(self, raw: Mapping[str, DataFrame]) -> DataFrame:
        """What an incremental task takes in: events behind their mark, and those of the overlap that no run has taken in."""
        back = F.expr(f"INTERVAL {round(self.overlap.total_seconds() * 1e6)} MICROSECONDS")
        oldest = raw["marks"].agg(F.min("mark_utc")).first()[0]
        lowered = raw["marks"].withColumn("mark_utc", F.col("mark_utc") - back)
        read = INCREMENTAL[self.task][0](**{**raw, "marks": lowered}).withColumn("mark_utc", F.col("mark_utc") + back)
        if oldest is None:
            return read  # a first run
        taken = self.store.taken(self.task, (oldest - self.overlap).date())
        return untaken(read, taken, *IDENTITY[self.task])

    def _note_taken(self, events: DataFrame, marks: DataFrame) -> None:
        """Ids of the events that the next run reads again."""
        back = F.expr(f"INTERVAL {round(self.overlap.total_seconds() * 1e6)} MICROSECONDS")
        near = events.join(marks, F.col("source_instance").eqNullSafe(F.col("_instance"))).where(F.col("event_time_utc") > F.col("_mark") - back)
        named = near.select(
            "source_instance", F.lit(self.task).alias("task"), F.lit(self.started_at).cast("timestamp").alias("started_at_utc"),
            "event_time_utc", event_id(IDENTITY[self.task][0]).alias("event_id"),
        )
        counts = named.withColumn("run_id", run_id()).groupBy("source_instance", "task", "run_id", "event_time_utc", "event_id")
        self.store._taken().append(counts.agg(F.count(F.lit(1)).alias("n")))

    def _ingest(self, raw: Mapping[str, DataFrame], instances: list) -> int:
        names = self.store.spark.createDataFrame([(name,) for name in instances], "source_instance string")
        same = lambda other: F.col("source_instance").eqNullSafe(other["_instance"])
        bad = marks = None
        if self.task in INCREMENTAL:
            events = self._stage(self._events(raw))
            built = INCREMENTAL[self.task][1](events, **self.options)
            newest = events.groupBy(F.col("source_instance").alias("_instance"), F.col("mark_utc").alias("_old")).agg(
                F.max("event_time_utc").alias("_newest"), F.min("event_time_utc").alias("_first")
            )
            # a mark lies behind the start of its run's window, so that no two runs share one
            start = F.coalesce("_old", "_first")
            moved = F.when(F.col("_newest") <= start, start + F.expr("INTERVAL 1 MICROSECOND")).otherwise(F.greatest("_newest", "_old"))
            marks = newest.select("_instance", moved.alias("_mark"))
            if "is_valid" in events.columns:
                bad = self._set_aside(events.where(~F.col("is_valid")))
        else:
            built = self.build(raw)
        written = self.target.upsert(built, [SEQUENCE] if self.task in DAILY else [])
        counts = written.groupBy(F.col("source_instance").alias("_instance")).agg(F.count(F.lit(1)).alias("_rows"))
        done = names.join(counts, same(counts), "left").drop("_instance")
        mark, error = F.lit(None), F.lit(None)
        if marks is not None:
            self._note_taken(events, marks)
            done = done.join(marks, same(marks), "left").drop("_instance")
            old = raw["marks"].select(F.col("source_instance").alias("_instance"), F.col("mark_utc").alias("_old"))
            done = done.join(old, same(old), "left").drop("_instance")
            mark = F.coalesce("_mark", "_old")
        if bad is not None:
            aside = bad.groupBy(F.col("source_instance").alias("_instance")).agg(F.count(F.lit(1)).alias("_bad"))
            done = done.join(aside, same(aside), "left").drop("_instance")
            error = F.when(F.col("_bad") > 0, F.concat(F.col("_bad").cast("string"), F.lit(" events set aside")))
        self._append(done, "success", F.coalesce("_rows", F.lit(0)), error, mark)
        return written.count()

    def _set_aside(self, bad: DataFrame) -> DataFrame:
        """Add unreadable events to the quarantine, each once however often it is read; returns the new ones."""
        path = self.store.quarantine_path(self.task)
        known = self.store.quarantine(self.task)
        rows = bad.select("source_instance", "event_time_utc", "event_data").dropDuplicates(["source_instance", "event_data"])
        old = known.select(F.col("source_instance").alias("_instance"), F.col("event_data").alias("_data"))
        same = F.col("source_instance").eqNullSafe(F.col("_instance")) & F.col("event_data").eqNullSafe(F.col("_data"))
        fresh = self._stage(rows.join(old, same, "left_anti"))
        if not fresh.isEmpty():
            fresh.withColumn("started_at_utc", F.lit(self.started_at).cast("timestamp")).write.mode("append").parquet(path)
        return fresh

    def _stage(self, rows: DataFrame) -> DataFrame:
        path = scratch_path(self.store.spark, f"run-{self.task}")
        self._staged.append(path)
        rows.write.parquet(path)
        return self.store.spark.read.schema(rows.schema).parquet(path)

    def discard_staged(self) -> None:
        self.target.discard_staged()
        while self._staged:
            remove(self.store.spark, self._staged.pop())


def _only(raw: Mapping[str, DataFrame], instances: list) -> dict[str, DataFrame]:
    """The raw frames, cut to some instances."""
    column = F.col("source_instance")
    known = column.isin([name for name in instances if name is not None])
    wanted = known | column.isNull() if None in instances else known
    return {name: f.where(wanted) if "source_instance" in f.columns else f for name, f in raw.items()}
