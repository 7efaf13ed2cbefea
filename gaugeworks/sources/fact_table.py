"""Parquet fact tables partitioned by day: upsert by natural key and retention by age."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeworks.schemas import TableSpec
from gaugeworks.session import scratch_path, shuffles_released
from gaugeworks.sources.files import list_files, list_names, remove

DAY = "day"
PIECES = 16  # a write over many days goes by about so many runs of days, one after the other ...
PIECE_BYTES = 64 << 20  # ... of this many bytes at least
CODEC = "zstd"  # names and hashes are most of a fact's bytes


class FactTable:
    """One fact table below `path`, laid out as day=YYYY-MM-DD directories.

    Writers go through staged copies in the shared scratch folder, so a lost executor costs a task retry and
    no stage ever reads files it replaces. Each day directory is replaced as a whole; a write that touches
    several days is not atomic across them, and rerunning it gives the same table.
    """

    def __init__(self, spark: SparkSession, spec: TableSpec, path: str, on_write: Callable[[str], None] | None = None):
        self.spark = spark
        self.spec = spec
        self.path = path.rstrip("/")
        self._staged: list[str] = []
        self._on_write = on_write  # called with the table's name after each change of its files

    def _changed(self) -> None:
        if self._on_write is not None:
            self._on_write(self.spec.name)

    @property
    def _columns(self) -> str:
        return f"{self.spec.columns}, {DAY} date"

    @property
    def undated_path(self) -> str:
        return f"{self.path}_undated"

    def _load(self) -> DataFrame:
        try:
            return self.spark.read.schema(self._columns).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self._columns)

    def read(self, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """The table's rows; the bounds (inclusive days) prune partitions. In tables dated by day, filters on
        the date column prune them too, as it is the partition column that is shown."""
        rows = self._load()
        if since is not None:
            rows = rows.where(F.col(DAY) >= F.lit(since))
        if until is not None:
            rows = rows.where(F.col(DAY) <= F.lit(until))
        if self.spec.types[self.spec.time] == "date":
            rows = rows.withColumn(self.spec.time, F.col(DAY))
        return rows.drop(DAY)

    def append(self, rows: DataFrame) -> None:
        """Add rows without looking at keys, for tables that only ever grow."""
        self._write(rows.select(*self.spec.names).withColumn(DAY, F.to_date(self.spec.time)), "append")

    def _last_of_batch(self, batch: DataFrame, sequence: Sequence[str]) -> DataFrame:
        """One row per key: the last by `sequence`, then by the remaining columns so that a rerun agrees."""
        others = [c for c in self.spec.names if c not in self.spec.key]
        order = [F.col(c).desc() for c in [*sequence, *others]]
        lone = F.when(F.col(DAY).isNull(), F.monotonically_increasing_id())  # rows without a day replace nothing
        newest = Window.partitionBy(*self.spec.key, lone).orderBy(*order)
        return batch.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")

    def _stage(self, rows: DataFrame) -> DataFrame:
        """Write rows to the shared scratch folder and read them back."""
        target = scratch_path(self.spark, f"stage-{self.spec.name}")
        self._staged.append(target)
        return self._staged_rows(rows, target, "errorifexists")

    def _staged_rows(self, rows: DataFrame, target: str, mode: str) -> DataFrame:
        with shuffles_released(rows.sparkSession):
            rows.select("*").write.mode(mode).option("compression", CODEC).parquet(target)
        return self.spark.read.schema(rows.schema).parquet(target)

    def _write(self, rows: DataFrame, mode: str) -> None:
        self._put(rows, mode)
        self._changed()

    def _put(self, rows: DataFrame, mode: str) -> None:
        # Rebalancing by day keeps files near the advisory size: small days are merged into one task, a
        # day that holds most of the rows is split over many.
        with shuffles_released(rows.sparkSession):
            (
                rows.hint("rebalance", F.col(DAY))
                .write.mode(mode)
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", CODEC)
                .partitionBy(DAY)
                .parquet(self.path)
            )

    def upsert(self, batch: DataFrame, sequence: Sequence[str] = ()) -> DataFrame:
        """Insert or replace by natural key (NULL key parts match each other); returns the batch's rows as
        written. A replayed batch leaves the table unchanged.

        Rows without a time belong to no day. They are set aside, all of them, in the folder `undated_path` and are not part of the table.

        The batch is computed once, into a staged copy in order of days. The table follows it by pieces, runs of
        days, so that what is shuffled on the way is a part of the batch and gone before the next piece. Only the
        days it touches are read, and none where all its days are new. A piece whose keys are all new is appended;
        otherwise its days are rewritten from the rows it does not replace plus its own. The returned frame reads
        the staged copy, see `discard_staged`.
        """
        extra = [c for c in sequence if c not in self.spec.names]
        typed = [F.col(c).cast(kind).alias(c) for c, kind in self.spec.types.items()]  # files hold the declared types
        dated = batch.select(*typed, *extra).withColumn(DAY, F.to_date(self.spec.time))
        everything = self._stage(dated.sortWithinPartitions(DAY))
        counts = self._rows_a_day(everything)
        if counts.pop(None, 0):
            everything.where(F.col(DAY).isNull()).drop(DAY, *extra).write.mode("append").parquet(self.undated_path)
        staged = everything.where(F.col(DAY).isNotNull())
        if not counts:
            return staged.drop(DAY, *extra)
        pieces = self._pieces(counts)
        if self._repeats(staged):
            staged = self._only_last(staged, pieces, sequence)
        staged = staged.drop(*extra)
        before = {day for _, day in self.day_folders()}
        for days in pieces:
            self._merge(staged.where(_within(days)), [d for d in days if d in before])
        self._changed()
        return staged.drop(DAY)

    def _rows_a_day(self, rows: DataFrame) -> dict[dt.date | None, int]:
        with shuffles_released(self.spark):
            return {row[0]: row[1] for row in rows.groupBy(DAY).agg(F.count(F.lit(1))).collect()}  # calendar days only

    def _pieces(self, counts: Mapping[dt.date, int]) -> list[list[dt.date]]:
        """The days of the copy staged last, by its bytes."""
        size = sum(length for _, length, _ in list_files(self.spark, self._staged[-1]))
        return pieces({day: size * n / sum(counts.values()) for day, n in counts.items()})

    def _repeats(self, rows: DataFrame) -> bool:
        """Whether two rows may share a key: only a number stands for each key, so that few bytes are shuffled."""
        with shuffles_released(self.spark):
            number = F.xxhash64(*self.spec.key, *[F.col(c).isNull() for c in self.spec.key])
            return not rows.groupBy(number.alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()

    def _only_last(self, rows: DataFrame, pieces: Sequence[Sequence[dt.date]], sequence: Sequence[str]) -> DataFrame:
        """Another staged copy, of the last row of each key, in place of the one staged last. A key has one day."""
        first, target = self._staged[-1], scratch_path(self.spark, f"stage-{self.spec.name}")
        self._staged.append(target)
        for days in pieces:
            kept = self._staged_rows(self._last_of_batch(rows.where(_within(days)), sequence), target, "append")
        remove(self.spark, first)
        self._staged.remove(first)
        return kept

    def _merge(self, fresh: DataFrame, known: Sequence[dt.date]) -> None:
        """Bring some days of a batch into the table; `known` are those of them that it has."""
        if not known:
            return self._put(fresh, "append")
        old = self._load().where(F.col(DAY).isin(list(known)))
        keys = fresh.select(*[F.col(c).alias(f"_k_{c}") for c in self.spec.key], F.col(DAY).alias("_k_day"))
        same = F.col(DAY) == F.col("_k_day")
        for c in self.spec.key:
            same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        with shuffles_released(self.spark):
            if old.join(keys, same, "left_semi").isEmpty():
                return self._put(fresh, "append")
        # The staged batch is usually the small side, so the anti join broadcasts it once its measured size allows
        # and leaves the old rows where they are.
        self._put(self._stage(old.join(keys, same, "left_anti").unionByName(fresh)), "overwrite")
        remove(self.spark, self._staged.pop())

    def purge(self, as_of: dt.datetime, days: int | None = None) -> list[str]:
        """Delete rows older than `days` before `as_of` (strictly older). Whole days are dropped as
        directories, the boundary day is rewritten; returns the days dropped."""
        cut = as_of - dt.timedelta(days=self.spec.retention_days if days is None else days)
        time_is_date = self.spec.types[self.spec.time] == "date"
        boundary = cut.date()
        dropped = []
        for name, day in self.day_folders():
            if day < boundary:
                remove(self.spark, f"{self.path}/{name}")
                dropped.append(name)
        if not time_is_date:
            edge = self._load().where(F.col(DAY) == F.lit(boundary))
            kept = edge.where(F.col(self.spec.time) >= F.lit(cut))
            if not edge.where(F.col(self.spec.time) < F.lit(cut)).isEmpty():
                staged = self._stage(kept)
                if staged.isEmpty():
                    remove(self.spark, f"{self.path}/{DAY}={boundary}")
                    dropped.append(f"{DAY}={boundary}")
                else:
                    self._write(staged, "overwrite")
        if dropped:
            self._changed()
        return dropped

    def day_folders(self) -> list[tuple[str, dt.date]]:
        return day_folders(self.spark, self.path)

    def read_days(self, days: Sequence[dt.date]) -> DataFrame:
        """The rows of some days, with their day; only these days' folders are read."""
        rows = self._load().where(F.col(DAY).isin(list(days)))
        return rows.withColumn(self.spec.time, F.col(DAY)) if self.spec.types[self.spec.time] == "date" else rows

    def discard_staged(self) -> None:
        """Remove the staged copies of this object's writes; frames that `upsert` returned end with them."""
        while self._staged:
            remove(self.spark, self._staged.pop())


def _within(days: Sequence[dt.date]) -> Column:
    """A range, which readers of files in order of days check against the least and the greatest day of their pages."""
    return F.col(DAY).between(F.lit(min(days)), F.lit(max(days)))


def pieces(sizes: Mapping[dt.date, float]) -> list[list[dt.date]]:
    """Runs of days, in order, of a `PIECES`-th of all bytes or `PIECE_BYTES`, whichever is more; a day is never cut."""
    most = max(PIECE_BYTES, sum(sizes.values()) / PIECES)
    runs: list[list[dt.date]] = []
    room = 0.0
    for day in sorted(sizes):
        if not runs or sizes[day] > room:
            runs.append([])
            room = most
        runs[-1].append(day)
        room -= sizes[day]
    return runs


def day_folders(spark: SparkSession, path: str) -> list[tuple[str, dt.date]]:
    """Names and days of a table's day directories, in order."""
    dated = [re.fullmatch(rf"{DAY}=(\d{{4}}-\d\d-\d\d)", n) for n in list_names(spark, path)]
    return sorted((m.group(), dt.date.fromisoformat(m.group(1))) for m in dated if m)
