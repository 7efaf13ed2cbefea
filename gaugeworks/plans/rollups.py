"""Reports from daily partial results that follow their facts.

A rollup keeps, per day of its fact table, what the report needs of that day: sums and counts, or, for reports over counter deltas, the
deltas and the last known counters. Each day folder carries a mark of the fact files it was made from. After a write
only the days whose files changed are read again; a report reads partial rows, not history.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F

from gaugeworks import settings
from gaugeworks.functions.scalar import mean, safe_ratio
from gaugeworks.operators import first_match, rank_within
from gaugeworks.plans.jobs import Store
from gaugeworks.plans.reports import TABLE
from gaugeworks.session import shuffles_released
from gaugeworks.sources.fact_table import DAY, day_folders, pieces
from gaugeworks.sources.files import list_files, read_text, remove, write_text

MARK = "_made_from"  # readers pass over names with an underscore


@dataclass(frozen=True)
class Rollup:
    """`partial` makes one day's rows from that day's facts; `finish` makes the report from all of them."""

    source: str
    columns: str
    partial: Callable[[DataFrame], DataFrame]
    finish: Callable[..., DataFrame]


def _workload(*by: str) -> Callable[[DataFrame], DataFrame]:
    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy("source_instance", *by, DAY).agg(
            F.sum("total_cpu_ms").alias("total_cpu_ms"),
            F.sum("total_logical_reads").alias("total_logical_reads"),
            F.sum("exec_count").alias("exec_count"),
        )

    return partial


def _added(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.sum("total_cpu_ms").alias("total_cpu_ms"),
        F.sum("total_logical_reads").alias("total_logical_reads"),
        F.sum("exec_count").alias("exec_count"),
    )


def _top_logins(rows: DataFrame) -> DataFrame:
    totals = _added(rows, "source_instance", "login_name")
    return rank_within(totals, ["source_instance"], {"cpu_rank": "total_cpu_ms", "reads_rank": "total_logical_reads"})


def _by_category(rows: DataFrame, rules=settings.SEED_RULES, case_sensitive: bool = False) -> DataFrame:  # noqa: ANN001
    """Programs are classified here and not in the partial rows, so that new rules need no new rollup."""
    labelled = first_match(rows, rules, "program_name", "workload_category", settings.UNKNOWN_CATEGORY, case_sensitive)
    return _added(labelled, "source_instance", "window_start_utc", "workload_category")


def _cpu_hours(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_instance", F.hour("sample_time_utc").alias("hour_of_day"), DAY).agg(
        F.sum("sql_cpu_pct").alias("total"), F.count("sql_cpu_pct").alias("n")
    )


def _heatmap(rows: DataFrame) -> DataFrame:
    by = ["source_instance", F.date_format(DAY, "EEEE").alias("day_of_week"), "hour_of_day"]
    share = F.round(F.sum("total").cast("double") / F.nullif(F.sum("n"), F.lit(0)), 6)
    return rows.groupBy(*by).agg(share.alias("avg_sql_cpu_pct"))


SUMS = "total_cpu_ms decimal(28,2), total_logical_reads long, exec_count long"
ROLLUPS: dict[str, Rollup] = {
    "top_logins": Rollup("fact_workload", f"source_instance string, login_name string, {SUMS}", _workload("login_name"), _top_logins),
    "workload_by_category": Rollup(
        "fact_workload",
        f"source_instance string, window_start_utc timestamp, program_name string, {SUMS}",
        _workload("window_start_utc", "program_name"),
        _by_category,
    ),
    "cpu_hour_heatmap": Rollup("fact_cpu", "source_instance string, hour_of_day int, total long, n long", _cpu_hours, _heatmap),
}

COUNTERS = {"scans_cum": "scans_day", "seeks_cum": "seeks_day", "lookups_cum": "lookups_day", "updates_cum": "writes_day"}
ACCESS_COLUMNS = ", ".join(
    [*(f"{c} string" for c in TABLE), "held_date date", "prior_date date", *(f"{c} long" for c in [*COUNTERS, *COUNTERS.values()])]
)


def access_days(rows: DataFrame, held: DataFrame, days: list[dt.date]) -> DataFrame:
    """For each of `days` the last known counters of every table, and the deltas of the tables that have a row on it.

    `rows` are the facts of these days and `held` what was known before the first of them. `prior_date` is the day
    a delta counts from; it is empty on a table's first row. A table has one row a day, so its window group is small.
    """
    before = held.select(*TABLE, F.col("held_date").alias(DAY), *COUNTERS, F.lit(False).alias("_new"))
    both = before.unionByName(rows.select(*TABLE, DAY, *COUNTERS, F.lit(True).alias("_new")))
    series = Window.partitionBy(*TABLE).orderBy(DAY)
    prior = {c: F.lag(c).over(series) for c in COUNTERS}
    steps = {name: F.when(F.col(c) >= prior[c], F.col(c) - prior[c]).otherwise(F.col(c)) for c, name in COUNTERS.items()}
    known = both.withColumns({"prior_date": F.lag(DAY).over(series), "_next": F.lead(DAY).over(series), **steps})
    known = known.withColumnRenamed(DAY, "held_date")
    listed = F.array(*[F.lit(d) for d in days])  # calendar days of the write
    span = F.filter(listed, lambda d: (d >= F.col("held_date")) & (F.col("_next").isNull() | (d < F.col("_next"))))
    spread = known.withColumn(DAY, F.explode(span))
    own = F.col("_new") & (F.col(DAY) == F.col("held_date")) & F.col("prior_date").isNotNull()
    gone = {name: F.when(own, F.col(name)) for name in COUNTERS.values()}
    return spread.withColumns({**gone, "prior_date": F.when(own, F.col("prior_date"))}).drop("_new", "_next")


def _access_trend(rows: DataFrame, first: dt.date | None, as_of: dt.datetime, days: int = settings.TREND_DAYS) -> DataFrame:
    """Deltas that count from an expired day are left out, as the history has no row before them."""
    since = as_of.date() - dt.timedelta(days=days)
    daily = rows.where(F.col("prior_date").isNotNull() & (F.col("prior_date") >= F.lit(first)) & (F.col(DAY) >= F.lit(since)))
    reads = F.col("scans_day") + F.col("seeks_day") + F.col("lookups_day")
    totals = daily.groupBy(*TABLE).agg(
        mean(reads).alias("avg_reads_per_day"),
        mean(F.col("scans_day")).alias("avg_scans_per_day"),
        mean(F.col("writes_day")).alias("avg_writes_per_day"),
        F.sum("scans_day").alias("total_scans"),
        F.sum("seeks_day").alias("total_seeks"),
    )
    return totals.withColumn("scan_ratio", safe_ratio(F.col("total_scans"), F.col("total_seeks")))


class Rollups:
    """The rollups of a store, below `<root>/rollup`, brought up to date after each write of the store's tables.

    A crash between a write and its rollup leaves days whose mark does not fit their files; `refresh` finds and makes them, as it makes
    all days the first time. Like the tables, rollups have one writer at a time.
    """

    def __init__(self, store: Store):
        self.store, self.spark = store, store.spark
        store.on_write.append(self._written)

    def close(self) -> None:
        self.store.on_write.remove(self._written)

    def refresh(self) -> dict[str, list[dt.date]]:
        """Make what is out of date; the days made, by rollup."""
        return {name: self._follow(name) for name in [*ROLLUPS, "table_access_trend"]}

    def report(self, name: str, *args, **options) -> DataFrame:  # noqa: ANN002, ANN003
        """A report from its rollup; takes the arguments that the report takes behind its fact frames."""
        if name == "table_access_trend":
            return _access_trend(self._read(name), min(self._days(name), default=None), *args, **options)
        return ROLLUPS[name].finish(self._read(name), *args, **options)

    def _written(self, table: str) -> None:
        for name in [*ROLLUPS, "table_access_trend"]:
            if self._source(name) == table:
                self._follow(name)

    @staticmethod
    def _source(name: str) -> str:
        return "fact_table_usage" if name == "table_access_trend" else ROLLUPS[name].source

    def _path(self, name: str) -> str:
        return f"{self.store.root}/rollup/{name}"

    def _read(self, name: str) -> DataFrame:
        columns = f"{ACCESS_COLUMNS if name == 'table_access_trend' else ROLLUPS[name].columns}, {DAY} date"
        try:
            return self.spark.read.schema(columns).parquet(self._path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], columns)

    def _days(self, name: str) -> dict[dt.date, str]:
        """Days of the fact table, each with a mark of its files."""
        table = self.store.table(self._source(name))
        return {day: self._mark(f"{table.path}/{folder}") for folder, day in table.day_folders()}

    def _mark(self, folder: str) -> str:
        return hashlib.sha256(repr(sorted(list_files(self.spark, folder))).encode()).hexdigest()

    def stale(self, name: str) -> tuple[list[dt.date], list[dt.date], dict[dt.date, str]]:
        """Days to make, days to remove, and the marks of all."""
        marks, path = self._days(name), self._path(name)
        made = {day: read_text(self.spark, f"{path}/{DAY}={day}/{MARK}") for day in self._made(name)}
        return [d for d in sorted(marks) if made.get(d) != marks[d]], [d for d in sorted(made) if d not in marks], marks

    def _made(self, name: str) -> list[dt.date]:
        return [day for _, day in day_folders(self.spark, self._path(name))]

    def _follow(self, name: str) -> list[dt.date]:
        days, gone, marks = self.stale(name)
        for day in gone:
            remove(self.spark, f"{self._path(name)}/{DAY}={day}")
        if name == "table_access_trend":
            left = [d for d in sorted(marks) if any(g < d for g in gone if g > min(marks))]  # a day lost amid others: the next ones count anew
            days = [d for d in sorted(marks) if d >= min([*days, *left])] if days or left else []
        if not days:
            return []
        for part in [days] if name == "table_access_trend" else self._pieces(name, days):
            with shuffles_released(self.spark):
                rows = self.partial(name, part).hint("rebalance", F.col(DAY))
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(self._path(name))
            for day in part:
                write_text(self.spark, f"{self._path(name)}/{DAY}={day}/{MARK}", marks[day])
        return days

    def _pieces(self, name: str, days: list[dt.date]) -> list[list[dt.date]]:
        """Days whose facts are read together: one day's sums need no other's, and what is shuffled goes before the next piece."""
        path = self.store.table(self._source(name)).path
        return pieces({d: sum(size for _, size, _ in list_files(self.spark, f"{path}/{DAY}={d}")) for d in days})

    def partial(self, name: str, days: Iterable[dt.date]) -> DataFrame:
        """Partial rows of some days, from the facts of these days alone; access deltas also take what was known the day before."""
        days = sorted(days)
        facts = self.store.table(self._source(name)).read_days(days)
        if name != "table_access_trend":
            rollup = ROLLUPS[name]
            kinds = [part.split(" ")[:2] for part in rollup.columns.split(", ")]
            return rollup.partial(facts).select(*[F.col(c).cast(kind) for c, kind in kinds], DAY)
        earlier = [d for d in self._days(name) if d < days[0]]
        first = min([*earlier, days[0]])
        last = max(earlier, default=None)
        held = self._read(name).where(F.col(DAY) == F.lit(last)) if last else self._read(name).limit(0)
        held = held.where(F.col("held_date") >= F.lit(first))  # what only expired days knew is unknown
        kinds = [part.split(" ")[:2] for part in ACCESS_COLUMNS.split(", ")]
        return access_days(facts, held, days).select(*[F.col(c).cast(kind) for c, kind in kinds], DAY)
