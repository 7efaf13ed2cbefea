"""Landed raw data: monitoring snapshots, event-log exports and JSON rowsets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.operators import names_at
from gaugeworks.settings import LAST_SYSTEM_DATABASE_ID


def read_raw(spark: SparkSession, path: str, columns: str, format: str = "parquet") -> DataFrame:
    """A landed monitoring table with declared columns (no inference)."""
    return spark.read.format(format).schema(columns).load(path)


def read_events(spark: SparkSession, glob: str, column: str = "event_data") -> DataFrame:
    """Exported event logs, one XML event per line, by path glob."""
    return spark.read.text(glob).withColumnRenamed("value", column)


def read_rowset(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A JSON file that holds an array of flat objects."""
    return spark.read.schema(columns).option("multiLine", True).json(path)


def stamp(
    df: DataFrame,
    source_instance: str | None = None,
    snapshot_time: dt.datetime | None = None,
    time_column: str = "snapshot_time_utc",
) -> DataFrame:
    """Tag a rowset with its instance and one snapshot time (a date when the column is a date column).
    Aware times are converted to UTC, naive ones are UTC already."""
    if source_instance is not None:
        df = df.withColumn("source_instance", F.lit(source_instance))
    if snapshot_time is not None:
        if snapshot_time.tzinfo is not None:
            snapshot_time = snapshot_time.astimezone(dt.timezone.utc).replace(tzinfo=None)
        moment = F.lit(snapshot_time.isoformat(sep=" "))
        kind = "date" if time_column.endswith("_date") else "timestamp"
        df = df.withColumn(time_column, moment.cast("timestamp").cast(kind))
    return df


def in_databases(
    df: DataFrame,
    configured: Sequence[str] | Mapping[str, Sequence[str]] | None = None,
    databases: DataFrame | None = None,
) -> DataFrame:
    """Rows of the selected databases: the configured names, for all instances or by instance; instances without names
    take every user database that `databases` (source_instance, database_id, name, state_desc) lists as online at the
    row's poll. Without a poll time, `databases` holds current rows."""
    key = ["source_instance", "database_name"]
    by_instance = isinstance(configured, Mapping)
    if configured and not by_instance:
        return df.where(F.col("database_name").isin(list(configured)))
    if databases is None and not configured:
        raise ValueError("give database names or a databases table")
    chosen = None
    if configured:
        pairs = [(instance, name) for instance, names in configured.items() for name in names]
        wanted = df.sparkSession.createDataFrame(pairs, "source_instance string, database_name string")
        chosen = df.join(wanted, key, "left_semi").select(*df.columns)
        if databases is None:
            return chosen
        instances = [instance for instance, names in configured.items() if names]
        df = df.where(~F.col("source_instance").isin(instances))
    users = databases.where(F.col("database_id") > LAST_SYSTEM_DATABASE_ID).withColumn("database_name", F.col("name"))
    if "snapshot_time_utc" not in users.columns:
        users = users.groupBy(*key).agg(F.max((F.col("state_desc") == "ONLINE").cast("int")).alias("_online"))
    else:
        users = users.withColumn("_online", (F.col("state_desc") == "ONLINE").cast("int"))
    online = names_at(df, users, key, {"_is_online": "_online"}, "inner").where("_is_online = 1").drop("_is_online")
    online = online.select(*df.columns)
    return online if chosen is None else chosen.unionByName(online)
