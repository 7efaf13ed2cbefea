"""Reset-safe differences of cumulative counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.operators.ranking import latest_per_key


def _delta(now: Column, before: Column) -> Column:
    return F.when(now >= before, now - before).otherwise(now)


def counter_delta(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counters: Mapping[str, str],
    slot: str | None = None,
    since: Column | None = None,
) -> DataFrame:
    """Add one delta column per counter (`counters` maps counter to delta name) and drop each series' first row.

    A counter that fell below its previous value restarted, so its delta is the new value itself. Every
    counter restarts on its own. `order` must identify a row within its series.

    slot   Unit of `date_trunc` ("hour", "day", ...) that cuts every series into pieces. A piece is a window group of
           its own, so one dominant series spreads over as many tasks as it has slots; the last row of a slot is handed to
           the first row of the series' next slot. Daily snapshots need no slot: a series has a row per day at most.
    since  Emit rows at or after this value of order[0] only. Older rows shrink to the last one per series
           before the shuffle; the deltas are those of the full history.
    """
    missing = set(counters) - set(df.columns)
    if missing:
        raise ValueError(f"no such counter columns: {sorted(missing)}")
    if since is not None:
        time = F.col(order[0])
        tail = latest_per_key(df.where(time < since), keys, order)
        df = df.where(time >= since).unionByName(tail)
    cut = _whole_series if slot is None else _sliced_series
    out = cut(df, keys, order, list(counters), slot)
    out = out.where(F.col("_before").isNotNull())
    if since is not None:
        out = out.where(F.col(order[0]) >= since)
    deltas = {name: _delta(F.col(c), F.col(f"_before.{c}")) for c, name in counters.items()}
    return out.withColumns(deltas).drop("_before")


def _whole_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], counters: list[str], _: None) -> DataFrame:
    series = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_before", F.lag(F.struct(*counters)).over(series))


def _sliced_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], counters: list[str], slot: str) -> DataFrame:
    place = [*keys, "_slot"]
    sliced = df.withColumn("_slot", F.date_trunc(slot, F.col(order[0])))

    # One row per series and slot, combined map-side: counters of the slot's last row.
    if len(order) == 1:  # fixed-width buffers keep this a hash aggregate
        edges = sliced.groupBy(*place).agg(*[F.max_by(c, order[0]).alias(c) for c in counters])
    else:
        last = F.max(F.struct(*order, *counters)).alias("_last")
        edges = sliced.groupBy(*place).agg(last).select(*place, "_last.*")
    series = Window.partitionBy(*keys).orderBy("_slot")
    carried = edges.select(
        *[F.col(c).alias(f"_p{i}") for i, c in enumerate(place)], F.lag(F.struct(*counters)).over(series).alias("_carried")
    ).where(F.col("_carried").isNotNull())

    within = Window.partitionBy(*place).orderBy(*order)
    stepped = sliced.withColumn("_previous", F.lag(F.struct(*counters)).over(within))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(place)])
    return (
        stepped.join(carried, same, "left")
        .withColumn("_before", F.coalesce("_previous", "_carried"))
        .drop("_previous", "_carried", "_slot", *[f"_p{i}" for i in range(len(place))])
    )
