"""Latest rows, top-k and ranks that hold up when one group is most of the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows drawn for ranks; how many of them a group must have to be cut; parts of a value that is a piece of its own.
RANK_PIECES, CUT_FROM, SALTS = 4096, 4, 256


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest `order` value per key.

    Spark turns the row_number() = 1 filter into a group limit that also runs before the shuffle, so each
    task ships at most one row per key however large the key is.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def latest_date_per_group(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """All rows of each group's latest date.

    The maximum is a map-side combined aggregate of one row per group, joined back; adaptive execution broadcasts it
    if its measured size allows, and splits skewed groups otherwise. A window would pull a whole group into one task.
    """
    newest = df.groupBy(*keys).agg(F.max(date).alias(date))
    return df.join(newest, [*keys, date], "left_semi")


def topk_union(
    df: DataFrame, group: Sequence[str], key: Sequence[str], measures: Sequence[str], k: int
) -> DataFrame:
    """Rows in the top k of their group by any of the measures, each row once.

    `key` identifies a row within its group and breaks ties. The k-limit applies before the shuffle.
    """
    picked = None
    for measure in measures:
        best = Window.partitionBy(*group).orderBy(F.col(measure).desc(), *key)
        top = df.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).drop("_n")
        picked = top if picked is None else picked.unionByName(top)
    return picked.dropDuplicates([*group, *key])


def rank_within(df: DataFrame, group: Sequence[str], ranks: Mapping[str, str], pieces: int = RANK_PIECES) -> DataFrame:
    """Add rank() by each measure, highest first (`ranks` maps rank column to measure). Gaps follow ties, NULLs come last.

    One plan at every size, and nothing is counted while planning. Up to `pieces` rows of all groups are drawn (those of the least hash, so that
    a recomputed task draws the same). A group that has few of them is a small share of all rows and one window group. Any other group is
    cut at its drawn values, so that a window group holds about one part in `pieces` of all rows: the rank of a value is one plus the
    rows in its group's higher pieces plus the rows above it in its own piece. A value that is drawn twice is a piece of its own,
    where nothing is above anything, so its rows spread over tasks. Cuts and the pieces' counts are few rows, as many as are drawn.
    """
    out = df
    for name, measure in ranks.items():
        cuts = F.broadcast(_cuts(df, group, measure, pieces))  # at most `pieces` rows
        counted = _in_pieces(df.select(*group, measure, _row_hash(df).alias("_hash")), cuts, group, measure).where("_is_cut")
        higher = Window.partitionBy(*group).orderBy(F.col("_piece").desc()).rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            counted.groupBy(*group, "_piece")
            .agg(F.count(F.lit(1)).alias("_rows"))
            .select(*group, "_piece", F.sum("_rows").over(higher).alias("_offset"))
        )
        own = Window.partitionBy(*group, "_piece", "_salt").orderBy(F.col(measure).desc())
        placed = _in_pieces(out.withColumn("_hash", _row_hash(df)), cuts, group, measure).withColumn("_own", F.rank().over(own))
        # two rows a cut and two a group at most
        joined = _join_null_safe(placed, F.broadcast(offsets), [*group, "_piece"], "left")
        out = joined.withColumn(name, (F.col("_own") + F.coalesce("_offset", F.lit(0))).cast("int"))
        out = out.drop("_hash", "_piece", "_salt", "_own", "_offset", "_is_cut")
    return out.select(*df.columns, *ranks)


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])


def _cuts(df: DataFrame, group: Sequence[str], measure: str, pieces: int) -> DataFrame:
    """Per group with enough drawn rows their sorted values, and the same in blocks for a look-up in two steps."""
    drawn = (
        df.where(F.col(measure).isNotNull())
        .select(*group, F.col(measure).alias("_cut"), _row_hash(df).alias("_drawn"))
        .orderBy("_drawn", "_cut")
        .limit(pieces)  # each task keeps as many
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list("_cut")).alias("_sorted"))
        .withColumn("_n", F.size("_sorted"))
        .where(F.col("_n") >= CUT_FROM)
        .withColumn("_step", F.ceil(F.sqrt("_n")).cast("int"))
    )
    blocks = F.floor(F.col("_n") / F.col("_step")).cast("int")
    step = F.col("_step")
    return drawn.select(
        *group,
        F.struct(
            step.alias("step"),
            F.col("_sorted").alias("sorted"),
            F.transform(F.sequence(F.lit(1), blocks), lambda k: F.get("_sorted", k * step - 1)).alias("coarse"),
            F.transform(F.sequence(F.lit(0), blocks), lambda k: F.slice("_sorted", k * step + 1, step)).alias("fine"),
        ).alias("_cuts"),
    )


def _in_pieces(rows: DataFrame, cuts: DataFrame, group: Sequence[str], measure: str) -> DataFrame:
    """Rows (with _hash) and their _piece, ascending with the measure, _salt within it, and whether their group is cut at all."""
    value, c = F.col(measure), F.col("_cuts")
    met = _join_null_safe(rows, cuts, group, "left")
    coarse = F.size(F.filter(c["coarse"], lambda x: x <= value))
    reached = coarse * c["step"] + F.size(F.filter(F.get(c["fine"], coarse), lambda x: x <= value))
    met = met.withColumn("_reached", F.when(c.isNotNull() & value.isNotNull(), reached))
    twice = F.coalesce(F.get(c["sorted"], F.col("_reached") - 2) == value, F.lit(False))
    alone = c.isNotNull() & (value.isNull() | twice)
    piece = F.when(c.isNull(), F.lit(0)).when(value.isNull(), F.lit(-1)).otherwise(2 * F.col("_reached") + F.when(twice, 0).otherwise(1))
    salt = F.when(alone, F.pmod("_hash", F.lit(SALTS))).otherwise(F.lit(0))
    return met.withColumns({"_piece": piece, "_salt": salt, "_is_cut": c.isNotNull()}).drop("_cuts", "_reached")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on keys of which NULLs match each other; the left side's keys stay."""
    other = right.withColumnsRenamed({c: f"_k_{c}" for c in keys})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    return left.join(other, same, how).drop(*[f"_k_{c}" for c in keys])
