"""Joins the reports need beyond plain equi joins."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F


def asof_lookback(
    current: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    date: str,
    days: int,
    carry: Sequence[str],
    prefix: str = "prior_",
) -> DataFrame:
    """Attach the newest history row at least `days` before each current row; unmatched rows stay.

    Both sides meet in one window per key, ordered by the date from which a row counts, and each current row takes the last history
    row before it: linear in the rows, one shuffle. Rows of one date are decided by the largest carried values. NULL keys match nothing.
    """
    taken = F.struct(F.col(date), *carry)
    old = history.select(*keys, F.col(date).alias("_at"), F.lit(0).alias("_now"), taken.alias("_old"))
    row = F.struct(*current.columns)
    now = current.select(*keys, F.date_sub(F.col(date), days).alias("_at"), F.lit(1).alias("_now"), row.alias("_row"))
    both = now.unionByName(old, allowMissingColumns=True)
    known = reduce(or_, [F.col(k).isNull() for k in keys])
    before = Window.partitionBy(*keys).orderBy("_at", "_now", "_old").rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("_found", F.when(~known, F.last("_old", ignorenulls=True).over(before))).where("_now = 1")
    return found.select(
        "_row.*", F.col(f"_found.{date}").alias(f"{prefix}{date}"), *[F.col(f"_found.{c}").alias(f"{prefix}{c}") for c in carry]
    )


def names_at(
    df: DataFrame,
    names: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, str],
    how: str = "left",
    time: str = "snapshot_time_utc",
    large: bool = False,
) -> DataFrame:
    """Attach `columns` (new name to column of `names`) as they were at each row's poll.

    A name table with a poll time shrinks to its changes first: one row per span in which nothing changed, so repeated
    polls never multiply rows, and a row meets as many candidates as its key had renames. Rows before the first
    poll take the first names, rows after the last one the last. A table without a poll time holds current rows.

    On two streams a row meets the names of its own poll, which either side may bring later, within its watermark; a row whose poll never
    brings them goes out, with `how` left, once the watermark has passed it.

    With `large`, for names that grow with the data, both sides are sorted and merged and can spill. Spark would judge such a table by the
    size of its compressed file and broadcast it, a hash table of all its rows in every task.
    """
    picked = [F.col(old).alias(f"_new_{new}") for new, old in columns.items()]
    renamed = {f"_new_{new}": new for new in columns}
    if time not in names.columns or time not in df.columns:
        current = names.select(*keys, *picked)
        return df.join(current.hint("merge") if large else current, list(keys), how).withColumnsRenamed(renamed)
    if df.isStreaming and names.isStreaming:
        return df.join(names.select(*keys, time, *picked), [*keys, time], how).withColumnsRenamed(renamed)
    at = F.coalesce(F.col(time).cast("timestamp"), F.lit("0001-01-01").cast("timestamp"))  # undated names are the oldest
    polls = names.select(*[F.col(k).alias(f"_k_{k}") for k in keys], at.alias("_from"), *picked)
    values = F.struct(*renamed)
    history = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_from", values)
    last = F.lead("_from").over(history)  # of equal poll times the largest values count
    polls = polls.withColumn("_next", last).where("_next IS NULL OR _next > _from").drop("_next")
    before = polls.withColumns({"_first": F.row_number().over(history) == 1, "_before": F.lag(values).over(history)})
    changes = before.where(F.col("_first") | ~F.col("_before").eqNullSafe(values)).drop("_before")
    spans = changes.withColumn("_until", F.lead("_from").over(history))
    same = reduce(and_, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    since = F.col("_first") | (F.col(time) >= F.col("_from"))
    until = F.col("_until").isNull() | (F.col(time) < F.col("_until"))
    joined = df.join(spans.hint("merge") if large else spans, same & since & until, how)
    return joined.drop("_from", "_until", "_first", *[f"_k_{k}" for k in keys]).withColumnsRenamed(renamed)


def like_regex(pattern: Column) -> Column:
    """A LIKE pattern as a regular expression: % and _ are wildcards, [...] and [^...] are classes, all else is literal."""
    pieces = F.regexp_extract_all(pattern, F.lit(r"(\[[^\]]+\]|[\s\S])"), F.lit(1))
    one = F.transform(
        pieces,
        lambda p: F.when(p == "%", ".*")
        .when(p == "_", ".")
        .when(F.length(p) > 1, F.regexp_replace(p, r"([\\&]|(?<=.)\[)", r"\\$1"))
        .otherwise(F.regexp_replace(p, r"([^A-Za-z0-9\s])", r"\\$1")),
    )
    return F.concat(F.lit("(?s)^"), F.array_join(one, ""), F.lit("$"))


def _matches(text: str, pattern: str) -> Column:
    """LIKE with a pattern that is known while planning: plain LIKE where it says the same, else one literal regular expression."""
    if not re.search(r"[\[\\]", pattern):
        return F.col(text).like(pattern)
    out = []
    for piece in re.findall(r"\[[^\]]+\]|[\s\S]", pattern):
        if piece in ("%", "_"):
            out.append(".*" if piece == "%" else ".")
        elif len(piece) > 1:
            out.append(re.sub(r"([\\&]|(?<=.)\[)", r"\\\1", piece))
        else:
            out.append(piece if piece.isascii() and piece.isalnum() or piece.isspace() else "\\" + piece)
    return F.col(text).rlike("(?s)^" + "".join(out) + "$")


def first_match(
    df: DataFrame,
    rules: DataFrame | Sequence[tuple],
    text: str,
    output: str,
    default: str | None = None,
    case_sensitive: bool = False,
    label: int = 3,
) -> DataFrame:
    """Label each row with the first rule whose LIKE pattern its text matches, lowest priority number first, then lowest class id.

    A list of rules, (class_id, priority, pattern, category), becomes one CASE expression, so nothing is joined or shuffled. A rule table
    meets the distinct texts only, and their labels come back by an equi join. NULL text matches no rule.
    `label` picks the rule field to emit (3 = category, 0 = class id).
    """
    columns = ["class_id", "priority", "program_like", "workload_category"]
    folded = F.col(text) if case_sensitive else F.lower(F.col(text))
    if isinstance(rules, DataFrame):
        pattern = F.col("program_like") if case_sensitive else F.lower("program_like")
        table = rules.select(F.struct("priority", "class_id").alias("_at"), F.col(columns[label]).alias("_label"), like_regex(pattern).alias("_like"))
        names = df.select(folded.alias("_name")).where("_name is not null").distinct()
        decided = names.join(table, F.expr("rlike(_name, _like)")).groupBy("_name").agg(F.min(F.struct("_at", "_label")).alias("_first"))
        decided = decided.select("_name", F.col("_first._label").alias("_label"), F.lit(True).alias("_hit"))
        labelled = df.join(decided, folded == F.col("_name"), "left")
        found = F.when(F.col("_hit"), F.col("_label")).otherwise(F.lit(default))
        return labelled.withColumn(output, found).drop("_name", "_label", "_hit")
    ordered = sorted((r[:4] for r in rules), key=lambda r: (r[1], r[0]))
    if not ordered:
        return df.withColumn(output, F.lit(default).cast("string"))
    chain: Column | None = None
    for rule in ordered:
        hit = _matches("_subject", rule[2] if case_sensitive else rule[2].lower())
        chain = F.when(hit, F.lit(rule[label])) if chain is None else chain.when(hit, F.lit(rule[label]))
    return df.withColumn("_subject", folded).withColumn(output, chain.otherwise(F.lit(default))).drop("_subject")


def expand_dotted(df: DataFrame, name: str, output: str) -> DataFrame:
    """One row per dotted prefix of a name, the whole name included: a.b.c gives a, a.b and a.b.c.

    `x = t OR x starts with t + '.'` then becomes the equi join `prefix = t`: linear in the rows, where the
    OR would compare all pairs within a database.
    """
    parts = F.split(F.col(name), r"\.")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), ".")
    )
    return df.withColumn(output, F.explode_outer(prefixes))


def exclude(df: DataFrame, column: str, names: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose column is not in the list; rows with NULL stay. A list becomes a pushed-down filter, a
    DataFrame (first column) an anti join."""
    if isinstance(names, DataFrame):
        listed = names.select(F.col(names.columns[0]).alias(column)).distinct()
        return df.join(listed, column, "left_anti")
    if not names:
        return df
    return df.where(F.col(column).isNull() | ~F.col(column).isin(list(names)))
