"""Column expressions shared by the plans. All of them are built-in functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

from gaugeworks import settings

MS2 = "decimal(18,2)"


def safe_ratio(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """numerator / denominator as a double, NULL unless the denominator is above zero."""
    quotient = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, F.round(quotient, digits))


def mean(value: Column, digits: int = 6) -> Column:
    """Average as a rounded double, so the result does not depend on decimal-average scale rules."""
    return F.round(F.avg(value.cast("double")), digits)


def case_label(branches: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """Ordered CASE: the label of the first true condition (NULL conditions count as false)."""
    (condition, label), *rest = branches
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default).cast("string"))


def wait_category(wait_type: Column) -> Column:
    branches = []
    for label, pattern, names in settings.WAIT_CATEGORIES:
        tests = ([wait_type.like(pattern)] if pattern else []) + ([wait_type.isin(names)] if names else [])
        condition = tests[0]
        for test in tests[1:]:
            condition = condition | test
        branches.append((condition, label))
    return case_label(branches, settings.OTHER_WAIT_CATEGORY)


def hour_boundaries(earlier: Column, later: Column) -> Column:
    """Clock-hour boundaries crossed between two times (00:59 to 02:01 crosses two)."""
    seconds = F.unix_seconds(F.date_trunc("HOUR", later)) - F.unix_seconds(F.date_trunc("HOUR", earlier))
    return (seconds / 3600).cast("long")


def second_boundaries(earlier: Column, later: Column) -> Column:
    """Whole-second boundaries crossed between two times."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def statement_slice(text: Column, start: Column, end: Column) -> Column:
    """The statement inside a batch text, given UTF-16 byte offsets; an end of -1 means the end of the text."""
    stop = F.when(end == -1, F.char_length(text) * 2).otherwise(end)
    first = (start / 2).cast("int") + 1
    length = ((stop - start) / 2).cast("int") + 1
    return F.substring(text, first, length)


def micros_to_ms(micros: Column) -> Column:
    """Integer microseconds to milliseconds with two decimals (exact decimal arithmetic)."""
    return (micros.cast("decimal(20,0)") / F.lit(1000)).cast(MS2)


def truncated_mean(total: Column, count: Column) -> Column:
    """Integer-division mean, NULL for a zero count."""
    return F.call_function("div", total, F.nullif(count, F.lit(0).cast("long")))


def joined_text(parts: Iterable[Column], separator: str = "|") -> Column:
    """Concatenation that keeps the separators of NULL parts (NULL counts as empty text)."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part, F.lit("")))
    return F.concat(*pieces)


def attribution_hash(*parts: Column) -> Column:
    """SHA-256 of the joined parts in UTF-16LE, the byte form a server keeps its text in."""
    return F.unhex(F.sha2(F.encode(joined_text(parts), "UTF-16LE"), 256))


def agent_timestamp(date_int: Column, time_int: Column) -> Column:
    """(yyyymmdd, hhmmss) integers to a timestamp; NULL when they are none."""
    day = date_int.cast("int")
    clock = time_int.cast("int")
    return F.try_make_timestamp(
        (day / 10000).cast("int"),
        (day / 100).cast("int") % 100,
        day % 100,
        (clock / 10000).cast("int"),
        (clock / 100).cast("int") % 100,
        clock % 100,
    )


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp; NULL when it is not one."""
    return F.try_to_timestamp(text)
