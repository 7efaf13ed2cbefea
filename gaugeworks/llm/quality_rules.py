"""Quality rules whose thresholds follow the data.

Each document has a few figures. Their quantiles per language and source come from mergeable sketches: one sketch per group, merged
into one per language and one for all. A document is dropped if a figure lies far outside what is usual in its group. A group's quartiles
are drawn towards its language's, and those towards the quartiles of all, as if each brought so many documents (`PRIOR_ROWS`): one rule at
every size, by which large groups follow their own data and small ones what they belong to.

DataFrame functions only. No figure needs a shuffle of texts or words; the sketches are combined before theirs.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import written

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; per cent of words in repeated windows
WINDOW = 3

#: Sketch size, weight of the wider group in documents, and how many times the usual spread a figure may lie beyond a quartile.
SKETCH, PRIOR_ROWS, REACH = 2048, 50, 6.0
#: Figures and the least spread of each, so that a figure that hardly varies has room.
SPREADS = {"symbol_share": 0.02, "dup_line_share": 0.1, "repeat_share": 0.05, "word_length": 0.5}
TWO_SIDED = ("word_length",)
QUARTILES = {"lower": 0.25, "upper": 0.75}


def _at(array: Column, i: Column | int) -> Column:
    return F.element_at(array, i)


def window_hashes() -> Column:
    """64-bit hashes of the windows of three words of the column `words`, in order; windows are compared by them."""
    n = F.size("words")
    place = F.sequence(F.lit(1), n - WINDOW + 1)
    hashed = F.transform(place, lambda i: F.xxhash64(_at(F.col("words"), i), _at(F.col("words"), i + 1), _at(F.col("words"), i + 2)))
    hashes = F.when(n >= WINDOW, hashed).otherwise(F.expr("cast(array() as array<bigint>)"))
    return hashes


def figures(docs: DataFrame) -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the derived figures. Null texts have none."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != "")
    one = docs.withColumns(
        {
            "words": words,
            "word_chars": F.length(F.translate(text, SPACE, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        }
    )
    two = one.withColumns({"n_words": F.size("words").cast("long"), "hashes": window_hashes()})
    # Most texts have no window twice, which distinct hashes tell. In others windows are sorted with their places, equal neighbours are found,
    # and each place adds the words that the place before does not cover.
    ordered = F.sort_array("hashes")
    pairs = F.zip_with(ordered, F.slice(ordered, 2, F.greatest(F.size("hashes") - 1, F.lit(0))), lambda a, b: F.when(a == b, a))
    again = F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.array_distinct(F.array_compact(pairs)))
    three = two.withColumn("again", again)
    # places of windows, in order of hash and place; a window is repeated if a neighbour has its hash
    keyed = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    sorted_ = F.sort_array(keyed)
    size = F.size("hashes")
    none = F.lit(None).cast("struct<h:bigint,i:int>")
    before = F.concat(F.array(none), F.slice("sorted", 1, size - 1))
    after = F.concat(F.slice("sorted", 2, size - 1), F.array(none))
    joined = F.zip_with(F.zip_with("sorted", before, lambda s, b: F.struct(s["i"].alias("i"), s["h"].alias("h"), (s["h"] == b["h"]).alias("eq"))), after, lambda s, a: F.when(F.coalesce(s["eq"], F.lit(False)) | F.coalesce(s["h"] == a["h"], F.lit(False)), s["i"]))
    places = F.sort_array(F.array_compact(joined))
    cover = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    repeats = F.col("again").isNotNull()
    four = (
        three.withColumn("sorted", F.when(repeats, sorted_))
        .withColumn("places", F.when(repeats, places))
        .withColumn("n_repeat_words", F.when(repeats, cover).otherwise(0).cast("long"))
    )
    share = lambda part, whole: F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))
    n_lines = F.size(lines)
    return four.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": F.coalesce(F.col("n_dup_lines") / F.nullif(n_lines, F.lit(0)), F.lit(0.0)),
            "repeat_share": share("n_repeat_words", "n_words"),
            "word_length": share("word_chars", "n_words"),
        }
    ).drop("words", "hashes", "again", "sorted", "places")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def thresholds(rows: DataFrame) -> DataFrame:
    """Per lang and source: lower and upper limit of each figure, from the documents that pass the base rules.

    Sketches of one language's groups, and all sketches, are merged: as many rows as there are groups.
    """
    names = list(SPREADS)
    sketches = rows.where(~base_failed()).groupBy("lang", "source").agg(
        F.count("*").alias("n"), *(F.kll_sketch_agg_double(c, SKETCH).alias(c) for c in names)
    )
    groups = written(sketches, "sketches")
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(c, SKETCH).alias(c) for c in names)]
    by_lang = groups.groupBy("lang").agg(*merged)
    all_ = groups.agg(*merged)  # one row
    quartiles = lambda df, tag: df.select(
        *(F.col(c).alias(c if tag == "own" else f"{c}_{tag}") for c in ("lang", "source") if c in df.columns),
        F.col("n").cast("double").alias(f"n_{tag}"),
        *(F.kll_sketch_get_quantile_double(c, F.lit(p)).alias(f"{c}_{part}_{tag}") for c in names for part, p in QUARTILES.items()),
    )
    wide = (
        quartiles(groups, "own")
        .join(quartiles(by_lang, "wider"), F.col("lang").eqNullSafe(F.col("lang_wider")))
        .join(F.broadcast(quartiles(all_, "all")))
    )
    return wide.select("lang", "source", F.struct(*(_limits(c).alias(c) for c in names)).alias("limits"))


def _drawn(name: str) -> Column:
    """A group's quartile, drawn towards its language's, which is drawn towards that of all."""
    towards = lambda n, own, wider: (F.col(n) * F.col(own) + PRIOR_ROWS * wider) / (F.col(n) + PRIOR_ROWS)
    return towards("n_own", f"{name}_own", towards("n_wider", f"{name}_wider", F.col(f"{name}_all")))


def _limits(figure: str) -> Column:
    lower, upper = (_drawn(f"{figure}_{part}") for part in QUARTILES)
    spread = F.greatest(upper - lower, F.lit(SPREADS[figure]))
    low = lower - REACH * spread if figure in TWO_SIDED else F.lit(0.0)
    return F.struct(low.alias("low"), (upper + REACH * spread).alias("high"))


def apply_rules(docs: DataFrame) -> DataFrame:
    """The documents with their figures, base_failed and kept.

    Rows without lang or source form groups of their own. A group all of whose documents fail the base rules has no thresholds and keeps
    none. Every row gives one row; columns of the same names are replaced.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *SPREADS, "base_failed", "kept"]
    rows = written(figures(docs.drop(*new)).drop("text"), "figures")
    limits = thresholds(rows).withColumnsRenamed({"lang": "its_lang", "source": "its_source"})
    out = reduce(or_, [(F.col(c) < F.col(f"limits.{c}.low")) | (F.col(c) > F.col(f"limits.{c}.high")) for c in SPREADS])
    same = F.col("lang").eqNullSafe(F.col("its_lang")) & F.col("source").eqNullSafe(F.col("its_source"))
    return (
        rows.join(limits, same, "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(out, F.lit(True)))
        .drop("its_lang", "its_source", "limits")
    )
