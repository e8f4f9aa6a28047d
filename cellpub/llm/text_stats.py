"""Statistics of a text as column expressions: no Python, no shuffle, linear in the text (windows: n log n).

Null text counts as empty everywhere: all counts are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpub.llm.common import SPACE, WORD

#: Fixed values of the contract.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


def words_of(text: Column) -> Column:
    """Array of words; empty for a text without words."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"{SPACE}+", "")).cast("long")


def n_matches(text: Column, one_char_class: str) -> Column:
    """Number of characters of a class."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"{one_char_class}+", ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_repeat_words(rows: DataFrame, words: str = "words", out: str = "n_repeat_words", window: int = WINDOW) -> DataFrame:
    """``rows`` with the number of words that lie in windows of ``window`` words found at least twice in the text.

    Windows are told apart by 64-bit hashes. Where a text has as many different windows as windows, the number is 0 and nothing is sorted. Else
    sorting (hash, place) puts equal windows side by side; the places of repeated ones, sorted again, cover
    min(window, distance to the next) words each. Each step is a column of its own, read more than once by the next, so
    the optimizer keeps the steps apart and no array is made anew inside a lambda.
    """
    last = F.size(words) - window
    rows = rows.withColumn("__word", F.transform(words, lambda w: F.xxhash64(w)))
    places = F.when((last >= 1) & (F.size("__word") >= window), F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("__window", F.transform(places, lambda i: F.xxhash64(F.slice("__word", i + 1, window))))
    repeats = F.size(F.array_distinct("__window")) < F.size("__window")
    rows = rows.withColumn("__keyed", F.when(repeats, F.sort_array(F.transform("__window", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    beside = lambda k: F.get("__keyed", k)["h"]
    marked = F.transform("__keyed", lambda x, k: F.when((x["h"] == beside(k - 1)) | (x["h"] == beside(k + 1)), x["i"]))
    rows = rows.withColumn("__starts", F.when(F.size("__keyed") > 0, F.sort_array(F.array_compact(marked))))
    covered = F.transform("__starts", lambda s, k: F.coalesce(F.least(F.get("__starts", k + 1) - s, F.lit(window)), F.lit(window)))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda t, c: t + c)
    return rows.withColumn(out, F.when(F.size("__starts") > 0, total).otherwise(F.lit(0).cast("long"))).drop("__word", "__window", "__keyed", "__starts")
