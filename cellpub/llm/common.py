"""What the operators share: the word pattern, tables in the shared folder, ranks over a sorted table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellpub.sources.shared import collecting, release, shared_folder  # noqa: F401  for the operators
from cellpub.sources.shared import kept as stored

#: White space and words, as the contracts give them.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

def small_enough(df: DataFrame, most_rows: int) -> bool:
    """Has ``df`` (a stored table) no more rows than may be broadcast?"""
    return df.limit(most_rows + 1).count() <= most_rows


#: Rows of a key beyond which it counts as hot, and rows that may be broadcast.
HOT_ROWS, BROADCAST_ROWS = 500, 200_000


def hot_join(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups`` (both stored; a row for each key, with ``group_rows``, the rows it has) on keys that are not null.

    The hot keys, at most a row for ``HOT_ROWS`` rows, are broadcast, so that rows of a hot key stay where they are; if there are more than may be, the hottest ones
    are. The others meet by key.
    """
    least = HOT_ROWS
    if not small_enough(groups.where(F.col("group_rows") > HOT_ROWS), BROADCAST_ROWS):
        least = groups.select("group_rows").orderBy(F.desc("group_rows")).limit(BROADCAST_ROWS + 1).agg(F.min("group_rows")).first()[0]
    hot, cold = groups.where(F.col("group_rows") > least), groups.where(F.col("group_rows") <= least)
    if hot.isEmpty():
        return rows.join(groups, keys, how)
    with_hot = rows.join(F.broadcast(hot), keys)
    return with_hot.unionByName(rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, how))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, 0 for null. Words are separated by runs of white space, so the runs are counted."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}+|{SPACE}+$", "")
    return F.when(F.length(bare) == 0, F.lit(0)).otherwise(F.size(F.split(bare, f"{SPACE}+"))).cast("long")


def content_key(text: Column) -> Column:
    """With the doc_id, tells rows of one doc_id with different texts apart. Null and empty text have one key."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def only_kept(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, content key) is in ``kept(id, key)``; of rows equal in both, the first by the other columns (as text) comes out.

    Both steps use one partitioning, by (id, key), which has a row or a few for each key.
    """
    columns = docs.columns
    keyed = docs.withColumns({"__id": F.col(id_col), "__key": content_key(F.col(text_col))})
    right = kept.toDF("__id2", "__key2")
    on = keyed["__id"].eqNullSafe(right["__id2"]) & (keyed["__key"] == right["__key2"])
    others = [F.col(f"`{c}`") for c in columns if c not in (id_col, text_col)]
    place = Window.partitionBy("__id", "__key").orderBy(*[c.cast("string") for c in others] or ["__key"])
    return keyed.join(right, on, "left_semi").withColumn("__place", F.row_number().over(place)).where("__place = 1").select(*columns)


def sorted_table(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Store ``df`` sorted over all partitions by ``order``, with ``part`` (sorted part) and ``at`` (place in it)."""
    n = partitions(df.sparkSession)
    whole = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    return stored(whole.withColumns({"part": F.shiftright(place, 33).cast("int"), "at": place.bitwiseAND(F.lit((1 << 33) - 1))}), name)


def running_sum(sorted_rows: DataFrame, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over all earlier rows of a ``sorted_table``.

    Each part sums its own rows; the sums of whole parts (a row each) are summed in one small task and
    broadcast. The order inside a part is that of ``at``.
    """
    parts = sorted_rows.groupBy("part").agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rows = sorted_rows.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = rows.join(F.broadcast(parts), "part")  # a row for each shuffle partition
    return joined.withColumn(out, F.col("__base") + F.col("__inside")).drop("__base", "__inside")
