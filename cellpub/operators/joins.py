"""Joins whose sides may be large or skewed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpub.sources.shared import counted, kept

#: Rows of a lookup table that may be broadcast.
BROADCAST_ROWS = 200_000


def lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has one row a key.

    A table that the planner finds small from the size of its files is left to it, and one with few rows is broadcast. With a larger one, rows without a key meet nothing and are not
    dealt; keys that have more than half of a shuffle partition's fair share of the rows are hot, at most two for each partition: their rows stay where they are and their
    part of the table is broadcast. The other rows meet the table by key.
    """
    spark = rows.sparkSession
    if int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= _threshold(spark):
        return rows.join(table, keys, "left")
    table, n = counted(table, "lookup")
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), keys, "left")
    there = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    with_key = rows.where(there)
    most = with_key.count() / (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(kept(with_key.groupBy(*keys).count().where(F.col("count") > most).select(*keys), "hot"))
    columns = [*rows.columns, *[c for c in table.columns if c not in keys]]
    missing = [F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.columns if c not in keys]
    parts = [
        with_key.join(hot, keys, "left_semi").join(F.broadcast(table.join(hot, keys, "left_semi")), keys, "left"),
        with_key.join(hot, keys, "left_anti").join(table.join(hot, keys, "left_anti"), keys, "left"),
        rows.where(~there).select("*", *missing),
    ]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*columns) for p in parts])


def _threshold(spark: SparkSession) -> int:
    """Bytes of a table that the planner broadcasts by itself."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
