"""Statistical disclosure control: small cells are masked, then further cells until no masked one follows by subtraction.

Direct recomputation within one relation is prevented; combinations of several relations are not examined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpub.operators.cube import KEY
from cellpub.sources.shared import counted, kept

THRESHOLD = 5


def primary_suppression(cells: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``mask`` 'p' for values from 1 to below the threshold; zeros may be published."""
    return cells.withColumn("mask", F.when((F.col("value") > 0) & (F.col("value") < threshold), "p"))


def secondary_suppression(cells: DataFrame, members: DataFrame | Callable[[DataFrame], DataFrame], most_rounds: int = 100) -> DataFrame:
    """In every relation with exactly one masked member, the smallest positive other one is masked too ('s'), until none is left.

    ``members``: rel and the key of a cell; or what deals given cells to their relations with all their columns, so that members need not be joined with cells.
    All relations of a round see the same state, so the result does not depend on partitions. Members get the number of their cell once and are stored by relation; cells are
    not written again. A round stores its new masks with the relations that they are in, so what it writes is in proportion to new masks. Only relations that were touched and have one masked member now are searched: any other was searched when it came to have one. Counts and minima are combined before
    the shuffle, so a relation with very many members is a few rows there. The driver reads how many masks a round made.
    """
    cells = kept(cells.withColumn("__cell", F.monotonically_increasing_id()), "cells")
    own = members.select("rel", *KEY).join(cells.select(*KEY, "__cell", "value", "mask"), KEY) if isinstance(members, DataFrame) else members(cells)
    order = F.when(F.col("value") > 0, F.struct("value", *KEY, "__cell"))
    own = kept(own.select("rel", "__cell", order.alias("free"), F.col("mask").isNotNull().alias("primary")), "members")
    counts = kept(own.where("primary").groupBy("rel").agg(F.count("*").alias("masked")), "counts")
    single, hits = counts.where("masked = 1").select("rel"), None
    for _ in range(most_rounds):
        found = own.where("not primary and free is not null").join(single, "rel")
        if hits is not None:
            found = found.join(hits, "__cell", "left_anti")
        least = found.groupBy("rel").agg(F.min("free").alias("least")).select(F.col("least.__cell").alias("__cell"))
        new, n_new = counted(own.select("rel", "__cell").join(least, "__cell", "left_semi"), "masks")
        if not n_new:
            marked = cells if hits is None else cells.join(hits.select("__cell", F.lit("s").alias("__new")).distinct(), "__cell", "left").withColumn("mask", F.coalesce("mask", "__new")).drop("__new")
            return marked.drop("__cell")
        hits = new if hits is None else hits.unionByName(new)
        every = counts.unionByName(hits.select("rel", F.lit(1).cast("long").alias("masked")))
        single = every.join(new.select("rel"), "rel", "left_semi").groupBy("rel").agg(F.sum("masked").alias("masked")).where("masked = 1").select("rel")
    raise ValueError(f"not settled after {most_rounds} rounds")


def verify_suppression(cells: DataFrame, members: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(violation, item): open small cells, and relations with exactly one masked member. Written without the code that masks; must be empty."""
    small = cells.where(F.col("mask").isNull() & F.col("value").between(1, threshold - 1)).select(F.lit("open small cell").alias("violation"), F.concat_ws("|", *KEY).alias("item"))
    alone = members.join(cells.select(*KEY, "mask"), KEY).groupBy("rel").agg(F.count("mask").alias("n")).where("n = 1")
    return small.unionByName(alone.select(F.lit("single masked member").alias("violation"), F.col("rel").alias("item")))


def publish_cells(cells: DataFrame, provisional: DataFrame) -> DataFrame:
    """Published rows: open zeros are left out, masked values are blank, months of ``provisional(indicator, period)`` are marked.

    An indicator has the months of its source, so the same month may be provisional for one and not for another. A row for each indicator and month.
    """
    marked = provisional.select("indicator", "period").distinct().withColumn("ptype", F.lit("M")).withColumn("__provisional", F.lit(1))
    rows = cells.where(F.col("mask").isNotNull() | (F.col("value") != 0)).join(F.broadcast(marked), ["indicator", "period", "ptype"], "left")
    return rows.select(*KEY, F.when(F.col("mask").isNull(), F.col("value")).alias("value"), F.coalesce("mask", F.lit("")).alias("secret"), F.coalesce("__provisional", F.lit(0)).alias("provisional"))


def final_guard(published: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Published small values; must be empty."""
    return published.where(F.col("value").between(1, threshold - 1))


def suppression_stats(cells: DataFrame) -> DataFrame:
    return cells.groupBy("indicator").agg(F.count("*").alias("cells"), F.count_if(F.col("mask") == "p").alias("primary_masked"), F.count_if(F.col("mask") == "s").alias("secondary_masked"))


def read_cells(published: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted keys with value and state: a key that is not published is 0, a blank one is masked."""
    rows = wanted.join(published.select(*KEY, "value", "secret", F.lit(True).alias("__there")), KEY, "left")
    state = F.when(F.col("__there").isNull(), "absent").when(F.col("secret") != "", "masked").otherwise("open")
    return rows.select(*KEY, F.when(F.col("__there").isNull(), F.lit(0).cast("long")).otherwise(F.col("value")).alias("value"), state.alias("state"))
