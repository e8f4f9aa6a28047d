"""Survey results: totals, rates with their known base, and the overlap of basins with the perimeter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def jobs_by_family(survey: DataFrame, keys: list[str]) -> DataFrame:
    """Totals and rate bases by key. A rate's numerator and base count only rows where both are known.

    ``survey``: projects, hard, seasonal (null if masked), secret, job.
    """
    both = lambda c: F.sum(F.when(F.col(c).isNotNull(), F.col("projects"))).alias(f"base_{c}")
    known = lambda c: F.sum(F.when(F.col("projects").isNotNull(), F.col(c))).alias(c)
    return survey.groupBy(*keys).agg(F.sum("projects").alias("projects"), known("hard"), both("hard"), known("seasonal"), both("seasonal"), F.countDistinct("job").alias("n_jobs"), F.count_if("secret").alias("n_secret"))


def with_rates(totals: DataFrame) -> DataFrame:
    rate = lambda c: F.when(F.col(f"base_{c}") > 0, F.round(F.col(c) * 100 / F.col(f"base_{c}"), 4))
    return totals.withColumns({"percent_hard": rate("hard"), "percent_seasonal": rate("seasonal")})


def basin_overlap(zoning: DataFrame, perimeter: DataFrame, long_list: int = 20) -> DataFrame:
    """By basin: members, members inside and outside, the share of the perimeter's population, and the names outside, blank if there are more than ``long_list``.

    ``zoning``: area, name, basin. ``perimeter``: area, population. Basins without a member inside are left out. Of the names outside, each task keeps the first ``long_list`` + 1 of a
    basin before they are shuffled, so a basin of any size is a short list.
    """
    inside = zoning.join(perimeter, "area", "left")
    rows = inside.groupBy("basin").agg(
        F.count("*").alias("n_areas"), F.count("population").alias("n_inside"), (F.count("*") - F.count("population")).alias("n_outside"), F.coalesce(F.sum("population"), F.lit(0)).cast("long").alias("population"),
    ).where("n_inside > 0")
    rank = F.row_number().over(Window.partitionBy("basin").orderBy("name", "area"))
    first = inside.where("population is null").select("basin", "name", "area").withColumn("rank", rank).where(F.col("rank") <= long_list + 1)
    names = first.groupBy("basin").agg(F.sort_array(F.collect_list(F.struct("name", "area"))).alias("outside"))
    whole = perimeter.agg(F.sum("population").alias("whole"))
    listed = F.when(F.col("n_outside") <= long_list, F.array_join(F.coalesce(F.col("outside.name"), F.array().cast("array<string>")), ", "))
    rows = rows.join(names, "basin", "left").crossJoin(F.broadcast(whole))
    return rows.select("basin", "n_areas", "n_inside", "n_outside", "population", F.round(F.col("population") / F.col("whole"), 4).alias("share"), listed.alias("outside"))
