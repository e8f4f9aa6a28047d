"""Dimensions: months with their status, areas, sectors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpub.functions.scalars import month_label


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))).alias("month"))


def status_of(month: Column, covered_until: Column, provisional_months: int) -> Column:
    """The last covered months are provisional, later ones not covered, earlier ones final."""
    last = F.trunc(covered_until, "month")
    return F.when(month > last, "not_covered").when(month > F.add_months(last, -provisional_months), "provisional").otherwise("final")


def month_status(register: DataFrame, treated: str, reference: Column, start: dt.date, register_months: int, notice_months: int) -> DataFrame:
    """month, period, register_status, notice_status from ``start`` to the month of ``reference`` (an aggregate of the register, or a literal).

    The register covers the months up to its last treatment; notices are published as they come, so the current month is covered.
    """
    bounds = register.agg(F.max(treated).alias("last"), reference.alias("today"))
    months = bounds.select("last", "today", F.explode(F.sequence(F.trunc(F.lit(start), "month"), F.trunc("today", "month"), F.expr("interval 1 month"))).alias("month"))
    month = F.col("month")
    return months.select(month, month_label(month).alias("period"), status_of(month, F.col("last"), register_months).alias("register_status"), status_of(month, F.col("today"), notice_months).alias("notice_status"))


def months_of(months: DataFrame, source: str) -> DataFrame:
    """month, period, status of a source: ``register`` or ``notice``."""
    return months.select("month", "period", F.col(f"{source}_status").alias("status"))


def published_months(months: DataFrame, indicators: DataFrame) -> DataFrame:
    """indicator, month, period, status of the months that the source of each indicator covers. ``indicators``: indicator, source; a few rows."""
    sources = [months_of(months, source).withColumn("source", F.lit(source)) for source in ("register", "notice")]
    covered = sources[0].unionByName(sources[1]).where("status <> 'not_covered'")
    return covered.join(F.broadcast(indicators), "source").select("indicator", "month", "period", "status")


def area_dimension(areas: DataFrame, basins: DataFrame, key: str = "area") -> DataFrame:
    return areas.join(basins, key, "left")


def sector_hierarchy(codes: DataFrame, divisions: DataFrame, sections: DataFrame) -> DataFrame:
    """Codes with division, section and both labels."""
    return codes.join(divisions.toDF("division", "division_label"), "division", "left").join(sections.toDF("section", "section_label"), "section", "left")


def sector_members(sectors: DataFrame) -> DataFrame:
    """Divisions, a pseudo division ``<section>_ND`` for each section and ``ZZ``, so that members always sum to their parent."""
    real = sectors.select("division", "section").distinct()
    unknown = sectors.select(F.concat("section", F.lit("_ND")).alias("division"), "section").distinct()
    none = sectors.sparkSession.range(1).select(F.lit("ZZ").alias("division"), F.lit("ZZ").alias("section"))
    return real.unionByName(unknown).unionByName(none)
