"""Events of all sources as one table, and the monthly fact counted from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CREATIONS = "creations_"
#: What is counted of an event.
EVENT = ["indicator", "month", "area", "section", "division", "detail"]


def counted(events: DataFrame, keys: list[str]) -> DataFrame:
    """Count of events by all keys; partial counts go over the shuffle, not events."""
    return events.groupBy(*keys).agg(F.count("*").alias("value"))


def events_union(units: DataFrame, parents: DataFrame, notices: DataFrame, sectors: DataFrame, indicators: dict[str, str]) -> DataFrame:
    """indicator, month, area, section, division, detail of all events.

    Creations (``units`` and ``parents`` with month, area, code, is_takeover, is_future) without takeovers and future dates; their sector is that of the code in
    ``sectors(code, section, division)``, else ``ZZ``. Localised notices (event, month, area, section, division, procedure) of the events in
    ``indicators``, which says what each is called as an indicator.
    """

    def creations(df: DataFrame, indicator: str) -> DataFrame:
        rows = df.where("not is_takeover and not is_future").select("month", "area", "code").join(sectors, "code", "left")
        sector = [F.coalesce(c, F.lit("ZZ")).alias(c) for c in ("section", "division")]
        return rows.select(F.lit(CREATIONS + indicator).alias("indicator"), "month", "area", *sector, F.lit(None).cast("string").alias("detail"))

    name = reduce(lambda w, e: w.when(F.col("event") == e, indicators[e]), list(indicators)[1:], F.when(F.col("event") == next(iter(indicators)), next(iter(indicators.values()))))
    events = notices.where(F.col("event").isin(*indicators)).select(name.alias("indicator"), "month", "area", "section", "division", F.col("procedure").alias("detail"))
    return creations(units, "units").unionByName(creations(parents, "parents")).unionByName(events)


def monthly_fact(events: DataFrame, areas: DataFrame, months: DataFrame) -> DataFrame:
    """Events of known areas and months counted; creations of months that the register does not cover yet are left out. ``months``: month, register_status.

    Events are counted before they meet the dimensions, which have a row for each area and month.
    """
    facts = counted(events, EVENT).join(areas.select("area"), "area").join(months.select("month", "register_status"), "month")
    return facts.where(~(F.col("indicator").startswith(CREATIONS) & (F.col("register_status") == "not_covered"))).select(*EVENT, "value")
