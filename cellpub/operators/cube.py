"""A dense multi-grain cube with exactly the grains that are published, and its additive relations.

Cells: indicator, ptype ('M' month, 'Y' twelve months), period, geo (area or TOTAL), level, sector, value. Levels: T all sectors, S section,
D division, P type of event. Each indicator has its own months, those that its source covers, and types or none; ``specification`` and ``periods`` say so in tables,
and cells, skeleton and relations follow by joins with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpub.sources.shared import fixed_rows

KEY = ["indicator", "ptype", "period", "geo", "level", "sector"]

#: The published grains as (ptype, level, geo kind). Those of level P are only for indicators with types.
GRAINS = [
    ("M", "T", "area"), ("M", "T", "TOTAL"), ("M", "S", "TOTAL"), ("M", "P", "TOTAL"),
    ("Y", "T", "area"), ("Y", "T", "TOTAL"), ("Y", "S", "area"), ("Y", "S", "TOTAL"), ("Y", "D", "TOTAL"), ("Y", "P", "TOTAL"),
]

#: Each relation with the grains of its parts and of its totals.
RELATIONS = {
    "areas": ([("M", "T", "area")], [("M", "T", "TOTAL")]),
    "sections": ([("M", "S", "TOTAL")], [("M", "T", "TOTAL")]),
    "types": ([("M", "P", "TOTAL")], [("M", "T", "TOTAL")]),
    "sections_of_geo": ([("Y", "S", "area"), ("Y", "S", "TOTAL")], [("Y", "T", "area"), ("Y", "T", "TOTAL")]),
    "areas_of_sector": ([("Y", "T", "area"), ("Y", "S", "area")], [("Y", "T", "TOTAL"), ("Y", "S", "TOTAL")]),
    "types_of_year": ([("Y", "P", "TOTAL")], [("Y", "T", "TOTAL")]),
    "divisions": ([("Y", "D", "TOTAL")], [("Y", "S", "TOTAL")]),
    "months": ([("M", "T", "area"), ("M", "T", "TOTAL"), ("M", "S", "TOTAL"), ("M", "P", "TOTAL")], [("Y", "T", "area"), ("Y", "T", "TOTAL"), ("Y", "S", "TOTAL"), ("Y", "P", "TOTAL")]),
}
#: Relations that only indicators with types have.
OF_TYPES = ["types", "types_of_year"]


def trailing_windows(months: DataFrame) -> DataFrame:
    """(indicator, window, month): twelve months up to an indicator's last final one and the twelve before, each only if its first month is published.

    ``months``: indicator, month, status; published months only.
    """
    ends = months.groupBy("indicator").agg(F.max(F.when(F.col("status") == "final", F.col("month"))).alias("last"), F.min("month").alias("first"))
    spans = ends.select("indicator", "first", F.explode(F.array("last", F.add_months("last", -12))).alias("until")).where(F.add_months("until", -11) >= F.col("first"))
    days = F.explode(F.sequence(F.add_months("until", -11), F.col("until"), F.expr("interval 1 month")))
    return spans.select("indicator", F.date_format("until", "yyyy-MM").alias("window"), days.alias("month"))


def specification(indicators: DataFrame, types: DataFrame) -> DataFrame:
    """(indicator, ptype, level, geo_kind): the grains of each indicator. ``types``: indicator, detail. All are dimensions."""
    grains = fixed_rows(indicators.sparkSession, GRAINS, "ptype string, level string, geo_kind string")
    typed = types.select("indicator", F.lit("P").alias("level")).distinct()
    every = indicators.select("indicator").crossJoin(grains)
    return every.where("level <> 'P'").unionByName(every.join(typed, ["indicator", "level"], "left_semi").select(every.columns))


def periods(months: DataFrame, windows: DataFrame) -> DataFrame:
    """(indicator, month, ptype, period): what a month's facts count for."""
    monthly = months.select("indicator", "month", F.lit("M").alias("ptype"), "period")
    return monthly.unionByName(windows.select("indicator", "month", F.lit("Y").alias("ptype"), F.col("window").alias("period")))


def domain_violations(facts: DataFrame, sectors: DataFrame) -> DataFrame:
    """Divisions of facts that the reference hierarchy lacks, with their rows; must be empty."""
    return facts.join(sectors, "division", "left_anti").groupBy("division").agg(F.count("*").alias("n_rows"))


def cube_cells(facts: DataFrame, months: DataFrame, windows: DataFrame, spec: DataFrame, other: str = "other") -> DataFrame:
    """Cells that have facts. ``facts``: indicator, month, area, section, division, detail, value; months that are not published for the indicator are ignored, a null detail
    is ``other``.

    A fact is dealt to its periods and grains before it is summed up, so there is one shuffle, of partial sums. Periods and grains are dimensions.
    """
    dealt = facts.join(F.broadcast(periods(months, windows)), ["indicator", "month"]).join(F.broadcast(spec), ["indicator", "ptype"])
    level = F.col("level")
    sector = F.when(level == "T", "ALL").when(level == "S", F.col("section")).when(level == "D", F.col("division")).otherwise(F.coalesce("detail", F.lit(other)))
    geo = F.when(F.col("geo_kind") == "TOTAL", "TOTAL").otherwise(F.col("area"))
    return dealt.withColumns({"geo": geo, "sector": sector}).groupBy(*KEY).agg(F.sum("value").cast("long").alias("value"))


def skeleton(months: DataFrame, windows: DataFrame, spec: DataFrame, areas: DataFrame, sectors: DataFrame, types: DataFrame) -> DataFrame:
    """Every cell of the specification. All sides are dimensions, so the products have the size of the result."""
    whole = areas.sparkSession.range(1)
    geos = areas.select(F.lit("area").alias("geo_kind"), F.col("area").alias("geo")).unionByName(whole.select(F.lit("TOTAL").alias("geo_kind"), F.lit("TOTAL").alias("geo")))
    all_, s, d = whole.select(F.lit("T").alias("level"), F.lit("ALL").alias("sector")), sectors.select(F.lit("S").alias("level"), F.col("section").alias("sector")), sectors.select(F.lit("D").alias("level"), F.col("division").alias("sector"))
    own = types.select("indicator", F.lit("P").alias("level"), F.col("detail").alias("sector")).distinct()
    grains = spec.join(all_.unionByName(s).unionByName(d).distinct(), "level").unionByName(spec.join(own, ["indicator", "level"]), allowMissingColumns=True)
    spans = periods(months, windows).select("indicator", "ptype", "period").distinct()
    return grains.join(spans, ["indicator", "ptype"]).join(geos, "geo_kind").select(*KEY)


def densify(cells: DataFrame, every: DataFrame) -> DataFrame:
    """Every cell with its value, 0 where there are no facts: zeros take part in relations."""
    return every.join(cells, KEY, "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long")))


def additive_relations(cells: DataFrame, sectors: DataFrame, windows: DataFrame, spec: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(rel, key of a cell, is_total): parts and total of each additive relation, in long form. Cells are read once and dealt to their relations.

    ``sectors``: division, section. A month is a part of each window that it is in. Columns of cells named in ``carry`` come along, which spares a join back to the cells.
    """
    spark = cells.sparkSession
    rows = [(name, *grain, total) for name, (parts, totals) in RELATIONS.items() for total, grains in ((False, parts), (True, totals)) for grain in grains]
    roles = fixed_rows(spark, rows, "name string, ptype string, level string, geo_kind string, is_total boolean")
    typed = spec.where("level = 'P'").select("indicator").distinct()
    of = spec.join(roles, ["ptype", "level", "geo_kind"])
    of = of.where(~F.col("name").isin(*OF_TYPES)).unionByName(of.where(F.col("name").isin(*OF_TYPES)).join(typed, "indicator", "left_semi").select(of.columns))
    spans = windows.groupBy("indicator", F.date_format("month", "yyyy-MM").alias("period")).agg(F.collect_list("window").alias("spans")).withColumn("ptype", F.lit("M"))
    parents = sectors.select(F.lit("D").alias("level"), F.col("division").alias("sector"), F.col("section").alias("parent")).distinct()
    dealt = cells.withColumn("geo_kind", F.when(F.col("geo") == "TOTAL", "TOTAL").otherwise("area")).join(F.broadcast(of), ["indicator", "ptype", "level", "geo_kind"])
    dealt = dealt.join(F.broadcast(spans), ["indicator", "ptype", "period"], "left").join(F.broadcast(parents), ["level", "sector"], "left")
    is_ = lambda *names: F.col("name").isin(*names)
    span = F.explode(F.when(is_("months") & (F.col("ptype") == "M"), F.col("spans")).otherwise(F.array("period")))
    more = F.when(is_("sections_of_geo"), F.col("geo")).when(is_("areas_of_sector"), F.concat_ws("|", "level", "sector")).when(is_("divisions"), F.coalesce("parent", "sector")).when(is_("months"), F.concat_ws("|", "geo", "level", "sector"))
    return dealt.select(*KEY, *carry, "is_total", "name", more.alias("more"), span.alias("span")).select(F.concat_ws("|", "name", "indicator", "span", "more").alias("rel"), *KEY, *carry, "is_total")


def relation_gaps(members: DataFrame, cells: DataFrame) -> DataFrame:
    """Relations whose parts don't sum to their total; must be empty."""
    signed = F.when(F.col("is_total"), -F.col("value")).otherwise(F.col("value"))
    return members.join(cells.select(*KEY, "value"), KEY).groupBy("rel").agg(F.sum(signed).alias("gap")).where("gap <> 0")


def cube_reconciliation(cells: DataFrame, facts: DataFrame) -> DataFrame:
    """indicator, cells, facts: monthly totals against facts; rows that differ must not exist."""
    ours = cells.where("ptype = 'M' and geo = 'TOTAL' and level = 'T'").groupBy("indicator").agg(F.sum("value").alias("cells"))
    theirs = facts.groupBy("indicator").agg(F.sum("value").alias("facts"))
    return ours.join(theirs, "indicator", "full")
