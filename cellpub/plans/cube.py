"""Queries of the cube and of disclosure control, on the monthly fact with its four indicators: creations by the register's months, notices by theirs, types for one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpub.operators import cube, disclosure
from cellpub.operators.dims import published_months, sector_members
from cellpub.plans import chain
from cellpub.plans import registers as plan
from cellpub.sources.shared import fixed_rows, kept

INDICATORS = [("creations_units", "register"), ("creations_parents", "register"), ("insolvencies", "notice"), ("closings", "notice")]
OTHER = "other_procedure"
TYPES = [("insolvencies", name) for name in (*[name for _, name in plan.PROCEDURES], OTHER)]


@dataclass
class Cube:
    """The fact and what the cube is specified by: published months and windows of each indicator, grains, areas, sectors, types."""

    facts: DataFrame
    months: DataFrame
    windows: DataFrame
    spec: DataFrame
    areas: DataFrame
    sectors: DataFrame
    types: DataFrame

    def cells(self) -> DataFrame:
        return cube.cube_cells(self.facts, self.months, self.windows, self.spec, OTHER)

    def dense(self) -> DataFrame:
        return cube.densify(self.cells(), cube.skeleton(self.months, self.windows, self.spec, self.areas, self.sectors, self.types))

    def relations(self, cells: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
        return cube.additive_relations(cells, self.sectors, self.windows, self.spec, carry)

    def provisional(self) -> DataFrame:
        return self.months.where("status = 'provisional'").select("indicator", "period")


def of(s: SparkSession, d: str) -> Cube:
    """The fact is stored, as the cells read it; months and sectors are, as many dimensions come from them."""
    indicators = fixed_rows(s, INDICATORS, "indicator string, source string")
    types = fixed_rows(s, TYPES, "indicator string, detail string")
    months = kept(published_months(chain.months(s, d), indicators), "months")
    facts = kept(chain.monthly_fact(s, d).withColumn("area", F.col("area").cast("string")), "facts")
    known = plan.codes(s, d).select("division", "section")
    labelled = fixed_rows(s, [(f"{x}/5-LOW", x) for x in ("BUILDING", "FURNITURE")], "division string, section string")
    sectors = kept(sector_members(known.unionByName(labelled)), "sectors")
    areas = plan.perimeter(s, d).select(F.col("area").cast("string").alias("area"))
    return Cube(facts, months, cube.trailing_windows(months), cube.specification(indicators, types), areas, sectors, types)


def _dense(s, d):
    return of(s, d).dense()


def _relations(s, d):
    c = of(s, d)
    return c.relations(c.dense())


def _gaps(s, d):
    c = of(s, d)
    cells = kept(c.dense(), "dense")
    return cube.relation_gaps(c.relations(cells), cells).agg(F.count("*").alias("gaps"))


def _reconciled(s, d):
    c = of(s, d)
    return cube.cube_reconciliation(c.dense(), c.facts)


def _domain(s, d):
    """Divisions of facts that a hierarchy without the unknown members lacks."""
    c = of(s, d)
    return cube.domain_violations(c.facts, c.sectors.where("division not like '%\\\\_ND' and division <> 'ZZ'"))


def masked(s, d) -> tuple[Cube, DataFrame, DataFrame]:
    c = of(s, d)
    cells = kept(c.dense(), "dense")
    dealt = lambda numbered: c.relations(numbered, ("__cell", "value", "mask"))
    return c, disclosure.secondary_suppression(disclosure.primary_suppression(cells), dealt), c.relations(cells)


def _published(s, d):
    c, cells, _ = masked(s, d)
    return disclosure.publish_cells(cells, c.provisional())


def _violations(s, d):
    _, cells, members = masked(s, d)
    return disclosure.verify_suppression(cells, members).agg(F.count("*").alias("violations"))


def _read(s, d):
    c, cells, _ = masked(s, d)
    return disclosure.read_cells(disclosure.publish_cells(cells, c.provisional()), cells.select(*cube.KEY))


QUERIES = {
    "trailing_12m": lambda s, d: of(s, d).windows,
    "cube_cells": lambda s, d: of(s, d).cells(),
    "densify": _dense,
    "domain_check": _domain,
    "additive_relations": _relations,
    "relation_gaps": _gaps,
    "cube_reconciliation": _reconciled,
    "primary_suppression": lambda s, d: disclosure.primary_suppression(_dense(s, d)),
    "secondary_suppression": lambda s, d: masked(s, d)[1],
    "verify_suppression": _violations,
    "final_guard": lambda s, d: disclosure.final_guard(_published(s, d)).agg(F.count("*").alias("small_values")),
    "publish_cells": _published,
    "suppression_stats": lambda s, d: disclosure.suppression_stats(masked(s, d)[1]),
    "read_cell": _read,
}

KEY = ", ".join(cube.KEY)
#: The cube from its definition: months and windows of each indicator's source, each grain counted by itself, zeros for every cell, and each relation listed by itself.
CTES = f"""
{chain.FACT},
ind as (select * from (values ('creations_units', 'register'), ('creations_parents', 'register'), ('insolvencies', 'notice'), ('closings', 'notice')) t(indicator, source)),
mi as (
  select indicator, month, period, case source when 'register' then register_status else notice_status end as status from ind, mo
  where case source when 'register' then register_status else notice_status end <> 'not_covered'),
w0 as (select indicator, max(month) filter (status = 'final') as last, min(month) as first from mi group by indicator),
w1 as (select indicator, first, cast(last as date) as until from w0 union all select indicator, first, cast(last - interval 12 month as date) from w0),
w as (
  select w1.indicator, strftime(until, '%Y-%m') as win, mi.month, mi.period from w1 join mi on mi.indicator = w1.indicator and mi.month between until - interval 11 month and until
  where until - interval 11 month >= first),
f as (select indicator, month, cast(area as varchar) as area, section, division, case when indicator = 'insolvencies' then coalesce(detail, 'other_procedure') end as detail, value from mf),
fm as (select f.*, mi.period from f join mi using (indicator, month)),
fy as (select f.*, w.win as period from f join w using (indicator, month)),
c0 as (
  select indicator, 'M' as ptype, period, area as geo, 'T' as level, 'ALL' as sector, value from fm
  union all select indicator, 'M', period, 'TOTAL', 'T', 'ALL', value from fm
  union all select indicator, 'M', period, 'TOTAL', 'S', section, value from fm
  union all select indicator, 'M', period, 'TOTAL', 'P', detail, value from fm where indicator = 'insolvencies'
  union all select indicator, 'Y', period, area, 'T', 'ALL', value from fy
  union all select indicator, 'Y', period, 'TOTAL', 'T', 'ALL', value from fy
  union all select indicator, 'Y', period, area, 'S', section, value from fy
  union all select indicator, 'Y', period, 'TOTAL', 'S', section, value from fy
  union all select indicator, 'Y', period, 'TOTAL', 'D', division, value from fy
  union all select indicator, 'Y', period, 'TOTAL', 'P', detail, value from fy where indicator = 'insolvencies'),
c as (select {KEY}, cast(sum(value) as bigint) as value from c0 group by all),
geos as (select cast(area as varchar) as geo from a),
dv as (select division, section from na union select 'BUILDING/5-LOW', 'BUILDING' union select 'FURNITURE/5-LOW', 'FURNITURE'),
se as (select * from dv union select section || '_ND', section from dv union select 'ZZ', 'ZZ'),
ty as (select * from (values ('liquidation'), ('recovery'), ('safeguard'), ('other_procedure')) t(detail)),
wi as (select distinct indicator, win from w),
slots as (
  select indicator, 'M' as ptype, period, geo, 'T' as level, 'ALL' as sector from mi, geos
  union all select indicator, 'M', period, 'TOTAL', 'T', 'ALL' from mi
  union all select distinct indicator, 'M', period, 'TOTAL', 'S', section from mi, se
  union all select indicator, 'M', period, 'TOTAL', 'P', detail from mi, ty where indicator = 'insolvencies'
  union all select indicator, 'Y', win, geo, 'T', 'ALL' from wi, geos
  union all select indicator, 'Y', win, 'TOTAL', 'T', 'ALL' from wi
  union all select distinct indicator, 'Y', win, geo, 'S', section from wi, geos, se
  union all select distinct indicator, 'Y', win, 'TOTAL', 'S', section from wi, se
  union all select indicator, 'Y', win, 'TOTAL', 'D', division from wi, se
  union all select indicator, 'Y', win, 'TOTAL', 'P', detail from wi, ty where indicator = 'insolvencies'),
z as (select {KEY}, coalesce(value, 0) as value from slots left join c using ({KEY})),
r as (
  select 'areas|' || indicator || '|' || period as rel, z.*, geo = 'TOTAL' as is_total from z where ptype = 'M' and level = 'T'
  union all select 'sections|' || indicator || '|' || period, z.*, level = 'T' from z where ptype = 'M' and geo = 'TOTAL' and level in ('T', 'S')
  union all select 'types|' || indicator || '|' || period, z.*, level = 'T' from z where ptype = 'M' and geo = 'TOTAL' and level in ('T', 'P') and indicator = 'insolvencies'
  union all select 'sections_of_geo|' || indicator || '|' || period || '|' || geo, z.*, level = 'T' from z where ptype = 'Y' and level in ('T', 'S')
  union all select 'areas_of_sector|' || indicator || '|' || period || '|' || level || '|' || sector, z.*, geo = 'TOTAL' from z where ptype = 'Y' and level in ('T', 'S')
  union all select 'types_of_year|' || indicator || '|' || period, z.*, level = 'T' from z where ptype = 'Y' and geo = 'TOTAL' and level in ('T', 'P') and indicator = 'insolvencies'
  union all select 'divisions|' || indicator || '|' || period || '|' || section, z.*, false from z join se on division = sector where ptype = 'Y' and level = 'D'
  union all select 'divisions|' || indicator || '|' || period || '|' || sector, z.*, true from z where ptype = 'Y' and geo = 'TOTAL' and level = 'S'
  union all select 'months|' || indicator || '|' || period || '|' || geo || '|' || level || '|' || sector, z.*, true from z
    where ptype = 'Y' and (level = 'T' or (level in ('S', 'P') and geo = 'TOTAL'))
  union all select 'months|' || z.indicator || '|' || win || '|' || geo || '|' || level || '|' || sector, z.*, false
    from z join w on z.indicator = w.indicator and z.period = w.period where ptype = 'M')"""

#: The rounds of secondary suppression, unrolled; rounds that mask nothing change nothing.
ROUNDS = 14
_S = ["s0 as materialized (select *, case when value between 1 and 4 then 'p' end as mask from z)", f"rr as materialized (select rel, {KEY} from r)"]
for _i in range(ROUNDS):
    _S += [
        f"h{_i} as materialized (select distinct least.k as k from (select rel, count(mask) as n, min(case when mask is null and value > 0 then {{'v': value, 'k': {{'indicator': indicator, 'ptype': ptype, 'period': period, 'geo': geo, 'level': level, 'sector': sector}}}} end) as least from rr join s{_i} using ({KEY}) group by rel) where n = 1 and least is not null)",
        f"s{_i + 1} as materialized (select {KEY}, value, coalesce(mask, case when h{_i}.k is not null then 's' end) as mask from s{_i} left join h{_i} on h{_i}.k = {{'indicator': indicator, 'ptype': ptype, 'period': period, 'geo': geo, 'level': level, 'sector': sector}})",
    ]
MASKED = CTES + ",\n" + ",\n".join(_S) + f",\nmasked as (select * from s{ROUNDS})"
PUBLISHED = f"""select {KEY}, case when mask is null then value end as value, coalesce(mask, '') as secret,
       case when ptype = 'M' and (indicator, period) in (select (indicator, period) from mi where status = 'provisional') then 1 else 0 end as provisional
from masked where mask is not null or value <> 0"""

ORACLES = {
    "trailing_12m": f"with {CTES} select indicator, win as \"window\", month from w",
    "cube_cells": f"with {CTES} select * from c",
    "densify": f"with {CTES} select * from z",
    "domain_check": f"with {CTES} select division, cast(count(*) as bigint) as n_rows from f where division not in (select division from dv) group by division",
    "additive_relations": f"with {CTES} select rel, {KEY}, is_total from r",
    "relation_gaps": f"with {CTES} select cast(count(*) as bigint) as gaps from (select rel from r group by rel having sum(case when is_total then -value else value end) <> 0)",
    "cube_reconciliation": f"with {CTES} select indicator, cast(sum(value) as bigint) as cells, (select cast(sum(value) as bigint) from f where f.indicator = z.indicator) as facts from z where ptype = 'M' and geo = 'TOTAL' and level = 'T' group by indicator",
    "primary_suppression": f"with {CTES} select *, case when value between 1 and 4 then 'p' end as mask from z",
    "secondary_suppression": f"with {MASKED} select * from masked",
    "verify_suppression": f"""with {MASKED} select cast((select count(*) from masked where mask is null and value between 1 and 4)
  + (select count(*) from (select rel from rr join masked using ({KEY}) group by rel having count(mask) = 1)) as bigint) as violations""",
    "final_guard": f"with {MASKED} select cast(count(*) as bigint) as small_values from ({PUBLISHED}) where value between 1 and 4",
    "publish_cells": f"with {MASKED} {PUBLISHED}",
    "suppression_stats": f"with {MASKED} select indicator, cast(count(*) as bigint) as cells, cast(count(*) filter (mask = 'p') as bigint) as primary_masked, cast(count(*) filter (mask = 's') as bigint) as secondary_masked from masked group by indicator",
    "read_cell": f"""with {MASKED} select {KEY}, case when mask is null then value end as value,
  case when mask is not null then 'masked' when value = 0 then 'absent' else 'open' end as state from masked""",
}
