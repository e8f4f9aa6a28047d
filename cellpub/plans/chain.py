"""Queries of the chain from events to the monthly fact: creations and localised notices, the calendar by source, the fact.

Units and their parents are orders and customers, notices are orders, which belong to their customer (see ``registers``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cellpub.operators import dims, facts
from cellpub.plans import registers as plan
from cellpub.sources.shared import kept

INDICATORS = {"opening": "insolvencies", "closing": "closings"}
REGISTER_MONTHS, NOTICE_MONTHS = 2, 1


def events(s, d):
    """Units are read once for both kinds of creations; notices are localised one by one."""
    units = kept(plan.units(s, d), "units")
    valid = plan._valid(s, d).select(F.col("id").alias("event"), "parent", F.col("event").alias("type"), "procedure", F.trunc("event_date", "month").alias("month"))
    notices = plan.localised(s, d, valid).select(F.col("type").alias("event"), "month", "area", "section", "division", "procedure")
    sectors = plan.codes(s, d).withColumnRenamed("activity", "code")
    return facts.events_union(plan._creations_units(s, d, units), plan._creations_parents(s, d, units), notices, sectors, INDICATORS)


def months(s, d):
    """The register's last treatment is that of the last urgent order before October 2000; the reference is the last order."""
    treated = F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("day") < "2000-10-01"), F.col("day"))
    return dims.month_status(plan.orders(s, d).withColumn("treated", treated), "treated", F.max("day"), plan.START, REGISTER_MONTHS, NOTICE_MONTHS)


def monthly_fact(s, d):
    return facts.monthly_fact(events(s, d), plan.perimeter(s, d), months(s, d))


QUERIES = {
    "events_union": lambda s, d: facts.counted(events(s, d), facts.EVENT),
    "month_status": months,
    "monthly_fact": monthly_fact,
}

UNION = f"""{plan.UNITS}, {plan.NOTICES}, {plan.links_sql("select id as event, parent, event as type, procedure, event_date from v")},
ev6 as (
  select 'creations_units' as indicator, month, area, coalesce(section, 'ZZ') as section, coalesce(division, 'ZZ') as division, null as detail from cu left join na using (code) where not is_takeover and not is_future
  union all select 'creations_parents', month, area, coalesce(section, 'ZZ'), coalesce(division, 'ZZ'), null from cp left join na using (code) where not is_takeover and not is_future
  union all select case type when 'opening' then 'insolvencies' when 'closing' then 'closings' end, cast(date_trunc('month', event_date) as date), area, section, division, procedure
  from x where type in ('opening', 'closing'))"""
MONTHS = f"""
bo as (select cast(date_trunc('month', max(day) filter (o_orderpriority = '1-URGENT' and day < date '2000-10-01')) as date) as last, cast(date_trunc('month', max(day)) as date) as today from {plan.O}),
mo as (
  select cast(g as date) as month, strftime(g, '%Y-%m') as period,
         case when g > last then 'not_covered' when g > last - interval 2 month then 'provisional' else 'final' end as register_status,
         case when g > today - interval 1 month then 'provisional' else 'final' end as notice_status
  from (select unnest(generate_series(date '1996-01-01', (select today from bo), interval 1 month)) as g), bo)"""

FACT = f"""{UNION}, {MONTHS},
mf as (
  select indicator, ev6.month, area, section, division, detail, count(*) as value
  from ev6 join a using (area) join mo on mo.month = ev6.month where not (indicator like 'creations%' and register_status = 'not_covered') group by all)"""

ORACLES = {
    "events_union": f"with {UNION} select indicator, month, area, section, division, detail, count(*) as value from ev6 group by all",
    "month_status": f"with {MONTHS} select * from mo",
    "monthly_fact": f"with {FACT} select * from mf",
}
