"""Queries of series, rankings, survey rates and label policy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpub.operators import labels, series, survey
from cellpub.plans.facts import EVENTS
from cellpub.plans.tables import order_events, table
from cellpub.sources.shared import fixed_rows

WINDOWS = {"2001-06": (dt.date(2000, 7, 1), dt.date(2001, 6, 1)), "2000-06": (dt.date(1999, 7, 1), dt.date(2000, 6, 1))}


def monthly(s: SparkSession, d: str) -> DataFrame:
    """Orders by area and month; values below 5 and those of May are masked (null)."""
    rows = order_events(s, d).groupBy("area", "month").agg(F.count("*").alias("n"))
    status = F.when(F.col("month") > F.lit(dt.date(2001, 6, 1)), "provisional").otherwise("final")
    return rows.select("area", "month", F.when((F.col("n") >= 5) & (F.month("month") != 5), F.col("n")).alias("value"), status.alias("status"))


def windows(s, d, *keys) -> DataFrame:
    """Trailing windows; values below 10 are masked."""
    window = F.coalesce(*[F.when(F.col("month").between(F.lit(a), F.lit(b)), w) for w, (a, b) in WINDOWS.items()])
    rows = order_events(s, d).withColumn("window", window).where("window is not null").groupBy(*keys, "window").agg(F.count("*").alias("n"))
    return rows.select(*keys, "window", F.when(F.col("n") >= 10, F.col("n")).alias("value"))


def population(s, d) -> DataFrame:
    return table(s, d, "customer").groupBy(F.col("c_nationkey").cast("string").alias("area")).agg(F.count("*").alias("population"))


def _rates(s, d):
    n = order_events(s, d).groupBy("area").agg(F.count("*").alias("n")).join(population(s, d), "area")
    return n.select("area", (F.col("n") * 1000 / F.col("population")).alias("rate"))


def divisions(s, d):
    return order_events(s, d).groupBy("section", "division").agg(F.count("*").alias("n")).select("section", "division", F.when(F.col("n") % 4 != 0, F.col("n")).alias("value"))


def _sector_table(s, d):
    cells = divisions(s, d)
    unknown = cells.groupBy("section").agg(F.max("value").alias("value")).select(F.concat("section", F.lit("_ND")).alias("sector"), "value")
    zero = cells.where("division like '%LOW'").select(F.lower("division").alias("sector"), F.lit(0).cast("long").alias("value"))
    names = cells.select("section", F.lower("section").alias("label")).distinct().unionByName(cells.select(F.col("division").alias("section"), F.lower("division").alias("label")))
    return series.sector_table(cells.select(F.col("division").alias("sector"), "value").unionByName(unknown).unionByName(zero), names)


def _balance(s, d):
    rows = order_events(s, d).groupBy("area", "month", "detail").agg(F.count("*").alias("n")).select("area", "month", "detail", F.when(F.col("n") > 2, F.col("n")).alias("value"))
    return series.balance(rows.where("detail = 'O'"), rows.where("detail = 'F'"), ["area", "month"])


def surveyed(s, d) -> DataFrame:
    """Parts sold by year, type (family) and brand (job); counts below 3 are masked."""
    sold = table(s, d, "lineitem").join(table(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand"), "l_partkey")
    n, hard, season = F.count("*"), F.count_if(F.col("l_quantity") > 40), F.count_if(F.month("l_shipdate") == 7)
    shown = lambda c: F.when(c >= 3, c)
    return sold.groupBy(F.year("l_shipdate").alias("year"), F.col("p_type").alias("family"), F.col("p_brand").alias("job")).agg(shown(n).alias("projects"), shown(hard).alias("hard"), shown(season).alias("seasonal"), (n < 3).alias("secret"))


def _overlap(s, d):
    people = table(s, d, "customer").where("c_nationkey % 3 <> 1").groupBy(F.col("c_nationkey").alias("area")).agg(F.count("*").alias("population"))
    zoning = table(s, d, "nation").select(F.col("n_nationkey").alias("area"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("basin"))
    return survey.basin_overlap(zoning, people)


def scored(s, d) -> DataFrame:
    """Per customer: shares of order priorities as probabilities, the largest as the choice; every 17th choice is 'none'."""
    shares = table(s, d, "orders").groupBy(F.col("o_custkey").alias("id"), "o_orderpriority").agg(F.count("*").alias("n"))
    total = shares.groupBy("id").agg(F.sum("n").alias("total"))
    p = shares.join(total, "id").withColumn("p", F.col("n") / F.col("total"))
    best = F.max(F.struct("n", "o_orderpriority"))
    rows = p.groupBy("id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("o_orderpriority", "p")))).alias("probabilities"), best.alias("b"), F.first("total").alias("total"))
    return rows.select("id", F.when(F.col("id") % 17 == 0, labels.NONE).otherwise(F.col("b.o_orderpriority")).alias("division"), (F.col("b.n") / F.col("total")).alias("confidence"), "probabilities")


def hierarchy(s, d) -> DataFrame:
    section = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "fast").when(F.col("o_orderpriority") == "3-MEDIUM", "mid").otherwise("slow")
    return table(s, d, "orders").select(F.col("o_orderpriority").alias("division"), section.alias("section")).distinct()


def truth(s, d) -> DataFrame:
    """The priority of the last order."""
    return table(s, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("division"))


def _grid(s, d):
    grid = fixed_rows(s, [(a, b) for a in (0.3, 0.4, 0.5, 0.6) for b in (0.5, 0.7, 0.9)], "t1 double, t2 double")
    return labels.policy_grid(scored(s, d), hierarchy(s, d), truth(s, d), grid)


def _unlabelled(s, d):
    events = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("area"), F.when(F.col("c_custkey") % 3 == 0, "known").alias("code"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")).alias("text"), F.col("c_mktsegment").alias("kind"))
    return labels.select_unlabelled(events, table(s, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("area")), ["BUILDING", "MACHINERY"])


def _candidates(s, d):
    mark = lambda text: F.substring(F.sha2(text.cast("binary"), 256), 1, 16)
    events = table(s, d, "customer").select(F.col("c_custkey").alias("id"), mark(F.col("c_name")).alias("print"))
    cache = table(s, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), mark(F.when(F.col("c_custkey") % 8 == 0, F.lit("changed")).otherwise(F.col("c_name"))).alias("print"))
    return labels.incremental_candidates(events, cache)


def _replace(s, d):
    cache = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("old").alias("level"))
    return labels.replace_in_cache(cache, table(s, d, "customer").where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("id"), F.lit("new").alias("level")))


QUERIES = {
    "year_over_year": lambda s, d: series.year_over_year(monthly(s, d), ["area"]).select("area", "month", "value", "before", "change"),
    "last_n_consolidated": lambda s, d: series.last_n_final(monthly(s, d), ["area"]),
    "isolated_points": lambda s, d: series.isolated_points(monthly(s, d), ["area"]).select("area", "month", "value"),
    "atypical_months": lambda s, d: series.atypical_months(monthly(s, d), ["area"], 1.4).select("area", "month", "value", "median"),
    "quantile_classes": lambda s, d: series.quantile_classes(_rates(s, d)),
    "headline": lambda s, d: series.headline(windows(s, d, "area", "section"), ["area", "section"], "2001-06", "2000-06"),
    "top_k_sectors": lambda s, d: series.top_k(divisions(s, d), [], "value", "division", 15),
    "top_k_by_section": lambda s, d: series.top_k(divisions(s, d), ["section"], "value", "division", 3),
    "top_k_jobs": lambda s, d: series.top_k(survey.with_rates(survey.jobs_by_family(surveyed(s, d), ["job"])), [], "projects", "job", 20),
    "latest_jobs": lambda s, d: series.latest_ranked(survey.with_rates(survey.jobs_by_family(surveyed(s, d), ["year", "job"])), "year", "projects", "job"),
    "rank_areas": lambda s, d: series.rank_areas(windows(s, d, "area"), population(s, d), "2001-06", "2000-06"),
    "sector_table": _sector_table, "balance": _balance,
    "arg_max_row": lambda s, d: series.arg_max(population(s, d).join(table(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("area"), "n_regionkey"), "area"), ["n_regionkey"], "population", "area"),
    "hash_sample": lambda s, d: series.hash_sample(table(s, d, "documents").select("doc_id", "lang"), "doc_id", "42", 50),
    "jobs_by_family": lambda s, d: survey.with_rates(survey.jobs_by_family(surveyed(s, d), ["year", "family"])),
    "survey_by_year": lambda s, d: survey.with_rates(survey.jobs_by_family(surveyed(s, d), ["year"])),
    "basin_overlap": _overlap,
    "select_unlabelled": _unlabelled, "incremental_candidates": _candidates, "replace_in_cache": _replace,
    "label_table": lambda s, d: labels.label_table(hierarchy(s, d), hierarchy(s, d).select("division", F.lower("division").alias("division_label")), hierarchy(s, d).select("section", F.upper("section").alias("section_label")).distinct()),
    "hierarchical_decision": lambda s, d: labels.hierarchical_decision(scored(s, d), hierarchy(s, d), 0.5, 0.7),
    "policy_grid": _grid,
    "calibration": lambda s, d: labels.calibration(scored(s, d), truth(s, d)),
    "forced_accuracy": lambda s, d: labels.forced_accuracy(scored(s, d), hierarchy(s, d), truth(s, d)),
}

MONTHLY = f"""
e as ({EVENTS}),
s as (select area, month, case when count(*) >= 5 and month(month) <> 5 then count(*) end as value, case when month > date '2001-06-01' then 'provisional' else 'final' end as status from e group by area, month)"""
SPAN = "case when month between date '2000-07-01' and date '2001-06-01' then '2001-06' when month between date '1999-07-01' and date '2000-06-01' then '2000-06' end"
POP = "pop as (select cast(c_nationkey as varchar) as area, count(*) as population from customer group by 1)"
DIV = f"dv as (select section, division, case when count(*) % 4 <> 0 then count(*) end as value from ({EVENTS}) group by section, division)"
SURVEY = """
sv as (
  select cast(year(l_shipdate) as int) as year, p_type as family, p_brand as job, case when count(*) >= 3 then count(*) end as projects,
         case when count(*) filter (l_quantity > 40) >= 3 then count(*) filter (l_quantity > 40) end as hard,
         case when count(*) filter (month(l_shipdate) = 7) >= 3 then count(*) filter (month(l_shipdate) = 7) end as seasonal, count(*) < 3 as secret
  from lineitem join part on l_partkey = p_partkey group by year(l_shipdate), p_type, p_brand)"""


def _survey_sql(keys: str) -> str:
    return f"""select {keys}, cast(sum(projects) as bigint) as projects, cast(sum(hard) filter (projects is not null) as bigint) as hard, cast(sum(projects) filter (hard is not null) as bigint) as base_hard,
  cast(sum(seasonal) filter (projects is not null) as bigint) as seasonal, cast(sum(projects) filter (seasonal is not null) as bigint) as base_seasonal, count(distinct job) as n_jobs, count(*) filter (secret) as n_secret,
  round(sum(hard) filter (projects is not null) * 100 / sum(projects) filter (hard is not null), 4) as percent_hard,
  round(sum(seasonal) filter (projects is not null) * 100 / sum(projects) filter (seasonal is not null), 4) as percent_seasonal from sv group by {keys}"""


SCORED = """
h as (select distinct o_orderpriority as division, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'fast' when o_orderpriority = '3-MEDIUM' then 'mid' else 'slow' end as section from orders),
sn as (select o_custkey as id, o_orderpriority as division, count(*) as n from orders group by all),
sh as (select *, sum(n) over (partition by id) as total from sn),
ch as (select id, case when id % 17 = 0 then 'ZZ' else division end as choice, n / total as confidence from sh qualify row_number() over (partition by id order by n desc, division desc) = 1),
ms as (select id, section, sum(n / total) as mass from sh join h using (division) group by id, section),
tp as (select * from ms qualify row_number() over (partition by id order by round(mass, 12) desc, section) = 1),
tr as (select o_custkey as id, arg_max(o_orderpriority, o_orderkey) as truth from orders group by 1),
wm as (select ch.id, choice, confidence, h.section as own_section, tp.section as top_section, mass from ch left join h on choice = h.division left join tp using (id))"""
DECIDED = """case when choice = 'ZZ' then 'none' when confidence >= {t1} then 'division' when mass >= {t2} then 'section' else 'none' end"""

ORACLES = {
    "year_over_year": f"with {MONTHLY} select a.area, a.month, a.value, b.value as before, case when b.value <> 0 then a.value / b.value - 1 end as change from s a left join s b on a.area = b.area and b.month = a.month - interval 1 year",
    "last_n_consolidated": f"with {MONTHLY} select * from s where status = 'final' qualify row_number() over (partition by area order by month desc) <= 24",
    "isolated_points": f"with {MONTHLY} select s.area, s.month, s.value from s left join s a on a.area = s.area and a.month = s.month - interval 1 month left join s b on b.area = s.area and b.month = s.month + interval 1 month where s.value is not null and a.value is null and b.value is null",
    "atypical_months": f"with {MONTHLY}, m as (select area, median(value) as median from s group by area) select area, month, value, median from s join m using (area) where value > 1.4 * median",
    "quantile_classes": f"""with e as ({EVENTS}), {POP}, r as (select area, count(*) * 1000 / any_value(population) as rate from e join pop using (area) group by area),
b as (select quantile_cont(rate, [0.2, 0.4, 0.6, 0.8]) as q from r where rate > 0) select area, rate, cast(len([x for x in q if rate > x]) + 1 as int) as class from r, b where rate > 0""",
    "headline": f"""with e as ({EVENTS}), w as (select area, section, {SPAN} as w, case when count(*) >= 10 then count(*) end as value from e where {SPAN} is not null group by all),
g as (select area, section, max(value) filter (w = '2001-06') as value, max(value) filter (w = '2000-06') as before from w group by all) select *, case when before <> 0 then value / before - 1 end as change from g""",
    "top_k_sectors": f"with {DIV} select *, cast(row_number() over (order by value desc, division) as int) as rank, (select count(*) from dv where value is null) as masked from dv where value is not null order by value desc, division limit 15",
    "top_k_by_section": f"with {DIV} select section, division, value, cast(row_number() over w as int) as rank, m as masked from (select *, count(*) filter (value is null) over (partition by section) as m from dv) where value is not null window w as (partition by section order by value desc, division) qualify row_number() over w <= 3",
    "top_k_jobs": f"with {SURVEY}, j as ({_survey_sql('job')}) select *, cast(row_number() over (order by projects desc, job) as int) as rank, (select count(*) from j where projects is null) as masked from j where projects is not null order by projects desc, job limit 20",
    "latest_jobs": f"with {SURVEY}, j as ({_survey_sql('year, job')}) select * from j where year = (select max(year) from j)",
    "rank_areas": f"""with e as ({EVENTS}), {POP}, w as (select area, {SPAN} as w, case when count(*) >= 10 then count(*) end as value from e where {SPAN} is not null group by all),
g as (select area, max(value) filter (w = '2001-06') as value, max(value) filter (w = '2000-06') as before from w group by all)
select area, value, before, case when before <> 0 then value / before - 1 end as change, population, value * 1000 / population as per_1000, cast(row_number() over (order by value desc nulls last, area) as int) as rank from g join pop using (area)""",
    "sector_table": f"""with {DIV}, c as (select division as sector, value from dv union all select section || '_ND', max(value) from dv group by section union all select lower(division), 0 from dv where division like '%LOW'),
n as (select section as k, lower(section) as label from dv union select division, lower(division) from dv)
select sector, value, coalesce(n.label, p.label || ' (not detailed)', 'unknown') as label from c left join n on n.k = sector left join n p on sector like '%\\_ND' escape '\\' and p.k = regexp_replace(sector, '_ND$', '') where value is null or value <> 0""",
    "balance": f"""with e as ({EVENTS}), r as (select area, month, detail, count(*) as n from e group by all),
x as (select coalesce(a.area, b.area) as area, coalesce(a.month, b.month) as month, case when a.n is null then 0 when a.n > 2 then a.n end as entries, case when b.n is null then 0 when b.n > 2 then b.n end as exits
  from (select * from r where detail = 'O') a full join (select * from r where detail = 'F') b on a.area = b.area and a.month = b.month) select *, entries - exits as balance from x""",
    "arg_max_row": f"with {POP} select area, population, n_regionkey from pop join nation on cast(n_nationkey as varchar) = area qualify row_number() over (partition by n_regionkey order by population desc, area) = 1",
    "hash_sample": "select doc_id, lang from documents order by md5(doc_id || '42'), doc_id limit 50",
    "jobs_by_family": f"with {SURVEY} {_survey_sql('year, family')}",
    "survey_by_year": f"with {SURVEY} {_survey_sql('year')}",
    "basin_overlap": """with p as (select c_nationkey as area, count(*) as population from customer where c_nationkey % 3 <> 1 group by 1)
select n_regionkey as basin, count(*) as n_areas, count(population) as n_inside, count(*) - count(population) as n_outside, cast(coalesce(sum(population), 0) as bigint) as population,
  round(sum(population) / (select sum(population) from p), 4) as share, coalesce(string_agg(case when population is null then n_name end, ', ' order by n_name), '') as outside
from nation left join p on area = n_nationkey group by n_regionkey having count(population) > 0""",
    "select_unlabelled": "select c_custkey as id, c_nationkey as area, cast(null as varchar) as code, c_name as text, c_mktsegment as kind from customer join nation on c_nationkey = n_nationkey where n_regionkey < 3 and c_custkey % 3 <> 0 and c_custkey % 7 <> 0 and c_mktsegment in ('BUILDING', 'MACHINERY')",
    "incremental_candidates": "select c_custkey as id, left(sha256(c_name), 16) as print from customer where c_custkey % 2 <> 0 or c_custkey % 8 = 0",
    "replace_in_cache": "select c_custkey as id, case when c_custkey % 5 = 0 then 'new' else 'old' end as level from customer",
    "label_table": f"with {SCORED} select section, division, lower(division) as division_label, upper(section) as section_label from h",
    "hierarchical_decision": f"with {SCORED}, d as (select *, {DECIDED.format(t1=0.5, t2=0.7)} as level from wm) select id, level, case when level = 'division' then choice end as division, case when level = 'division' then own_section when level = 'section' then top_section end as section from d",
    "policy_grid": f"""with {SCORED}, g as (select * from (values (0.3::double), (0.4), (0.5), (0.6)) a(t1), (values (0.5::double), (0.7), (0.9)) b(t2)),
d as (select wm.*, t1, t2, truth, h.section as true_section, {DECIDED.format(t1='t1', t2='t2')} as level from wm join tr using (id) join h on h.division = truth, g),
x as (select *, case when level = 'division' then choice = truth when level = 'section' then top_section = true_section end as ok from d)
select t1, t2, count(*) as n, round(avg(cast(level = 'division' as int)), 3) as share_division, round(avg(cast(ok as int)) filter (level = 'division'), 3) as precision_division, round(avg(cast(level = 'section' as int)), 3) as share_section,
  round(avg(cast(ok as int)) filter (level = 'section'), 3) as precision_section, round(avg(cast(ok as int)) filter (level <> 'none'), 3) as precision, round(avg(cast(level = 'none' as int)), 3) as share_none from x group by t1, t2""",
    "calibration": f"with {SCORED} select case when confidence >= 0.9 then 0.9::double when confidence >= 0.7 then 0.7 when confidence >= 0.5 then 0.5 when confidence >= 0.3 then 0.3 else 0.0 end as from_confidence, count(*) as n, round(avg(cast(choice = truth as int)), 3) as accuracy from ch join tr using (id) group by 1",
    "forced_accuracy": f"with {SCORED} select count(*) as n, avg(cast(choice = truth as int)) as division_accuracy, avg(cast(coalesce(own_section = h.section, false) as int)) as section_accuracy from wm join tr using (id) join h on h.division = truth",
}
