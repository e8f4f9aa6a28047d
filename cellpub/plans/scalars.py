"""Queries of single column functions and guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellpub.functions import scalars
from cellpub.operators.series import relative_change
from cellpub.operators.survey import jobs_by_family, with_rates
from cellpub.plans.facts import EVENTS
from cellpub.plans.registers import LINKS, NOTICES, PROCEDURES, _event_rules, _links, notices
from cellpub.plans.series import SURVEY, surveyed
from cellpub.plans.tables import order_events, table
from cellpub.sources import scans
from cellpub.sources.shared import own_folder
from cellpub.sources.versions import read_table


def _non_empty(s, d):
    path = own_folder(s, "extract")
    rows = scans.non_empty(table(s, d, "orders").where("o_orderstatus = 'P'").select("o_orderkey"), path, "orders in process")
    return read_table(s, path).withColumn("n_rows", F.lit(rows).cast("long"))


def _relative(s, d):
    n = order_events(s, d).groupBy("area").agg(F.count_if(F.year("month") == 2000).alias("value"), F.count_if((F.year("month") == 1999) & (F.col("area") != "3")).alias("base"))
    return n.withColumn("change", relative_change(F.col("value"), F.col("base")))


def _first_match(s, d):
    k = F.col("c_custkey")
    value, method = scalars.first_match(("a", F.when(k % 2 == 0, k)), ("b", F.when(k % 3 == 0, -k)), ("c", F.when(k % 5 == 0, k * 10)))
    return table(s, d, "customer").select("c_custkey", value.alias("value"), method.alias("method"))


def _status(s, d):
    rows = table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("value"), F.when(F.col("c_custkey") % 3 != 0, F.lit(100.0)).alias("threshold"), F.when(F.col("c_custkey") % 2 == 0, "min").otherwise("max").alias("sense"))
    return rows.select("c_custkey", scalars.threshold_status(F.col("value"), F.col("threshold"), F.col("sense")).alias("status"))


QUERIES = {
    "non_empty_guard": _non_empty,
    "relative_change": _relative,
    "first_match": _first_match,
    "threshold_status": _status,
    "nomenclature_gate": lambda s, d: table(s, d, "part").select("p_partkey", scalars.nomenclature_gate(F.col("p_brand"), F.col("p_type"), "LARGE").alias("code")),
    "fallback_code": lambda s, d: table(s, d, "customer").select("c_custkey", scalars.fallback_code(F.when(F.col("c_custkey") % 2 == 0, "d"), F.when(F.col("c_custkey") % 3 == 0, "l"), F.when(F.col("c_custkey") % 5 == 0, F.col("c_mktsegment"))).alias("code")),
    "classify_event": lambda s, d: notices(s, d).select("id", scalars.classify_event(_event_rules(F.col("kind"))).alias("event")),
    "classify_procedure": lambda s, d: notices(s, d).withColumn("event", scalars.classify_event(_event_rules(F.col("kind")))).select("id", scalars.classify_procedure(F.col("event"), F.col("nature"), "opening", PROCEDURES, "other_procedure").alias("procedure")),
    "economic_date": lambda s, d: notices(s, d).select("id", scalars.economic_date(F.col("judged"), F.col("published")).alias("event_date"), scalars.incoherent_date(F.col("judged"), F.col("published")).alias("incoherent")),
    "month_label": lambda s, d: order_events(s, d).select(scalars.month_label(F.col("month")).alias("period"), F.add_months("month", -12).alias("year_before")).distinct(),
    "rate_with_known_base": lambda s, d: with_rates(jobs_by_family(surveyed(s, d), ["family"])).select("family", "base_hard", "percent_hard"),
    "shares_by_method": lambda s, d: _links(s, d).groupBy("method").agg(F.count("*").alias("n"), F.avg(F.col("in_register").cast("int")).alias("in_register_share")),
}

ORACLES = {
    "non_empty_guard": "select o_orderkey, (select count(*) from orders where o_orderstatus = 'P') as n_rows from orders where o_orderstatus = 'P'",
    "relative_change": f"with n as (select area, count(*) filter (year(month) = 2000) as value, count(*) filter (year(month) = 1999 and area <> '3') as base from ({EVENTS}) group by area) select *, case when base <> 0 then value / base - 1 end as change from n",
    "first_match": """select c_custkey, case when c_custkey % 2 = 0 then c_custkey when c_custkey % 3 = 0 then -c_custkey when c_custkey % 5 = 0 then c_custkey * 10 end as value,
  case when c_custkey % 2 = 0 then 'a' when c_custkey % 3 = 0 then 'b' when c_custkey % 5 = 0 then 'c' end as method from customer""",
    "threshold_status": """select c_custkey, case when c_custkey % 3 = 0 then 'info' when c_custkey % 7 = 0 then 'failed' when c_custkey % 2 = 0 and c_acctbal >= 100 then 'ok' when c_custkey % 2 <> 0 and c_acctbal <= 100 then 'ok' else 'failed' end as status from customer""",
    "nomenclature_gate": "select p_partkey, case when p_type = 'LARGE' then p_brand end as code from part",
    "fallback_code": "select c_custkey, case when c_custkey % 2 = 0 then 'd' when c_custkey % 3 = 0 then 'l' when c_custkey % 5 = 0 then c_mktsegment || '_ND' else 'ZZ' end as code from customer",
    "classify_event": f"with {NOTICES} select id, case when kind = 'F' then 'closing' when lower(kind) = 'o' then 'opening' when nature ilike '%urgent%' then 'other_urgent' end as event from n",
    "classify_procedure": f"""with {NOTICES}, x as (select *, case when kind = 'F' then 'closing' when lower(kind) = 'o' then 'opening' when nature ilike '%urgent%' then 'other_urgent' end as event from n)
select id, case when event <> 'opening' then null when nature ilike '%urgent%' then 'liquidation' when nature ilike '%high%' then 'recovery' when nature ilike '%medium%' then 'safeguard' else 'other_procedure' end as procedure from x""",
    "economic_date": f"""with {NOTICES} select id, case when judged between cast(published - interval 1 year as date) and published then judged else published end as event_date,
  judged is null or judged not between cast(published - interval 1 year as date) and published as incoherent from n""",
    "month_label": f"select distinct strftime(month, '%Y-%m') as period, cast(month - interval 1 year as date) as year_before from ({EVENTS})",
    "rate_with_known_base": f"with {SURVEY} select family, cast(sum(projects) filter (hard is not null) as bigint) as base_hard, round(sum(hard) filter (projects is not null) * 100 / sum(projects) filter (hard is not null), 4) as percent_hard from sv group by family",
    "shares_by_method": f"with {LINKS} select method, count(*) as n, avg(cast(in_register as int)) as in_register_share from lk group by method",
}
