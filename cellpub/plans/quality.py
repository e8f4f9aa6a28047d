"""Queries of contracts, quality metrics, sinks and the run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellpub.operators import contracts
from cellpub.operators.dims import calendar
from cellpub.plans.facts import EVENTS
from cellpub.plans.tables import order_events, table
from cellpub.sources import scans, sinks
from cellpub.sources.shared import own_folder
from cellpub.sources.versions import read_table


def items(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.to_date("l_shipdate").alias("shipped"))


def monthly(s, d):
    return order_events(s, d).groupBy("month").agg(F.count("*").alias("value"))


def checks(s: SparkSession, d: str) -> dict[str, tuple[str, DataFrame]]:
    lines, orders, docs = items(s, d), table(s, d, "orders"), table(s, d, "documents")
    no_low = orders.withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    return {
        "unique": ("error", contracts.unique(lines, "l_orderkey", "l_linenumber")),
        "not_null": ("error", contracts.not_null(no_low, "o_orderpriority")),
        "accepted_values": ("error", contracts.accepted_values(lines, "l_returnflag", ["A", "N"])),
        "relationships": ("error", contracts.relationships(lines, "l_orderkey", orders.where("o_orderkey % 9 <> 0"), "o_orderkey")),
        "expression": ("error", contracts.expression(lines.withColumn("q", F.col("l_quantity").cast("int")), "q", F.col("q") < 49)),
        "unique_expression": ("error", contracts.unique(docs, F.concat_ws("-", "lang", F.col("n_chars").cast("string")))),
        "forbidden_columns": ("error", contracts.forbidden_columns(table(s, d, "customer"), ["name", "phone"])),
        "reconcile": ("error", contracts.reconcile(orders.agg(F.count("*")), order_events(s, d).where("detail <> 'P'").agg(F.count("*")), "orders")),
        "no_empty_month": ("error", contracts.no_empty_month(calendar(s, dt.date(1994, 11, 1), dt.date(2001, 8, 1)), order_events(s, d))),
        "volume_drop": ("error", contracts.volume_drop(monthly(s, d))),
        "vintages_covered": ("error", contracts.vintages_covered(orders.select(F.year("o_orderdate").alias("year")), s.range(1996, 2002).select(F.col("id").cast("int").alias("year")), "year")),
        "future_dates": ("warn", contracts.future_dates(lines, "shipped", F.lit(dt.date(2001, 9, 1)))),
        "relationships_held": ("error", contracts.relationships(orders, "o_custkey", table(s, d, "customer"), "c_custkey")),
    }


def _report(s, d):
    """The checks above in one pass over each table; orders are read with whether their customer is there."""
    customers = table(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("known"))
    orders = table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("day")).join(customers, "o_custkey", "left")
    month = F.date_format("day", "yyyy-MM")
    tables = {
        "lines": items(s, d).withColumn("q", F.col("l_quantity").cast("int")), "orders": orders, "documents": table(s, d, "documents").select("lang", "n_chars"),
        "calendar": calendar(s, dt.date(1994, 11, 1), dt.date(2001, 8, 1)), "years": s.range(1996, 2002).withColumnRenamed("id", "year"),
    }
    event, always = F.col("known"), F.lit(True)
    rules = [
        contracts.unique_rule("unique", "lines", "l_orderkey", "l_linenumber"),
        contracts.not_null_rule("not_null", "orders", "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))),
        contracts.value_rule("accepted_values", "lines", "l_returnflag", F.col("l_returnflag").isin("A", "N")),
        contracts.reference_rule("relationships", ("lines", "l_orderkey"), ("orders", "o_orderkey", F.col("o_orderkey") % 9 != 0)),
        contracts.value_rule("expression", "lines", "q", F.col("q") < 49),
        contracts.unique_rule("unique_expression", "documents", F.concat_ws("-", "lang", F.col("n_chars").cast("string"))),
        contracts.Rule("reconcile", "error", "differ", (("orders", "left", F.lit("orders"), always), ("orders", "right", F.lit("orders"), event & (F.col("o_orderstatus") != "P")))),
        contracts.reference_rule("no_empty_month", ("orders", F.when(event, month)), ("calendar", F.date_format("month", "yyyy-MM"), always), kind="empty"),
        contracts.Rule("volume_drop", "error", "low", (("orders", "left", month, event),), share=0.4),
        contracts.reference_rule("vintages_covered", ("orders", F.year("day")), ("years", "year", always), kind="uncovered"),
        contracts.value_rule("future_dates", "lines", "shipped", F.col("shipped") <= F.lit(dt.date(2001, 9, 1)), severity="warn"),
        contracts.value_rule("relationships_held", "orders", "o_custkey", F.coalesce("known", F.lit(False))),
    ]
    named = contracts.forbidden_columns(table(s, d, "customer"), ["name", "phone"]).count()
    return contracts.check_report(tables, rules, {"forbidden_columns": ("error", named)})


def _freshness(s, d):
    loaded = table(s, d, "orders").select(F.col("o_orderstatus").alias("source"), F.to_date("o_orderdate").alias("at")).unionByName(table(s, d, "events").select(F.col("event_type").alias("source"), F.to_date("ts").alias("at")))
    return contracts.freshness(loaded, F.lit(dt.date(2024, 2, 1)), 2, 1000)


def _metrics(s, d):
    share = lambda cond: F.avg(F.expr(cond).cast("int"))
    return contracts.quality_metrics([
        ("orders", table(s, d, "orders"), {"rows": (F.count("*"), None, "min"), "urgent_share": (share("o_orderpriority = '1-URGENT'"), 0.5, "max"), "closed_share": (share("o_orderstatus = 'F'"), 0.9, "min")}),
        ("items", items(s, d), {"returned_share": (share("l_returnflag = 'R'"), 0.9, "max"), "large_items": (F.count_if(F.col("l_quantity") > 45), None, "min")}),
        ("documents", table(s, d, "documents"), {"mean_chars": (F.avg("n_chars"), 10.0, "min"), "languages": (F.countDistinct("lang"), 4.0, "min")}),
    ])


def _metric_thresholds(s, d):
    return _metrics(s, d).where("status = 'failed'").select("source", "metric")


def _snapshot(s, d):
    """Two days of snapshots, the second written twice: the rewritten day replaces itself only."""
    path = own_folder(s, "history")
    rows = order_events(s, d).groupBy("area").agg(F.count("*").alias("value"))
    sinks.snapshot(rows, path, dt.date(2024, 1, 1))
    sinks.snapshot(rows.limit(0).unionByName(rows), path, dt.date(2024, 1, 2))
    sinks.snapshot(rows.withColumn("value", F.col("value") * 2), path, dt.date(2024, 1, 2))
    return s.read.parquet(path).select("area", "value", F.col("run_date").cast("date").alias("run_date"))


def _quality_history(s, d):
    path = own_folder(s, "quality")
    for day in (1, 2):
        sinks.snapshot(_metrics(s, d).select("metric", "value"), path, dt.date(2024, 1, day))
    return s.read.parquet(path).where(F.col("metric").endswith("_share")).select("metric", "value", F.col("run_date").cast("date").alias("run_date"))


def run_entries(s, d):
    """A log derived from orders: a run for each order, failed for status P."""
    return table(s, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("run"), F.col("o_orderpriority").alias("source"), F.when(F.col("o_orderstatus") == "P", "failed").otherwise("ok").alias("status"),
        F.col("o_custkey").alias("rows"), F.to_date("o_orderdate").alias("ended"),
    )


def _meta(s, d):
    runs = run_entries(s, d)
    sources = runs.groupBy("source").agg(F.concat(F.lit("runs until "), F.max("ended").cast("string")).alias("vintage"))
    sources = sources.unionByName(s.range(1).select(F.lit("never run").alias("source"), F.lit("none").alias("vintage")))
    months = order_events(s, d).select(F.date_format("month", "yyyy-MM").alias("period"))
    return sinks.publication_meta(sources, runs, months, table(s, d, "orders").select(F.to_date("o_orderdate").alias("day")), "day")


def _run_log(s, d):
    """Three extracts are written and logged with their rows; a fourth finds nothing and is logged as failed."""
    path = own_folder(s, "log")
    for source, condition in (("orders", "o_totalprice < 90000"), ("customer", "c_acctbal < 0"), ("part", "p_size = 1"), ("supplier", "s_suppkey < 0")):
        rows = table(s, d, source).where(condition)
        try:
            sinks.logged(s, path, source, lambda rows=rows, source=source: scans.non_empty(rows, f"{path}-{source}", source), condition=condition)
        except ValueError:
            pass  # the log has it
    return sinks.last_entries(s.read.parquet(path)).select("source", "status", "rows", "error", F.col("details")["condition"].alias("condition"), (F.col("ended") >= F.col("started")).alias("timed"))


def _written(s, d):
    path = own_folder(s, "typed")
    rows = sinks.write_typed(monthly(s, d), path, "month date, value int")
    return read_table(s, path).withColumn("rows_written", F.lit(rows).cast("long"))


def _csv(s, d):
    path = own_folder(s, "csv")
    sinks.write_csv(monthly(s, d), path, ["value", "month"], ["month"])
    return s.read.schema("value long, month date").option("header", True).option("mode", "FAILFAST").csv(path)


def _json(s, d):
    path = own_folder(s, "json")
    sinks.write_json(monthly(s, d), path)
    return s.read.schema("month date, value long").option("mode", "FAILFAST").json(path)


def _together(s, d):
    root = own_folder(s, "published")
    sinks.publish_together({"monthly": monthly(s, d), "areas": order_events(s, d).groupBy("area").count()}, root, "run-1")
    sinks.publish_together({"monthly": monthly(s, d).withColumn("value", F.col("value") + 1), "areas": order_events(s, d).groupBy("area").count()}, root, "run-2")
    return sinks.published(s, root, "monthly")


QUERIES = {f"check_{name}": (lambda s, d, name=name: checks(s, d)[name][1]) for name in (
    "unique", "not_null", "accepted_values", "relationships", "expression", "unique_expression", "forbidden_columns", "reconcile", "no_empty_month", "volume_drop", "vintages_covered", "future_dates",
)} | {
    "check_report": _report,
    "freshness": _freshness, "quality_metrics": _metrics, "metric_thresholds": _metric_thresholds, "snapshot_history": _snapshot, "quality_history": _quality_history,
    "run_log": _run_log, "latest_runs": lambda s, d: contracts.latest_runs(run_entries(s, d)), "last_runs": lambda s, d: sinks.last_entries(run_entries(s, d)), "publication_meta": _meta,
    "write_typed": _written, "write_csv": _csv, "write_json": _json, "publish_together": _together,
}

LINES = "l as (select l_orderkey, l_linenumber, l_quantity, l_returnflag, cast(l_shipdate as date) as shipped from lineitem)"
MONTHLY = f"mo as (select month, count(*) as value from ({EVENTS}) group by month)"
CHECKS = {
    "unique": "select l_orderkey || '|' || l_linenumber as item, count(*) as n from l group by l_orderkey, l_linenumber having count(*) > 1",
    "not_null": "select 'o_orderpriority' as item, count(*) as n from orders where o_orderpriority = '5-LOW' having count(*) > 0",
    "accepted_values": "select l_returnflag as item, count(*) as n from l where l_returnflag not in ('A', 'N') group by 1",
    "relationships": "select cast(l_orderkey as varchar) as item, count(*) as n from l where l_orderkey not in (select o_orderkey from orders where o_orderkey % 9 <> 0) group by 1",
    "expression": "select cast(cast(trunc(l_quantity) as int) as varchar) as item, count(*) as n from l where trunc(l_quantity) >= 49 group by 1",
    "unique_expression": "select lang || '-' || n_chars as item, count(*) as n from documents group by 1 having count(*) > 1",
    "forbidden_columns": "select 'c_name' as item, 1::bigint as n",
    "reconcile": "select 'orders' as item, count(*) filter (o_orderstatus = 'P') as n from orders having count(*) filter (o_orderstatus = 'P') > 0",
    "no_empty_month": f"select strftime(g, '%Y-%m') as item, 1::bigint as n from (select unnest(generate_series(date '1994-11-01', date '2001-08-01', interval 1 month)) as g) where cast(g as date) not in (select month from ({EVENTS}))",
    "volume_drop": "select strftime(month, '%Y-%m') as item, value as n from mo where value < 0.4 * (select median(value) from mo)",
    "vintages_covered": "select cast(year(o_orderdate) as varchar) as item, 1::bigint as n from orders where year(o_orderdate) not between 1996 and 2001 group by 1",
    "future_dates": "select cast(shipped as varchar) as item, count(*) as n from l where shipped > date '2001-09-01' group by 1",
    "relationships_held": "select cast(o_custkey as varchar) as item, count(*) as n from orders where o_custkey not in (select c_custkey from customer) group by 1",
}
METRICS = """
me as (
  select 'orders' as source, 'rows' as metric, cast(count(*) as double) as value, cast(null as double) as threshold, 'min' as sense from orders
  union all select 'orders', 'urgent_share', avg(cast(o_orderpriority = '1-URGENT' as int)), 0.5, 'max' from orders
  union all select 'orders', 'closed_share', avg(cast(o_orderstatus = 'F' as int)), 0.9, 'min' from orders
  union all select 'items', 'returned_share', avg(cast(l_returnflag = 'R' as int)), 0.9, 'max' from lineitem
  union all select 'items', 'large_items', count(*) filter (l_quantity > 45), null, 'min' from lineitem
  union all select 'documents', 'mean_chars', avg(n_chars), 10, 'min' from documents
  union all select 'documents', 'languages', count(distinct lang), 4, 'min' from documents),
ms as (select *, case when threshold is null then 'info' when (sense = 'min' and value >= threshold) or (sense = 'max' and value <= threshold) then 'ok' else 'failed' end as status from me)"""
RUNS = """
ru as (select cast(o_orderkey as varchar) as run, o_orderpriority as source, case when o_orderstatus = 'P' then 'failed' else 'ok' end as status, o_custkey as rows, cast(o_orderdate as date) as ended from orders),
la as (select * from ru qualify row_number() over (partition by source, status order by ended desc, run desc) = 1)"""
REPORT = "\nunion all ".join(f"select '{k}' as name, '{'warn' if k == 'future_dates' else 'error'}' as severity, count(*) as violations, cast(coalesce(sum(n), 0) as bigint) as failing_rows from ({sql})" for k, sql in CHECKS.items())

ORACLES = {f"check_{k}": f"with {LINES}, {MONTHLY} {sql}" for k, sql in CHECKS.items() if k != "relationships_held"} | {
    "check_report": f"with {LINES}, {MONTHLY}, r as ({REPORT}) select name as \"check\", severity, violations, failing_rows, case when violations = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status from r",
    "freshness": """with x as (select o_orderstatus as source, cast(o_orderdate as date) as day from orders union all select event_type, cast(ts as date) from events),
g as (select source, max(day) as last, cast(date '2024-02-01' - max(day) as int) as age_days from x group by source) select *, case when age_days > 1000 then 'error' when age_days > 2 then 'warn' else 'pass' end as status from g""",
    "quality_metrics": f"with {METRICS} select * from ms",
    "metric_thresholds": f"with {METRICS} select source, metric from ms where status = 'failed'",
    "snapshot_history": f"with a as (select area, count(*) as value from ({EVENTS}) group by area) select area, value, date '2024-01-01' as run_date from a union all select area, value * 2, date '2024-01-02' from a",
    "quality_history": f"with {METRICS} select metric, value, d as run_date from ms, (values (date '2024-01-01'), (date '2024-01-02')) t(d) where metric like '%\\_share' escape '\\'",
    "latest_runs": f"with {RUNS} select * from la",
    "run_log": """select 'orders' as source, 'ok' as status, count(*) as rows, cast(null as varchar) as error, 'o_totalprice < 90000' as condition, true as timed from orders where o_totalprice < 90000
  union all select 'customer', 'ok', count(*), null, 'c_acctbal < 0', true from customer where c_acctbal < 0 union all select 'part', 'ok', count(*), null, 'p_size = 1', true from part where p_size = 1
  union all select 'supplier', 'failed', null, 'supplier: no rows', 's_suppkey < 0', true from (select count(*) as n from supplier where s_suppkey < 0) where n = 0""",
    "last_runs": f"with {RUNS} select * from ru order by ended desc, run limit 60",
    "publication_meta": f"""with {RUNS},
so as (select source, 'runs until ' || max(ended) as vintage from ru group by source union all select 'never run', 'none')
select source, vintage, (select max(ended) from ru where ru.source = so.source and status = 'ok') as extracted, (select strftime(min(month), '%Y-%m') from ({EVENTS})) as first_period,
  (select strftime(max(month), '%Y-%m') from ({EVENTS})) as last_period, (select max(cast(o_orderdate as date)) from orders) as last_published from so""",
    "write_typed": f"with {MONTHLY} select month, cast(value as int) as value, (select count(*) from mo) as rows_written from mo",
    "write_csv": f"with {MONTHLY} select value, month from mo",
    "write_json": f"with {MONTHLY} select month, value from mo",
    "publish_together": f"with {MONTHLY} select month, value + 1 as value from mo",
}
