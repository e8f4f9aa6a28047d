"""Orders counted by month and all dimensions; the cube is built from them."""

from __future__ import annotations

from cellpub.operators.facts import counted
from cellpub.plans.tables import order_events

KEYS = ["month", "area", "section", "division", "detail"]

QUERIES = {"monthly_counts": lambda spark, d: counted(order_events(spark, d), KEYS)}

EVENTS = """
select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as month, cast(c_nationkey as varchar) as area,
       c_mktsegment as section, c_mktsegment || '/' || o_orderpriority as division, o_orderstatus as detail
from orders join customer on o_custkey = c_custkey"""

ORACLES = {
    "monthly_counts": f"""
select month, area, section, division, detail, cast(count(*) as bigint) as value
from ({EVENTS}) group by all"""
}
