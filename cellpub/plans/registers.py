"""Queries of scans, scalars, registers and dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellpub.functions import scalars
from cellpub.operators import dims, registers
from cellpub.plans.facts import EVENTS
from cellpub.plans.tables import order_events, table
from cellpub.sources import scans
from cellpub.sources.buckets import BucketTable
from cellpub.sources.shared import own_folder

START, REFERENCE = dt.date(1996, 1, 1), dt.date(2001, 6, 1)


def orders(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").withColumn("day", F.to_date("o_orderdate"))


def _scan(s, d):
    schema = T.StructType([T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())])
    return scans.scan_table(s, f"{d}/region.parquet", schema)


def _union_by_name(s, d):
    """Two slices of parts with different columns, written as two files and read as one table."""
    path = own_folder(s, "parts-by-size")
    part = table(s, d, "part")
    part.where("p_size <= 25").select("p_partkey", "p_brand").write.parquet(f"{path}/slice=1")
    part.where("p_size > 25").select("p_partkey", "p_size").write.parquet(f"{path}/slice=2")
    return scans.scan_union_by_name(s, f"{path}/slice=1", f"{path}/slice=2").select("p_partkey", "p_brand", "p_size")


def _slice(s, d):
    return scans.extract_slice(table(s, d, "part"), ["p_partkey", "p_brand"], "p_brand", ["Brand#1", "Brand#2"])


def _related(s, d):
    return scans.extract_related(table(s, d, "lineitem").select("l_orderkey", "l_quantity"), orders(s, d).where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


def _months(s, d):
    months = orders(s, d).groupBy(scalars.month_label(F.trunc("day", "month")).alias("month")).agg(F.max("day").alias("last"))
    manifest = months.select("month", F.date_add("last", F.when(F.substring("month", 6, 2).isin("03", "07"), 0).otherwise(10)).alias("extracted_at"))
    return scans.months_to_read(s, dt.date(1999, 1, 1), dt.date(2001, 8, 15), manifest)


def _sources(s, d):
    versions = table(s, d, "nation").select(F.col("n_name").alias("source"), F.concat(F.lit("v"), F.col("n_regionkey")).alias("version"), F.lit("all").alias("filter"))
    files = {f"NATION_{i}": f"{d}/{'nation' if i % 4 else 'lost'}.parquet" for i in range(25)}
    return scans.sources_to_read(versions, versions.withColumn("version", F.when(F.col("version") == "v3", "v2").otherwise(F.col("version"))), files)


def _survey(s, d):
    """Parts sold by year, type and brand in a sheet with other headers and order; counts below 3 are masked as '*'."""
    sold = table(s, d, "lineitem").join(table(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand"), "l_partkey")
    n, hard = F.count("*"), F.count_if(F.col("l_quantity") > 40)
    sheet = sold.groupBy(F.year("l_shipdate").alias("Year "), F.col("p_brand").alias("Brand code"), F.col("p_type").alias("TYPE_lbl")).agg(
        F.when(n < 3, "*").otherwise(n.cast("string")).alias("met"), F.when(hard < 3, "*").otherwise(hard.cast("string")).alias("x_met")
    )
    return scans.load_survey(sheet, {"year": "year", "kind": "type.*", "brand": "brandcode", "projects": "met", "hard": "xmet"}, ["year", "projects", "hard"], secret_of="projects")


def _zoning(s, d):
    sheet = table(s, d, "nation").select(F.col("n_nationkey").alias("Code-Area"), F.col("n_name").alias("Area label"), F.col("n_regionkey").alias("BASIN 26"))
    return scans.load_zoning(sheet, {"area": "codearea", "label": "arealabel", "basin": "basin26"}, "area", 2026)


def _perimeter(s, d):
    nation = table(s, d, "nation")
    return scans.restrict_perimeter(nation, nation.where("n_regionkey in (1, 2)").select("n_nationkey"), "n_nationkey")


def _delta(s, d):
    base, delta = orders(s, d).where("day < date '2000-01-01'"), orders(s, d).where("o_orderkey % 3 = 0")
    return scans.delta_since(base, delta, "day", "day", START).select("o_orderkey", "day")


def _areas(s, d):
    names = table(s, d, "customer").groupBy("c_nationkey").agg(F.collect_set(F.when(F.col("c_custkey") % 50 == 7, F.lpad((F.col("c_custkey") % 97).cast("string"), 3, "0"))).alias("codes"), F.count("*").alias("n"))
    nested = names.join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.struct(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"), F.struct(F.col("n_regionkey").cast("string").alias("code")).alias("parent"), F.col("n").alias("population"), F.when(F.size("codes") > 0, F.col("codes")).alias("postal_codes")).alias("area")
    )
    return scans.flatten_area(nested).withColumn("postal_codes", F.array_join("postal_codes", ","))


def _json(s, d):
    k = scalars.tolerant_json(F.col("props"))
    return table(s, d, "events").select("event_id", F.try_variant_get(k, "$.k", "long").alias("k"), scalars.strict_date(F.date_format("ts", "yyyy-MM-dd")).alias("day"))


def _raw_notices(s, d):
    """Customers as raw notices: objects and lists, malformed and missing JSON, odd dates, blanks in identifiers."""
    key, lit, text = F.col("c_custkey"), F.lit, lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    ident = F.lpad(key.cast("string"), 9, "8")
    person = text('{"typePersonne": "pm", "activite": " Of  ', F.col("c_mktsegment"), ' "}')
    persons = F.when(key % 97 == 0, "{bad").when(key % 2 == 0, text('{"personne": ', person, "}")).otherwise(text('{"personne": [', person, ', {"typePersonne": "pp"}]}'))
    number = F.when(key % 5 == 0, text('"', key % 4000 + 1, '"')).when(key % 5 == 1, text(key % 4000 + 1)).otherwise(lit('"x"'))
    return table(s, d, "customer").select(
        text("A", key).alias("id"), F.when(key % 2 == 0, "A").otherwise("B").alias("publicationavis"), text("2025", key % 90 + 10).alias("parution"),
        F.when(key % 7 == 0, "01/02/2024").otherwise(text("2024-02-", key % 19 + 10)).alias("dateparution"), (key % 500).alias("numeroannonce"), lit("annonce").alias("typeavis"),
        F.col("c_mktsegment").alias("familleavis"), F.col("c_nationkey").alias("numerodepartement"), F.col("c_name").alias("tribunal"), F.when(key % 3 != 0, "Town").alias("ville"), F.lpad((key % 9999).cast("string"), 5, "0").alias("cp"),
        F.when(key % 13 != 0, F.array(ident, F.concat_ws(" ", F.substring(ident, 1, 3), F.substring(ident, 4, 3), F.substring(ident, 7, 3)), lit("12 34"), lit("987654321"))).alias("registre"),
        persons.alias("listepersonnes"), F.when(key % 3 == 0, '{"etablissement": {"activite": "Non Pr\u00e9cis\u00e9 "}}').when(key % 3 == 1, '{"etablissement": [{"activite": "Shop\\tNo 1"}]}').alias("listeetablissements"),
        F.when(key % 4 != 3, text('{"famille": "f", "nature": "n', key % 3, '", "date": "2024-0', F.when(key % 6 == 0, "3-5").otherwise("3-05"), '"}')).otherwise("").alias("jugement"),
        F.when(key % 4 == 0, '{"vente": {"categorieVente": "v"}}').when(key % 4 == 1, '{"vente": [{"categorieVente": "w"}], "creation": {"categorieCreation": "c"}}').alias("acte"),
        F.when(key % 5 < 3, text('{"nomPublication": "PAPER B", "numeroParution": "2025", "numeroAnnonce": ', number, "}")).alias("parutionavisprecedent"),
    )


def _current(s, d):
    """Line items of an order as periods that end with the next shipment."""
    items = table(s, d, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("begins"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    periods = items.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("begins", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"))).alias("p"))
    ended = F.transform("p", lambda x, i: F.struct(x["begins"].alias("begins"), x["l_partkey"].alias("part"), F.get("p", i + 1)["begins"].alias("ends")))
    now = scalars.current_period(F.col("periods"), "ends")
    return periods.select("l_orderkey", ended.alias("periods")).select("l_orderkey", now["begins"].alias("begins"), now["part"].alias("part"))


def _stage(s, d):
    gate = scalars.nomenclature_gate(F.col("c_mktsegment"), F.when(F.col("c_custkey") % 4 == 0, "old").otherwise("new"), "new")
    return scans.stage(table(s, d, "customer"), {
        "id": F.lpad(F.col("c_custkey").cast("string"), 9, "0"), "area": F.col("c_nationkey").cast("string"), "code": gate, "is_first": F.col("c_nationkey") == 0,
        "seat": F.concat(F.col("c_nationkey").cast("string"), F.lit("-"), F.when(F.col("c_custkey") % 10 != 0, F.col("c_name"))),
        "balance": F.round("c_acctbal", 0).cast("long"), "vintage": scalars.vintage_label(F.col("c_nationkey"), 12, "old", "new"),
    })


def _event_rules(kind):
    return [(kind == "F", "closing"), (F.lower(kind) == "o", "opening"), (F.col("nature").ilike("%urgent%"), "other_urgent")]


def notices(s, d) -> DataFrame:
    published = F.col("day")
    return orders(s, d).select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderkey") - 1).alias("previous_id"), F.col("o_orderstatus").alias("kind"), F.col("o_orderpriority").alias("nature"),
        published.alias("published"), F.when(F.col("o_orderkey") % 13 != 0, F.date_sub(published, ((F.col("o_orderkey") % 500) - 20).cast("int"))).alias("judged"), F.col("o_custkey").alias("parent"),
    )


PROCEDURES = [("%urgent%", "liquidation"), ("%high%", "recovery"), ("%medium%", "safeguard")]


def _valid(s, d):
    return registers.valid_notices(notices(s, d), _event_rules(F.col("kind")), PROCEDURES, "opening", F.col("id") % 11 == 0)


def _merge(s, d):
    base = table(s, d, "orders").select("o_orderkey", "o_totalprice")
    return registers.merge_latest_wins(base, base.where("o_orderkey % 7 = 0").withColumns({"o_totalprice": F.col("o_totalprice") + 1000, "treated": F.lit("delta")}), ["o_orderkey"])


def _by_buckets(s, d):
    """The same merge into a stored table, where the delta has keys in some buckets only, and a second one of a single row."""
    base = table(s, d, "orders").select("o_orderkey", "o_totalprice")
    stored = BucketTable.create(base, own_folder(s, "orders"), ["o_orderkey"], 32)
    delta = base.where("o_orderkey % 7 = 0 and pmod(xxhash64(o_orderkey), 32) < 8")
    stored.merge(delta.withColumns({"o_totalprice": F.col("o_totalprice") + 1000, "treated": F.lit("delta")}))
    stored.merge(base.groupBy().agg(F.max("o_orderkey").alias("o_orderkey")).withColumns({"o_totalprice": F.lit(1.0), "treated": F.lit("last")}))
    changed = F.col("treated") == "delta"
    # Which buckets a key is in is not said in SQL: changed rows come out as they were.
    return stored.read().select("o_orderkey", F.round(F.when(changed, F.col("o_totalprice") - 1000).otherwise(F.col("o_totalprice")), 2).alias("o_totalprice"), F.when(F.col("treated") == "last", True).alias("is_last"))


def _open_months(s, d):
    """Orders stored by month; only the months that are still to be read are."""
    path = own_folder(s, "orders-by-month")
    scans.write_by_month(orders(s, d).select("o_orderkey", "day"), path, "day")
    return scans.read_months(s, path, _months(s, d), "1999-01")


def _clustered(s, d):
    path = own_folder(s, "parts-by-brand")
    scans.write_clustered(table(s, d, "part").select("p_partkey", "p_brand", "p_size"), path, "p_brand")
    return scans.extract_slice(s.read.parquet(path), ["p_partkey", "p_brand"], "p_brand", ["Brand#1", "Brand#2"])


def _latest(s, d):
    items = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped"), "l_extendedprice", "l_partkey", "l_suppkey")
    return registers.latest_version(items, ["l_orderkey", "l_linenumber"], [F.desc("shipped"), F.desc("l_extendedprice"), F.desc("l_partkey"), F.desc("l_suppkey")])


def _names(s, d):
    """Texts with the word CEDEX at the start, at the end, and inside other words."""
    k, text = F.col("doc_id") % 5, F.col("text")
    odd = F.when(k == 0, F.concat(F.lit("Cedex 9 "), text)).when(k == 1, F.concat(text, F.lit(" Cedexia"))).when(k == 2, F.concat(text, F.lit(" cedex 12"))).when(k == 3, F.concat(F.lit("Ste-"), text, F.lit(" PRECEDEX"))).otherwise(F.concat(F.lit("La "), text))
    return table(s, d, "documents").select("doc_id", scalars.normalize_name(odd).alias("name"))


def _places(s, d):
    return table(s, d, "nation").select(F.col("n_nationkey").alias("area"), (F.col("n_nationkey") % 7).alias("code"), scalars.normalize_name(F.concat(F.lit("Ste-"), "n_name", F.when(F.col("n_nationkey") % 3 == 0, " Cedex 9").otherwise(""))).alias("name"))


def placed(rows, key):
    """Postal code and place name of each event, by its parent."""
    k = F.col(key)
    return rows.withColumns({"code": F.when(k % 9 != 0, k % 8), "name": scalars.normalize_name(F.concat(F.lit("Sainte NATION_"), (k % 26).cast("string")))})


def linked(s, d, events):
    """Events (event, parent, ...) by place, seat and register. Seats and parents know the activity of some customers each; every sixth parent is not registered."""
    key, activity = F.col("c_custkey"), F.col("c_mktsegment")
    customers = table(s, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    seats = customers.where(key % 4 != 0).select(key.alias("parent"), F.col("c_nationkey").alias("area"), F.when(key % 2 == 0, activity).alias("activity"))
    parents = customers.where(key % 6 != 1).select(key.alias("parent"), F.when(key % 3 == 0, activity).alias("activity"))
    return registers.link_records(placed(events, "parent"), _places(s, d), seats, parents)


def codes(s, d):
    """Activities with division and section; one that events have is not in the hierarchy."""
    segment = F.col("c_mktsegment")
    return table(s, d, "customer").where(segment != "MACHINERY").select(segment.alias("activity"), F.concat(segment, F.lit("/1-URGENT")).alias("division"), segment.alias("section")).distinct()


def localised(s, d, events):
    """Linked events with sectors; of five events one has a label for a division and one for a section."""
    e = F.col("event")
    section = F.when(e % 10 < 5, "BUILDING").otherwise("FURNITURE")
    level = F.when(e % 5 == 0, "division").when(e % 5 == 1, "section")
    labels = events.select(e, level.alias("level"), F.when(e % 5 == 0, F.concat(section, F.lit("/5-LOW"))).alias("label_division"), section.alias("label_section")).where("level is not null")
    return registers.localised_events(linked(s, d, events), codes(s, d), labels)


def _customers(s, d):
    return table(s, d, "customer").select(F.col("c_custkey").alias("event"), F.col("c_custkey").alias("parent"))


def _links(s, d):
    return linked(s, d, _customers(s, d))


def _localised(s, d):
    return localised(s, d, _customers(s, d)).select("event", "area", "method", "in_register", "sector_source", "division", "section")


def units(s, d) -> DataFrame:
    customers = table(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("area"), F.col("c_mktsegment").alias("code"))
    return orders(s, d).join(customers, "o_custkey").select(F.col("o_orderkey").alias("unit"), F.col("o_custkey").alias("parent"), "area", F.col("day").alias("created"), "code", (F.col("o_orderpriority") == "1-URGENT").alias("is_seat"))


def succession(s, d) -> DataFrame:
    return table(s, d, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_orderkey").alias("successor"))


def perimeter(s, d) -> DataFrame:
    return table(s, d, "nation").where("n_regionkey in (0, 2)").select(F.col("n_nationkey").alias("area"))


def _creations_units(s, d, of=None):
    return registers.creations_units(units(s, d) if of is None else of, perimeter(s, d), succession(s, d), F.lit(START), F.lit(REFERENCE))


def _creations_parents(s, d, of=None):
    parents = orders(s, d).groupBy("o_custkey").agg(F.min("o_orderkey").alias("seat"), F.min("day").alias("created")).select(F.col("o_custkey").alias("parent"), "seat", "created", F.when(F.col("o_custkey") % 3 == 0, 1000).otherwise(5000).alias("legal_form"))
    return registers.creations_parents(parents, units(s, d) if of is None else of, perimeter(s, d), succession(s, d), F.lit(START), F.lit(REFERENCE))


def _hierarchy(s, d):
    codes = order_events(s, d).select(F.concat_ws("/", "division", "detail").alias("code"), "division", "section").distinct()
    divisions = codes.select("division", F.lower("division").alias("l")).distinct().where("division not like '%LOW'")
    return dims.sector_hierarchy(codes, divisions, codes.select("section", F.initcap("section").alias("l")).distinct())


QUERIES = {
    "scan_table": _scan, "scan_union_by_name": _union_by_name, "extract_slice": _slice, "extract_related": _related, "months_to_read": _months, "skip_unchanged_version": _sources,
    "load_survey": _survey, "load_zoning": _zoning, "restrict_perimeter": _perimeter, "delta_since_watermark": _delta, "flatten_area": _areas, "json_flatten": _json,
    "flatten_notice": lambda s, d: registers.flatten_notice(_raw_notices(s, d)), "flatten_current_period": _current, "stage_rename_type": _stage,
    "load_hierarchy": lambda s, d: scans.load_hierarchy(order_events(s, d), ["detail", "division", "section"]),
    "empty_supplement": lambda s, d: scans.empty_supplement(table(s, d, "orders")).select("o_orderkey", "o_totalprice").unionByName(table(s, d, "orders").select("o_orderkey", "o_totalprice")),
    "normalize_name": _names,
    "fingerprint": lambda s, d: table(s, d, "documents").select("doc_id", scalars.fingerprint(F.lit("v1"), F.lit("model"), F.col("text")).alias("print")),
    "explode_codes": lambda s, d: table(s, d, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("code")).groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("code").alias("codes")),
    "january_effect": lambda s, d: order_events(s, d).groupBy("month").count().select("month", scalars.january_effect(F.lit("creations_units"), F.col("month")).alias("january")),
    "read_open_months": _open_months, "extract_clustered": _clustered, "merge_by_buckets": _by_buckets, "merge_latest_wins": _merge, "latest_version": _latest, "valid_notices": _valid, "link_records": _links, "localised_events": _localised,
    "creations_units": lambda s, d: _creations_units(s, d), "creations_parents": lambda s, d: _creations_parents(s, d),
    "area_dimension": lambda s, d: dims.area_dimension(table(s, d, "nation").select(F.col("n_nationkey").alias("area"), "n_name", "n_regionkey"), table(s, d, "region").where("r_regionkey < 4").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey"),
    "sector_hierarchy": _hierarchy, "sector_members": lambda s, d: dims.sector_members(order_events(s, d).select("division", "section")),
}

O = "(select *, cast(o_orderdate as date) as day from orders)"
NAME = r"""regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(trim(regexp_replace(upper(strip_accents(coalesce({0}, ''))), '[^A-Z0-9]+', ' ', 'g')), '\bCEDEX\b.*$', '')), '\bSTE\b', 'SAINTE', 'g'), '\bST\b', 'SAINT', 'g'), '^(LE|LA|LES|L) ', '')"""
NOTICES = f"""
n as (
  select o_orderkey as id, case when o_orderkey % 11 = 0 then o_orderkey - 1 end as previous_id, o_orderstatus as kind, o_orderpriority as nature, day as published,
         case when o_orderkey % 13 <> 0 then cast(day - cast(o_orderkey % 500 - 20 as int) as date) end as judged, o_custkey as parent from {O}),
v0 as (
  select *, case when kind = 'F' then 'closing' when lower(kind) = 'o' then 'opening' when nature ilike '%urgent%' then 'other_urgent' end as event
  from n where id not in (select previous_id from n where previous_id is not null)),
v as (
  select *, case when event <> 'opening' then null when nature ilike '%urgent%' then 'liquidation' when nature ilike '%high%' then 'recovery' when nature ilike '%medium%' then 'safeguard' else 'other_procedure' end as procedure,
         case when judged between cast(published - interval 1 year as date) and published then judged else published end as event_date,
         judged is null or judged not between cast(published - interval 1 year as date) and published as incoherent_date
  from v0)"""
UNITS = f"""
u as (
  select o_orderkey as unit, o_custkey as parent, c_nationkey as area, day as created, c_mktsegment as code, o_orderpriority = '1-URGENT' as is_seat from {O} join customer on o_custkey = c_custkey),
l as (select distinct l_orderkey as successor from lineitem where l_returnflag = 'R' and l_quantity > 45),
a as (select n_nationkey as area from nation where n_regionkey in (0, 2)),
cu as (
  select unit, parent, area, created, cast(date_trunc('month', created) as date) as month, code, is_seat, successor is not null as is_takeover, created > date '2001-06-01' as is_future
  from u join a using (area) left join l on unit = successor where created >= date '1996-01-01'),
cp as (
  select p.parent, p.created, cast(date_trunc('month', p.created) as date) as month, u.area, u.code, p.parent % 3 = 0 as is_individual, successor is not null as is_takeover, p.created > date '2001-06-01' as is_future
  from (select o_custkey as parent, min(o_orderkey) as seat, min(day) as created from {O} group by o_custkey) p join u on u.unit = p.seat join a on a.area = u.area left join l on p.seat = successor
  where p.created >= date '1996-01-01')"""
PLACES = f"""
pl as (select n_nationkey as area, n_nationkey % 7 as code, {NAME.format("'Ste-' || n_name || case when n_nationkey % 3 = 0 then ' Cedex 9' else '' end")} as name from nation),
ex as (select code, name, min(area) as ex from pl group by all having count(distinct area) = 1),
un as (select code, min(area) as un from pl group by all having count(distinct area) = 1),
st as (select c_custkey as parent, c_nationkey as seat, case when c_custkey % 2 = 0 then c_mktsegment end as act from customer where c_custkey % 4 <> 0),
pa as (select c_custkey as parent, case when c_custkey % 3 = 0 then c_mktsegment end as act from customer where c_custkey % 6 <> 1),
na as (select distinct c_mktsegment as code, c_mktsegment || '/1-URGENT' as division, c_mktsegment as section from customer where c_mktsegment <> 'MACHINERY')"""


def links_sql(events: str) -> str:
    """CTEs ``lk`` (linked) and ``x`` (localised) of events (event, parent)."""
    return f"""{PLACES},
ev as (select *, case when parent % 9 <> 0 then parent % 8 end as code, {NAME.format("'Sainte NATION_' || (parent % 26)")} as name from ({events})),
lk as (
  select ev.*, coalesce(ex, un, seat) as area, case when ex is not null then 'code_and_name' when un is not null then 'code' when seat is not null then 'seat' else 'none' end as method,
         pa.parent is not null as in_register, coalesce(pa.act, st.act) as activity
  from ev left join ex using (code, name) left join un using (code) left join st on st.parent = ev.parent left join pa on pa.parent = ev.parent),
jl as (
  select event, case event % 5 when 0 then 'division' when 1 then 'section' end as level, case when event % 5 = 0 then case when event % 10 < 5 then 'BUILDING' else 'FURNITURE' end || '/5-LOW' end as division,
         case when event % 10 < 5 then 'BUILDING' else 'FURNITURE' end as section
  from ev where event % 5 in (0, 1)),
x as (
  select lk.*, case when activity is not null then 'register' when jl.level = 'division' then 'label_division' when jl.level = 'section' then 'label_section' else 'none' end as sector_source,
         coalesce(na.division, jl.division, jl.section || '_ND', 'ZZ') as division, coalesce(na.section, jl.section, 'ZZ') as section
  from lk left join na on na.code = lk.activity left join jl on jl.event = lk.event and lk.activity is null)"""


LINKS = links_sql("select c_custkey as event, c_custkey as parent from customer")

ORACLES = {
    "scan_table": "select r_regionkey, r_name from region",
    "scan_union_by_name": "select p_partkey, case when p_size <= 25 then p_brand end as p_brand, case when p_size > 25 then p_size end as p_size from part",
    "extract_slice": "select p_partkey, p_brand from part where p_brand like 'Brand#1%' or p_brand like 'Brand#2%'",
    "extract_related": "select l_orderkey, l_quantity from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'P')",
    "months_to_read": f"""with m as (select date_trunc('month', day) as m, max(day) as last from {O} group by 1),
c as (select strftime(m, '%Y-%m') as month from m where last + case when month(m) in (3, 7) then 0 else 10 end >= cast(last_day(m) + 3 as date))
select strftime(g, '%Y-%m') as month from (select unnest(generate_series(date '1999-01-01', date '2001-08-01', interval 1 month)) as g) where strftime(g, '%Y-%m') not in (select month from c)""",
    "skip_unchanged_version": "select n_name as source, 'v' || n_regionkey as version, 'all' as filter from nation where n_regionkey = 3 or cast(substring(n_name, 8) as int) % 4 = 0",
    "load_survey": """select cast(year(l_shipdate) as int) as year, p_type as kind, p_brand as brand, case when count(*) >= 3 then cast(count(*) as int) end as projects,
  case when count(*) filter (l_quantity > 40) >= 3 then cast(count(*) filter (l_quantity > 40) as int) end as hard, count(*) < 3 as secret from lineitem join part on l_partkey = p_partkey group by year(l_shipdate), p_type, p_brand""",
    "load_zoning": "select lpad(cast(n_nationkey as varchar), 5, '0') as area, n_name as label, cast(n_regionkey as varchar) as basin, 2026 as vintage from nation",
    "restrict_perimeter": "select * from nation where n_regionkey in (1, 2)",
    "delta_since_watermark": f"select o_orderkey, day from {O} where o_orderkey % 3 = 0 and day >= (select max(day) from {O} where day < date '2000-01-01') and day >= date '1996-01-01'",
    "flatten_area": """select cast(n_nationkey as varchar) as code, n_name as name, cast(n_regionkey as varchar) as parent, cast(count(*) as int) as population,
  coalesce(array_to_string(list_sort(list(distinct lpad(cast(c_custkey % 97 as varchar), 3, '0')) filter (c_custkey % 50 = 7)), ','), '') as postal_codes from customer join nation on c_nationkey = n_nationkey group by all""",
    "json_flatten": "select event_id, cast(json_extract(props, '$.k') as bigint) as k, cast(ts as date) as day from events",
    "flatten_notice": """select 'A' || c_custkey as id, case when c_custkey % 2 = 0 then 'A' else 'B' end as publication, '2025' || (c_custkey % 90 + 10) as issue,
  case when c_custkey % 7 <> 0 then cast('2024-02-' || (c_custkey % 19 + 10) as date) end as published, cast(c_custkey % 500 as varchar) as number, 'annonce' as notice_type, c_mktsegment as family,
  cast(c_nationkey as varchar) as department, c_name as court, case when c_custkey % 3 <> 0 then 'Town' end as town, lpad(cast(c_custkey % 9999 as varchar), 5, '0') as postal_code,
  case when c_custkey % 13 <> 0 then lpad(cast(c_custkey as varchar), 9, '8') end as company, case when c_custkey % 13 <> 0 then 2 else 0 end as n_companies,
  case when c_custkey % 97 <> 0 then 'pm' end as person_type, case when c_custkey % 4 <> 3 then 'f' end as judgment_family, case when c_custkey % 4 <> 3 then 'n' || (c_custkey % 3) end as judgment_nature,
  case when c_custkey % 4 <> 3 and c_custkey % 6 <> 0 then date '2024-03-05' end as judged, case c_custkey % 4 when 0 then 'v' when 1 then 'w' end as sale_category, case c_custkey % 4 when 1 then 'c' end as creation_category,
  case when c_custkey % 5 < 2 then 'B2025' || (c_custkey % 4000 + 1) end as previous_id,
  case when c_custkey % 3 = 1 then 'Shop No 1' when c_custkey % 97 <> 0 then 'Of ' || c_mktsegment end as activity from customer""",
    "flatten_current_period": """select l_orderkey, cast(l_shipdate as date) as begins, l_partkey as part from lineitem
  qualify row_number() over (partition by l_orderkey order by cast(l_shipdate as date) desc, l_partkey desc, l_suppkey desc, l_linenumber desc, l_quantity desc) = 1""",
    "stage_rename_type": """select lpad(cast(c_custkey as varchar), 9, '0') as id, cast(c_nationkey as varchar) as area, case when c_custkey % 4 <> 0 then c_mktsegment end as code, c_nationkey = 0 as is_first,
  c_nationkey || '-' || case when c_custkey % 10 <> 0 then c_name end as seat, cast(round(c_acctbal, 0) as bigint) as balance, case when c_nationkey <= 12 then 'old' else 'new' end as vintage from customer""",
    "load_hierarchy": f"select distinct detail, division, section from ({EVENTS})",
    "empty_supplement": "select o_orderkey, o_totalprice from orders",
    "normalize_name": f"""select doc_id, {NAME.format("case doc_id % 5 when 0 then 'Cedex 9 ' || text when 1 then text || ' Cedexia' when 2 then text || ' cedex 12' when 3 then 'Ste-' || text || ' PRECEDEX' else 'La ' || text end")} as name from documents""",
    "fingerprint": "select doc_id, left(sha256('v1|model|' || text), 16) as print from documents",
    "explode_codes": "select doc_id, count(*) as n, count(distinct code) as codes from (select doc_id, unnest(string_split(text, ' ')) as code from documents) group by doc_id",
    "january_effect": f"select distinct month, month(month) = 1 as january from ({EVENTS})",
    "extract_clustered": "select p_partkey, p_brand from part where p_brand like 'Brand#1%' or p_brand like 'Brand#2%'",
    "read_open_months": f"""with m as (select date_trunc('month', day) as m, max(day) as last from {O} group by 1),
c as (select m from m where last + case when month(m) in (3, 7) then 0 else 10 end >= cast(last_day(m) + 3 as date))
select strftime(day, '%Y-%m') as month, o_orderkey, day from {O} where day >= date '1999-01-01' and day < date '2001-09-01' and date_trunc('month', day) not in (select m from c)""",
    "merge_by_buckets": """select o_orderkey, case when o_orderkey = (select max(o_orderkey) from orders) then 1.0 else round(o_totalprice, 2) end as o_totalprice,
  case when o_orderkey = (select max(o_orderkey) from orders) then true end as is_last from orders""",
    "merge_latest_wins": "select o_orderkey, case when o_orderkey % 7 = 0 then o_totalprice + 1000 else o_totalprice end as o_totalprice, case when o_orderkey % 7 = 0 then 'delta' end as treated from orders",
    "latest_version": """select l_orderkey, l_linenumber, cast(l_shipdate as date) as shipped, l_extendedprice, l_partkey, l_suppkey from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber order by cast(l_shipdate as date) desc, l_extendedprice desc, l_partkey desc, l_suppkey desc) = 1""",
    "valid_notices": f"with {NOTICES} select * from v",
    "link_records": f"with {LINKS} select event, code, name, parent, area, method, in_register, activity from lk",
    "localised_events": f"with {LINKS} select event, area, method, in_register, sector_source, division, section from x",
    "creations_units": f"with {UNITS} select * from cu",
    "creations_parents": f"with {UNITS} select * from cp",
    "area_dimension": "select n_regionkey, n_nationkey as area, n_name, r_name from nation left join (select * from region where r_regionkey < 4) on n_regionkey = r_regionkey",
    "sector_hierarchy": f"""select distinct division || '/' || detail as code, division, section, case when division not like '%LOW' then lower(division) end as division_label, upper(left(section, 1)) || lower(substring(section, 2)) as section_label from ({EVENTS})""",
    "sector_members": f"with e as ({EVENTS}) select distinct division, section from e union all select distinct section || '_ND', section from e union all select 'ZZ', 'ZZ'",
}
