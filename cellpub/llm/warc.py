"""Not-modified revisits of a crawl, resolved against earlier full responses.

Records (responses and revisits, as in WARC files) meet by canonical URL. Each revisit is joined as of its date to the latest full
response strictly before it. Its validators are checked (entity tags by weak comparison, else modification dates), and
the headers that a 304 may update replace those of the stored response.

The as-of join sorts all records once by (URL, date). A URL with any share of the records may take many sorted parts: windows stay
inside a part, and one row for each part tells the next ones which response is still the latest.

Defined cases: a revisit without an earlier full response has verdict ``no response``; one without comparable validators ``unchecked`` and one whose
validators differ ``changed``, and both keep their own headers; null or empty URLs are one URL; null dates come first and are never after anything; at equal
dates a response is not earlier; of two responses at one date the larger record_id is the later; repeated rows are records of their own; header names that differ
in case only are one header with a list of values; null headers are none; other columns are not read; an empty table gives an empty table; urls and values of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpub.llm.common import sorted_table, stored

#: Headers that describe the stored body or the connection, which a 304 does not change.
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Fixed value: query parameters that do not choose a page.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without a closing slash, sorted query without tracking, no scheme, no fragment."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"#.*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(F.lit("")))


def lower_names(headers: Column) -> Column:
    """Headers by lower-case name. Values of names that differ in case only are one list, as repeated headers are: joined in the order of the names, equal ones once."""
    lower = F.transform(F.map_keys(headers), F.lower)
    entries = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["name"]))
    values = lambda n: F.array_compact(F.array_distinct(F.transform(F.filter(entries, lambda e: e["name"] == n), lambda e: e["value"])))
    combined = F.map_from_arrays(names, F.transform(names, lambda n: F.when(F.size(values(n)) > 0, F.array_join(values(n), ", "))))
    # Mostly no two names are alike in lower case.
    return F.when(F.size(F.array_distinct(lower)) == F.size(lower), F.map_from_arrays(lower, F.map_values(headers))).otherwise(combined)


def resolved(records: DataFrame) -> DataFrame:
    """Revisits of ``records(record_id, warc_type, url, date, status, headers, payload_digest)``, each with its verdict and what it stands for.

    Returns record_id, url_key, date, verdict, response_id, response_date, status, payload_digest, headers.
    """
    lower = lower_names(F.coalesce("headers", F.create_map().cast("map<string,string>")))
    full = F.coalesce((F.col("warc_type") == "response") & (F.col("status") == 200), F.lit(False))
    rows = records.where(F.col("warc_type").isin("response", "revisit")).select("record_id", "warc_type", canonical_url(F.col("url")).alias("url_key"), "date", "status", lower.alias("headers"), "payload_digest")
    # At one date, revisits come before responses.
    rows = sorted_table(stored(rows.withColumn("is_full", full), "crawl"), ["url_key", "date", "is_full", "record_id"], "records")
    response = F.struct("url_key", F.col("record_id").alias("id"), F.col("date").alias("at_date"), "status", "payload_digest", "headers")
    before = Window.partitionBy("part", "url_key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.last(F.when(F.col("is_full"), response), ignorenulls=True).over(before)).where("warc_type = 'revisit'")

    parts = rows.groupBy("part").agg(F.min_by("url_key", "at").alias("first_key"), F.max_by(response, F.when(F.col("is_full"), F.col("at"))).alias("latest"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Sorted by URL, so the latest response of all earlier parts is the right one or of another URL. A row for each shuffle partition.
    parts = parts.select(F.col("part").alias("of_part"), "first_key", F.last("latest", ignorenulls=True).over(earlier).alias("carried")).where("carried.url_key = first_key")
    found = near.join(F.broadcast(parts), (F.col("part") == F.col("of_part")) & (F.col("url_key") == F.col("first_key")), "left")
    # Responses with a null date sort first; nothing is known to be after them.
    both = F.coalesce("near", "carried")
    found = found.withColumn("response", F.when(both["at_date"] < F.col("date"), both))

    tag = lambda h: F.regexp_replace(F.trim(h["etag"]), "^W/", "")
    own, its = F.col("headers"), F.col("response.headers")
    same = F.coalesce(tag(own) == tag(its), F.trim(own["last-modified"]) == F.trim(its["last-modified"]))
    verdict = F.when(F.col("response").isNull(), "no response").when(same.isNull(), "unchecked").when(same, "resolved").otherwise("changed")
    new = F.map_filter(own, lambda k, _: ~k.isin(*NOT_UPDATED))
    merged = F.map_concat(F.map_filter(its, lambda k, _: ~F.map_contains_key(new, k)), new)
    is_resolved = F.col("verdict") == "resolved"
    return found.withColumn("verdict", verdict).select(
        "record_id",
        "url_key",
        "date",
        "verdict",
        F.col("response.id").alias("response_id"),
        F.col("response.at_date").alias("response_date"),
        F.when(is_resolved, F.col("response.status")).otherwise(F.col("status")).alias("status"),
        F.when(is_resolved, F.col("response.payload_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(is_resolved, merged).otherwise(own).alias("headers"),
    )


def header_lines(headers: Column) -> Column:
    """``name: value`` lines in the order of names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def crawl_of(pages: DataFrame) -> DataFrame:
    """A crawl's records derived from every row of ``pages``: a response and two later revisits of each.

    Dates are seconds. A page is fetched at page_id minutes and asked for again 7 and 14 days later; every fifth page's second revisit names another
    entity tag, every seventh's first has only a modification date, every eleventh's first has no validator.
    """
    page, tag = F.col("page_id"), F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    modified = F.concat(F.lit("day "), F.floor(page / 1440).cast("string"))
    response = F.struct(
        (page * 3).alias("record_id"), F.lit("response").alias("warc_type"), (page * 60).alias("date"), F.lit(200).alias("status"), F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("payload_digest"),
        F.create_map(F.lit("ETag"), tag, F.lit("Last-Modified"), modified, F.lit("Content-Type"), F.lit("text/html"), F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"),
    )
    none = F.lit(None).cast("string")
    first = F.when(page % 11 == 0, F.create_map(F.lit("Date"), F.lit("first"))).when(page % 7 == 0, F.create_map(F.lit("Last-Modified"), modified, F.lit("Date"), F.lit("first"))).otherwise(F.create_map(F.lit("ETag"), F.concat(F.lit("W/"), tag), F.lit("Cache-Control"), F.lit("max-age=120"), F.lit("Content-Length"), F.lit("0")))
    second = F.create_map(F.lit("ETag"), F.when(page % 5 == 0, F.lit('"other"')).otherwise(tag), F.lit("Date"), F.lit("second"))
    revisit = lambda k, h: F.struct((page * 3 + k).alias("record_id"), F.lit("revisit").alias("warc_type"), (page * 60 + k * 604800).alias("date"), F.lit(304).alias("status"), none.alias("payload_digest"), h.alias("headers"))
    return pages.select("url", F.explode(F.array(response, revisit(1, first), revisit(2, second))).alias("r")).select("url", "r.*")
