"""Reading sources: fixed schemas, pruned slices, related rows, deltas, surveys, and what need not be read again."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellpub.functions.scalars import month_label
from cellpub.sources.versions import exists, replace


def scan_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def scan_union_by_name(spark: SparkSession, *paths: str) -> DataFrame:
    """Files of several periods, columns matched by name; a column that a file lacks is null there."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def extract_slice(table: DataFrame, columns: list[str], area: str, prefixes: list[str]) -> DataFrame:
    """Some columns of the rows whose area begins with one of the prefixes; both reach the scan."""
    return table.where(reduce(lambda a, b: a | b, [F.col(area).startswith(p) for p in prefixes])).select(*columns)


def extract_related(table: DataFrame, extract: DataFrame, key: str) -> DataFrame:
    """Rows of a large table whose key is in an extract. The keys grow with it, so no side is forced to be broadcast."""
    return table.join(extract.select(key).distinct(), key, "left_semi")


def non_empty(df: DataFrame, path: str, what: str) -> int:
    """Write an extract as the table's next version and return its rows, counted on the way; none is an error, and the last good extract stays."""
    seen = Observation(what)

    def check() -> None:
        if not seen.get["rows"]:
            raise ValueError(f"{what}: no rows")

    replace(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, check)
    return seen.get["rows"]


def write_clustered(df: DataFrame, path: str, area: str, row_group_bytes: int = 16 << 20) -> None:
    """Store a register sorted by area over all files, so that a prefix of the area reads few files and row groups."""
    df.repartitionByRange(area).sortWithinPartitions(area).write.option("parquet.block.size", row_group_bytes).parquet(path)


def write_by_month(df: DataFrame, path: str, day: str) -> None:
    """Store an extract by month; months that it has replace those that are there."""
    rows = df.withColumn("month", month_label(F.trunc(day, "month"))).repartition("month")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def read_months(spark: SparkSession, path: str, months: DataFrame, first: str) -> DataFrame:
    """Rows of an extract by month for the months of a table (a few rows), none before ``first``; the folders of other months are pruned when the query runs."""
    return spark.read.parquet(path).withColumn("month", F.col("month").cast("string")).join(F.broadcast(months.select("month").where(F.col("month") >= first)), "month")


def stage(table: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Rename and type: output name to expression."""
    return table.select(*[c.alias(name) for name, c in columns.items()])


def months_to_read(spark: SparkSession, start: dt.date, today: dt.date, manifest: DataFrame, margin: int = 3, force: bool = False) -> DataFrame:
    """Months from ``start`` to today's, less those of ``manifest(month, extracted_at)`` extracted ``margin`` days or more after their end."""
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(start), "month"), F.trunc(F.lit(today), "month"), F.expr("interval 1 month"))).alias("first_day"))
    months = months.select(month_label(F.col("first_day")).alias("month"))
    if force:
        return months
    end = F.last_day(F.to_date(F.concat("month", F.lit("-01"))))
    closed = manifest.where(F.col("extracted_at") >= F.date_add(end, margin)).select("month")
    return months.join(closed, "month", "left_anti")


def sources_to_read(sources: DataFrame, manifest: DataFrame, files: dict[str, str] | None = None) -> DataFrame:
    """Sources whose version or filter differs from the manifest's, or whose extract (``files``: source to path, a few) is not there any more."""
    if files is not None:
        there = [name for name, path in files.items() if exists(sources.sparkSession, path)]
        manifest = manifest.where(F.col("source").isin(*there)) if there else manifest.limit(0)
    return sources.join(manifest, ["source", "version", "filter"], "left_anti")


def header_columns(columns: list[str], wanted: dict[str, str]) -> dict[str, str]:
    """Wanted name to column, by patterns on lower-case headers without signs; a column that is missing is an error."""
    plain = {c: re.sub(r"[^a-z0-9]", "", c.lower()) for c in columns}
    found = {name: [c for c, p in plain.items() if re.fullmatch(pattern, p)] for name, pattern in wanted.items()}
    if missing := [name for name, cs in found.items() if not cs]:
        raise ValueError(f"no column for {', '.join(missing)} in {', '.join(columns)}")
    return {name: cs[0] for name, cs in found.items()}


def load_survey(table: DataFrame, wanted: dict[str, str], counts: list[str], codes: list[str] = (), secret_of: str | None = None) -> DataFrame:
    """Columns by header whatever their order; ``*`` and blanks are masked (null) counts, and ``secret`` marks rows whose ``secret_of`` is; numeric codes become text."""
    found = header_columns(table.columns, wanted)
    raw = lambda name: F.nullif(F.trim(F.col(f"`{found[name]}`").cast("string")), F.lit(""))
    number = lambda name: F.when(raw(name) != "*", raw(name)).try_cast("double").cast("int")
    columns = [number(n).alias(n) if n in counts else F.regexp_replace(raw(n), r"\.0$", "").alias(n) if n in codes else raw(n).alias(n) for n in wanted]
    return table.select(*columns, *([F.coalesce(raw(secret_of) == "*", F.lit(False)).alias("secret")] if secret_of else []))


def load_zoning(table: DataFrame, wanted: dict[str, str], area: str, vintage: int, width: int = 5) -> DataFrame:
    """Area to basin; area codes that lost their leading zeros get them back."""
    found = header_columns(table.columns, wanted)
    text = lambda n: F.trim(F.col(f"`{found[n]}`").cast("string"))
    return table.select(*[(F.lpad(text(n), width, "0") if n == area else text(n)).alias(n) for n in wanted], F.lit(vintage).alias("vintage"))


def load_hierarchy(table: DataFrame, levels: list[str]) -> DataFrame:
    if missing := [c for c in levels if c not in table.columns]:
        raise ValueError(f"no column {', '.join(missing)}")
    return table.select(*levels).distinct()


def restrict_perimeter(areas: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The wanted areas; one that the parent does not have is an error."""
    if absent := [r[0] for r in wanted.join(areas, key, "left_anti").select(key).limit(5).collect()]:
        raise ValueError(f"not in the parent area: {absent}")
    return areas.join(wanted, key, "left_semi")


def delta_since(base: DataFrame, delta: DataFrame, treated: str, created: str, start: dt.date) -> DataFrame:
    """Rows of the delta treated since the base's last treatment and created in the window. The watermark is one value."""
    last = base.agg(F.max(treated)).first()[0]
    return delta.where((F.col(created) >= F.lit(start)) & (F.lit(True) if last is None else F.col(treated) >= F.lit(last)))


def empty_supplement(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([], like.schema)


def flatten_area(areas: DataFrame) -> DataFrame:
    """Nested area records to columns; postal codes sorted, a missing list empty."""
    codes = F.sort_array(F.coalesce(F.col("area.postal_codes"), F.array().cast("array<string>")))
    return areas.select(F.col("area.code").alias("code"), F.col("area.name").alias("name"), F.col("area.parent.code").alias("parent"), F.col("area.population").cast("int").alias("population"), codes.alias("postal_codes"))
