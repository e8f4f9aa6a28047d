"""Writing: typed tables, CSV and JSON, snapshot history, run log, publication of several tables at once."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellpub.sources.versions import Conflict, commit, current, delete, replace

LOG = "run string, source string, status string, rows long, error string, started timestamp, ended timestamp, details map<string,string>"


def write_typed(df: DataFrame, path: str, schema: str) -> int:
    """Write with exactly these columns and types (a column that does not cast is an error) as the table's next version; return the rows, counted on the way. Empty tables keep their schema.

    Readers (``versions.read_table``) have the old version until the new one is whole; a write that fails leaves it as it was, and of two writers at once one gets ``versions.Conflict``.
    """
    wanted = df.sparkSession.createDataFrame([], schema).schema
    seen = Observation(f"write-{uuid.uuid4().hex}")
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
    replace(typed.observe(seen, F.count(F.lit(1)).alias("rows")), path, compression="zstd")
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, columns: list[str], order: list[str] = ()) -> None:
    rows = df.select(*columns)
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def snapshot(df: DataFrame, path: str, run_date: dt.date) -> None:
    """Add a day's snapshot; a day that is run again replaces that day only."""
    df.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def logged(spark: SparkSession, path: str, source: str, work: Callable[[], int], **details: str) -> int:
    """Run ``work`` (it returns its rows) and append one entry to the run log, whether it succeeds or fails."""
    started, rows, error = dt.datetime.now(), None, None
    try:
        rows = work()
        return rows
    except Exception as e:
        error = str(e)[:500]
        raise
    finally:
        entry = [(uuid.uuid4().hex, source, "failed" if error else "ok", rows, error, started, dt.datetime.now(), details)]
        spark.createDataFrame(entry, LOG).coalesce(1).write.mode("append").parquet(path)


def publish_together(tables: dict[str, DataFrame], root: str, run: str) -> int:
    """Write all tables below a run's own folder, and only then the version that makes them current: all of them or none. Other tables stay as they are."""
    spark = next(iter(tables.values())).sparkSession
    seen, content = current(spark, root)
    try:
        for name, df in tables.items():
            df.write.mode("errorifexists").parquet(f"{root}/{run}/{name}")
        return commit(spark, root, seen, {"run": run, "tables": content.get("tables", {}) | {name: f"{run}/{name}" for name in tables}})
    except Conflict:
        delete(spark, f"{root}/{run}")
        raise


def published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as it was last published whole."""
    return spark.read.parquet(f"{root}/{current(spark, root)[1]['tables'][table]}")


def last_entries(log: DataFrame, n: int = 60) -> DataFrame:
    return log.orderBy(F.desc("ended"), "run").limit(n)


def publication_meta(sources: DataFrame, log: DataFrame, months: DataFrame, notices: DataFrame, published: str) -> DataFrame:
    """source, vintage, extracted, first_period, last_period, last_published: what a reader has to know about each source.

    ``sources(source, vintage)``: the version in use; ``log``: run entries, of which the last success of each source tells when it was extracted (null if there is none);
    ``months(period)``: the published months; ``notices``: their last date of publication is one for all. A row for each source.
    """
    ok = log.where("status = 'ok'").groupBy("source").agg(F.to_date(F.max("ended")).alias("extracted"))
    bounds = months.agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"))
    last = notices.agg(F.max(published).alias("last_published"))
    return sources.select("source", "vintage").join(ok, "source", "left").crossJoin(F.broadcast(bounds)).crossJoin(F.broadcast(last))
