"""The test tables, read by column, and the mapping of orders onto the register model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Schemas by path, time of change and length: finding one is a job, and a chain reads some tables many times.
_SCHEMAS: dict[tuple[str, int, int], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
    version = (path, status.getModificationTime(), status.getLen())
    if version not in _SCHEMAS:
        _SCHEMAS[version] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[version]).parquet(path)


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as register events: area = nation, section = segment, division = segment/priority.

    The customer side grows with the data, so the join is left to the optimizer and shuffles on the key.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    return orders.join(customers, "o_custkey").select(
        "o_orderkey",
        F.trunc(F.to_date("o_orderdate"), "month").alias("month"),
        F.col("c_nationkey").cast("string").alias("area"),
        F.col("c_mktsegment").alias("section"),
        F.concat_ws("/", "c_mktsegment", "o_orderpriority").alias("division"),
        F.col("o_orderstatus").alias("detail"),
    )
