"""Tables in the folder that driver and executors share: they cut lineage and outlive executors. And small tables of fixed rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one is made only where none is set and all runs in one process, as in tests. On a cluster executors would not share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "local").startswith("local[") and spark.conf.get("spark.master", "local") != "local":
            raise ValueError("spark.checkpoint.dir is not set: it names the folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Folders of the tables that the work at hand has stored; each ``collecting`` has a list of its own.
_KEPT: ContextVar[list[str] | None] = ContextVar("kept", default=None)


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The folders of all tables stored inside, for ``release`` when they are read no more."""
    paths: list[str] = []
    token = _KEPT.set(paths)
    try:
        yield paths
    finally:
        _KEPT.reset(token)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables. Nothing that still reads them may be computed afterwards."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        where = hadoop.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def own_folder(spark: SparkSession, name: str) -> str:
    """A folder of this call alone, so that no other overwrites what is still to be read."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _KEPT.get()) is not None:
        paths.append(path)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there and lost executors cost nothing."""
    path = own_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``kept``, and the number of rows, counted as they are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = kept(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return out, seen.get["rows"]


def fixed_rows(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """Rows known beforehand as a local relation. The planner knows its size, so it is broadcast; made from a list, it would be an RDD of unknown size that is shuffled."""
    types = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    arrow = to_arrow_schema(types)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), types)
