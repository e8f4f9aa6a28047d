"""A table laid out in buckets by a hash of its key, so a delta rewrites only the buckets that it has keys in.

    <root>/data-<id>/bucket=<b>/   rows of a bucket, of one write
    <root>/_versions/<number>      keys, number of buckets, schema, the folder of each bucket (see ``versions``)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellpub.operators.registers import merge_latest_wins
from cellpub.sources.shared import kept
from cellpub.sources.versions import commit, current, delete, forget

BUCKET = "__bucket"


def _folders(content: dict) -> list[str]:
    return list(content["buckets"].values())


class BucketTable:
    """The table at ``root``. Buckets are as many as make each some hundred megabytes; keys should be nearly unique, as all rows of a bucket are written by one task."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    @classmethod
    def create(cls, df: DataFrame, root: str, keys: list[str], buckets: int, **more: object) -> BucketTable:
        table = cls(df.sparkSession, root)
        content = {"keys": keys, "n": buckets, "schema": json.loads(df.schema.json()), "buckets": {}}
        table._write(0, content, table._dealt(df, content), more)
        return table

    def exists(self) -> bool:
        return current(self.spark, self.root)[0] > 0

    def info(self) -> dict:
        return current(self.spark, self.root)[1]

    def read(self) -> DataFrame:
        content = self.info()
        return self._read(content, content["buckets"])

    def _read(self, content: dict, buckets: dict[str, str]) -> DataFrame:
        schema = T.StructType.fromJson(content["schema"])
        paths = [f"{self.root}/{folder}" for folder in buckets.values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _dealt(self, df: DataFrame, content: dict) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*content["keys"]), F.lit(content["n"])).cast("int"))

    def _write(self, seen: int, content: dict, rows: DataFrame, more: dict) -> int:
        folder = f"data-{uuid.uuid4().hex}"
        try:
            rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
            written = self.spark.read.parquet(f"{self.root}/{folder}").select(BUCKET).distinct().collect() if rows.columns else []
            buckets = content["buckets"] | {str(b): f"{folder}/{BUCKET}={b}" for (b,) in written}
            number = commit(self.spark, self.root, seen, content | more | {"buckets": buckets})
        except BaseException:
            delete(self.spark, f"{self.root}/{folder}")
            raise
        forget(self.spark, self.root, _folders)
        return number

    def merge(self, delta: DataFrame, **more: object) -> int:
        """Rows of ``delta`` (at most one a key) replace those of their key; columns are matched by name. Returns the new version, or raises ``Conflict`` if another writer came first.

        The driver gets the numbers of the buckets that the delta has keys in.
        """
        seen, content = current(self.spark, self.root)
        delta = kept(self._dealt(delta, content), "delta")
        touched = {str(b) for (b,) in delta.select(BUCKET).distinct().collect()}
        if not touched:
            return commit(self.spark, self.root, seen, content | more)
        base = self._read(content, {b: f for b, f in content["buckets"].items() if b in touched})
        merged = merge_latest_wins(self._dealt(base, content), delta, [BUCKET, *content["keys"]])
        schema = json.loads(merged.drop(BUCKET).schema.json())
        return self._write(seen, content | {"schema": schema}, merged, more)
