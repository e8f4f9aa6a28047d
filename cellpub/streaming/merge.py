"""A streaming entrance for deltas: each micro-batch is merged into the table, the latest treatment winning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellpub.operators.registers import latest_version
from cellpub.sources.buckets import BucketTable


def merge_stream(deltas: DataFrame, table: str, keys: list[str], treated: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Start a query that keeps the bucket table at ``table`` up to date; a batch rewrites only the buckets that it has keys in.

    A version names the batch that made it, so one that is run again after a failure counts once. Readers of the version before finish undisturbed.
    """

    def merge(batch: DataFrame, n: int) -> None:
        newest = latest_version(batch, keys, [F.desc(treated), *[F.col(c) for c in batch.columns if c != treated]])
        found = BucketTable(batch.sparkSession, table)
        if not found.exists():
            BucketTable.create(newest, table, keys, buckets, batch=n)
        elif found.info().get("batch", -1) < n:
            found.merge(newest, batch=n)

    return deltas.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, window: str, lateness: str, *keys: str) -> DataFrame:
    """Event counts by tumbling window and key; state is dropped once the watermark passes a window."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, window).alias("window"), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")
