"""Exact dedup by deterministic block naming.

The normalised text is cut into blocks of a fixed length. All blocks are sorted, and equal blocks get one
integer name: the place of the first of them in the sorted order (by a hash, then by the block itself). Then adjacent pairs of names are named the
same way, again and again, until one name is left of each document. Two documents have one identity
(number of blocks, name) exactly if all their blocks are equal, so nothing rests on hashes.

Ties are sorted by (row, position), so copies of a block, however many, are spread over several
sorted parts; a few rows for each part say which blocks go on from one part to the next.

Defined cases: null text counts as empty; all empty texts are equal; repeated rows are members of their
group and exactly one of them is kept; null doc_ids sort last among ties; very long texts are many blocks; an empty table gives an
empty table; other columns are not read, and ``drop_copies`` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellpub.llm.common import SPACE, content_key, hot_join, only_kept, partitions, stored, text_or_empty

#: Code points in a block.
BLOCK = 2048


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, content_key, keep_id, group_size, kept, text_sha256 of every row of ``docs``."""
    text = text_or_empty(text_col)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        content_key(F.col(text_col)).alias("content_key"),
        F.length(text).cast("long").alias("n_points"),
        F.regexp_replace(text, f"{SPACE}+", "").alias("norm"),
    )
    rows = rows.withColumns({"text_sha256": F.sha2(F.encode("norm", "UTF-8"), 256), "blocks": F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))})
    head = F.struct("doc_id", "content_key", "n_points", "text_sha256")
    blocks = rows.withColumn("n_blocks", F.size("blocks")).select("row", "n_blocks", F.posexplode_outer("blocks").alias("pos", "block"), head.alias("head"))
    # The head goes with the first block only.
    blocks = blocks.select("row", F.coalesce("pos", F.lit(0)).alias("pos"), "n_blocks", F.coalesce("block", F.lit("")).alias("block"), F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("head")).alias("head"))

    level = _named(blocks, ["block"], "blocks")
    done = level.where("pos = 0").select("row", "n_blocks", "head", F.when(F.col("n_blocks") <= 1, F.col("name")).alias("name"))
    level, longest = level.select("row", "pos", "n_blocks", "name"), level.agg(F.max("n_blocks")).first()[0] or 0
    names = []
    width = 1
    while width < longest:
        # Documents of one name are through; of the others, names pair up.
        pairs = level.where(F.col("n_blocks") > width)
        half = (F.col("pos") / 2).cast("int")
        side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = pairs.groupBy("row", "n_blocks", half.alias("pos")).agg(side(0).alias("left"), F.coalesce(side(1), F.lit(-1)).alias("right"))
        level = _named(pairs, ["left", "right"], "pairs").select("row", "pos", "n_blocks", "name")
        width *= 2
        names.append(level.where(F.col("n_blocks") <= width).select("row", "name"))
    if names:
        later = names[0]
        for one in names[1:]:
            later = later.unionByName(one)
        done = done.join(later.withColumnRenamed("name", "later"), "row", "left").withColumn("name", F.coalesce("name", "later"))
    done = stored(done.select("row", "n_blocks", "name", "head.*"), "identities")

    best = F.min(F.struct((-F.col("n_points")).alias("points"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = done.groupBy("n_blocks", "name").agg(F.count("*").alias("group_size"), best.alias("best"))
    # Only groups of several rows are looked up; the rows of a large group stay where they are.
    groups = groups.where("group_size > 1").select("n_blocks", "name", "group_size", F.col("group_size").alias("group_rows"), F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    return hot_join(done, stored(groups, "groups"), ["n_blocks", "name"], "left").select(
        "doc_id",
        "content_key",
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns stay."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select("doc_id", "content_key")
    return only_kept(docs, kept, id_col, text_col)


def _named(rows: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``rows`` with ``name`` in place of ``keys``: equal keys have equal names, others not. The result is stored.

    Rows are sorted by (hash of the keys, keys, row, pos) and dealt to sorted parts by (hash, row, pos), so bounds between parts
    are short, and copies of a key may take many parts. A key that goes over such a bound has the first or the
    last hash of its part; such keys (mostly two a part) are written beside the rows, whole, and agree on their least name.
    """
    n = partitions(rows.sparkSession)
    carried = [T.StructField(f.name, f.dataType) for f in rows.schema.fields if f.name not in keys]
    ends = [T.StructField(f"end_{f.name}", f.dataType) for f in rows.schema.fields if f.name in keys]
    schema = T.StructType([*carried, T.StructField("name", T.LongType()), T.StructField("part", T.IntegerType()), *ends])
    ordered = rows.withColumn("hash", F.xxhash64(*keys)).repartitionByRange(n, "hash", "row", "pos").sortWithinPartitions("hash", *keys, "row", "pos")
    ordered = ordered.withColumn("part", F.spark_partition_id())
    named = stored(ordered.mapInArrow(_name_runs(keys, [f.name for f in carried]), schema), what)

    cut = named.where("row is null").groupBy(*[f.name for f in ends]).agg(F.min("name").alias("least"), F.collect_set("name").alias("names"))
    # A name for each part that the key is in: at most a row or two for each shuffle partition, so it is broadcast.
    cut = cut.where(F.size("names") > 1).select("least", F.explode("names").alias("name")).where("name <> least")
    rows = named.where("row is not null").join(F.broadcast(cut), "name", "left")
    return stored(rows.select(*[f.name for f in carried], F.coalesce("least", "name").alias("name")), f"{what}-named")


def _name_runs(keys: list[str], carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place, name, part = None, 0, 0, 0
        first_hash = last_hash = None
        first: dict[tuple, int] = {}
        tail: dict[tuple, int] = {}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            part = batch.column("part")[0].as_py()
            change = np.zeros(n, dtype=bool)
            change[0] = last != [batch.column(k)[0].as_py() for k in keys]
            for k in keys:
                column = batch.column(k)
                change[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            places = (np.int64(part) << 33) + place + np.arange(n, dtype=np.int64)
            start = np.maximum.accumulate(np.where(change, np.arange(n), -1))
            names = np.where(start >= 0, places[np.maximum(start, 0)], name)
            hashes = batch.column("hash").to_numpy()
            first_hash = int(hashes[0]) if first_hash is None else first_hash
            # The runs of the part's first hash, and those of the last hash so far.
            if int(hashes[-1]) != last_hash:
                last_hash, tail = int(hashes[-1]), {}
            for wanted, into in ((first_hash, first), (last_hash, tail)):
                for i in np.flatnonzero(change & (hashes == wanted)).tolist():
                    into[tuple(batch.column(k)[i].as_py() for k in keys)] = int(names[i])
            name, place = int(names[-1]), place + n
            last = [batch.column(k)[n - 1].as_py() for k in keys]
            nulls = {f"end_{k}": pa.nulls(n, batch.schema.field(k).type) for k in keys}
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in carried} | {"name": pa.array(names), "part": pa.array(np.full(n, part, dtype=np.int32))} | nulls)
        if ends := first | tail:
            n = len(ends)
            columns = {c: pa.nulls(n, batch.schema.field(c).type) for c in carried} | {"name": pa.array(list(ends.values()), pa.int64()), "part": pa.array([part] * n, pa.int32())}
            yield pa.RecordBatch.from_pydict(columns | {f"end_{k}": pa.array([e[i] for e in ends], batch.schema.field(k).type) for i, k in enumerate(keys)})

    return run
