"""Hard negatives by slots of scores.

1. Valid rows are packed into blocks: integer components, ids, labels and which rows are anchors. A block has at most ``BLOCK`` rows.
2. Chunks of anchors meet groups of blocks, each pair in a task of its own. The first meeting finds each anchor's positives: the first rows of its label.
3. The positives' scores are upper limits that split an anchor's scores into disjoint slots: slot j holds the scores of at most the j-th and above the
   (j+1)-th limit. The second meeting keeps the first k rows of other labels in each slot, and the groups' rows are cut to k a slot again.
4. Slots follow each other in descending scores, so what is at most the j-th limit are slots j, j+1, ...: appending each slot before the merged later ones
   answers all overlapping windows from the same few rows. The lower limit cuts what is left.

Order is by score, higher first, then by smaller id. Scores are exact integers; scores that do not fit a long are an error.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; missing components of shorter vectors are 0; repeated
rows are rows of their own (each is an anchor of its own, and another's other row); an anchor without positives, and a positive without a row in its window, gives no row; a
negative positive score has an empty window; an empty table gives an empty table; of other columns, none is read; vectors of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpub.llm.common import partitions, stored

#: Rows and components of a block, rows of a group and anchors of a chunk at most; scores of a matrix.
BLOCK, COMPONENTS, GROUP, CHUNK, SCORES = 2048, 1 << 20, 131_072, 16_384, 1 << 21

BLOCKS = "n int, dim int, kind string, ids binary, labels binary, anchors binary, vectors binary"
KEPT = "block long, at int, slot int, score long, other long"


def _packed(scale: float) -> callable:
    """Batches of (id, label, vector, anchor) to blocks."""

    def block(parts: list[tuple]) -> pa.RecordBatch:
        ids, labels, anchors = (np.concatenate([p[i] for p in parts]) for i in range(3))
        dim = max(p[3].shape[1] for p in parts)
        vectors = np.concatenate([np.pad(p[3], ((0, 0), (0, dim - p[3].shape[1]))) for p in parts])
        most = float(np.abs(vectors).max(initial=0))
        if most >= 2.0**62:
            raise ValueError(f"components of {most} give scores that do not fit a long")
        kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
        columns = [[len(ids)], [dim], [kind], [ids.astype("<i8").tobytes()], [labels.astype("<i8").tobytes()], [anchors.astype("?").tobytes()], [vectors.astype(kind).tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 4))], names=["n", "dim", "kind", "ids", "labels", "anchors", "vectors"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, cells = [], 0, 0
        for batch in batches:
            vector = batch.column("vector")
            values = vector.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
            lengths = np.asarray(vector.value_lengths().fill_null(0), dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            finite = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = np.flatnonzero(finite[starts[1:]] == finite[starts[:-1]])
            ids, labels, anchors = (np.asarray(batch.column(c)) for c in ("id", "label", "anchor"))
            for dim in np.unique(lengths[good]):
                own = good[lengths[good] == dim]
                step = max(1, min(BLOCK, COMPONENTS // max(1, int(dim))))
                for k in range(0, len(own), step):
                    some = own[k : k + step]
                    matrix = np.floor(scale * values[(starts[some][:, None] + np.arange(dim)).ravel()]).reshape(len(some), dim)
                    if parts and (rows + len(some) > BLOCK or cells + matrix.size > COMPONENTS):
                        yield block(parts)
                        parts, rows, cells = [], 0, 0
                    parts.append((ids[some], labels[some], anchors[some], matrix))
                    rows, cells = rows + len(some), cells + matrix.size
        if parts:
            yield block(parts)

    return pack


class _Rows:
    """The rows of some blocks, in ascending order of id; ``place`` finds a row by its block and its place there."""

    def __init__(self, table: pa.Table) -> None:
        rows = table.to_pylist()
        offsets, total, self.dim = {}, 0, max(r["dim"] for r in rows)
        for r in rows:
            offsets[r["block"]] = total
            total += r["n"]
        read = lambda c, kind: np.concatenate([np.frombuffer(r[c], kind) for r in rows])
        ids = read("ids", "<i8")
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.offsets = ids[order], read("labels", "<i8")[order], offsets
        self.inverse = np.empty(total, dtype=np.int64)
        self.inverse[order] = np.arange(total)
        vectors = np.zeros((total, self.dim), dtype=np.int64)
        for r in rows:
            vectors[offsets[r["block"]] : offsets[r["block"]] + r["n"], : r["dim"]] = np.frombuffer(r["vectors"], r["kind"]).reshape(r["n"], r["dim"])
        self.vectors = vectors[order]
        self.most = int(np.abs(self.vectors).max(initial=0))

    def place(self, block: int, at: int) -> int:
        offset = self.offsets.get(block)
        return -1 if offset is None else int(self.inverse[offset + at])

    def scores(self, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the first anchor, scores of some anchors with all rows). Sums of products below 2^53 are exact in doubles, which are quicker."""
        dim = min(self.dim, anchors.shape[1])
        bound = dim * self.most * int(np.abs(anchors).max(initial=0))
        if bound >= 2**63:
            raise ValueError("scores do not fit a long")
        kind = np.float64 if bound < 2**53 else np.int64
        right = self.vectors[:, :dim].T.astype(kind)
        step = max(1, SCORES // max(1, len(self.ids)))
        for k in range(0, len(anchors), step):
            yield k, (anchors[k : k + step, :dim].astype(kind) @ right).astype(np.int64)


def _first(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties by place."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.argsort(-scores[near], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")


def _meeting(find: callable) -> callable:
    """A function of a group's blocks and a chunk's anchors that gives what ``find(rows, anchor, its scores)`` keeps: (slot, places)."""

    def meet(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if blocks.num_rows and anchors.num_rows:
            rows, own = _Rows(blocks), anchors.to_pylist()
            vectors = np.zeros((len(own), max(a["dim"] for a in own)), dtype=np.int64)
            for i, a in enumerate(own):
                vectors[i, : a["dim"]] = np.frombuffer(a["vector"], a["kind"])
            for k, scores in rows.scores(vectors):
                for a, s in zip(own[k : k + len(scores)], scores):
                    for slot, places in find(rows, a, s):
                        found += [(a["block"], a["at"], slot, s[p], rows.ids[p]) for p in places]
        columns = list(zip(*found)) or [[]] * 5
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "at", "slot", "score", "other"])

    return meet


def _same_label(k: int) -> callable:
    def find(rows: _Rows, anchor: dict, scores: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        same = rows.labels == anchor["label"]
        if (own := rows.place(anchor["block"], anchor["at"])) >= 0:
            same[own] = False
        same = np.flatnonzero(same)
        yield 0, same[_first(scores[same], k)]

    return find


def _by_slots(k: int, low: int, high: int) -> callable:
    def find(rows: _Rows, anchor: dict, scores: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        wanted = [p for p in anchor["limits"] if p >= 0]
        if not wanted:
            return
        # Nothing below the lowest window is in any window.
        limits, least = np.array([p * high // 100 for p in wanted]), -(-low * wanted[-1] // 100)
        near = np.flatnonzero((scores >= least) & (scores <= limits[0]) & (rows.labels != anchor["label"]))
        slots = np.searchsorted(-limits, -scores[near], side="right")
        for slot in np.unique(slots):
            inside = near[slots == slot]
            yield int(slot), inside[_first(scores[inside], k)]

    return find


def hard_negatives(rows: DataFrame, id_col: str, vector: str, label: Column, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows where ``anchor`` holds.

    A negative's score is between ``low`` and ``high`` percent of the positive's. Components are floor(scale * x).
    """
    spark = rows.sparkSession
    usable = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    packed = usable.where("id is not null and label is not null and vector is not null").mapInArrow(_packed(scale), BLOCKS)
    blocks = stored(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    n_blocks, n_rows, n_anchors = (int(x or 0) for x in blocks.agg(F.count("*"), F.sum("n"), F.sum(F.length(F.replace(F.hex("anchors"), F.lit("0"), F.lit(""))))).first())
    # Groups as large as memory allows on large inputs; on small ones as many as there are partitions.
    groups = max(math.ceil(n_rows / GROUP), min(n_blocks, partitions(spark)), 1)
    chunks = max(math.ceil(n_anchors / CHUNK), 1)

    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ids, labels, vectors = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["labels"], "<i8"), np.frombuffer(r["vectors"], r["kind"]).reshape(r["n"], r["dim"])
                out += [(r["block"], int(at), int(ids[at]), int(labels[at]), r["dim"], r["kind"], vectors[at].tobytes()) for at in np.flatnonzero(np.frombuffer(r["anchors"], "?"))]
            columns = list(zip(*out)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "at", "anchor_id", "label", "dim", "kind", "vector"])

    anchors = blocks.mapInArrow(anchors_of, "block long, at int, anchor_id long, label long, dim int, kind string, vector binary")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = blocks.drop("anchors").withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")).withColumn("chunk", every(chunks))
    chunk = F.pmod(F.xxhash64("block", "at"), F.lit(chunks)).cast("int").alias("chunk")

    def met(asking: DataFrame, find: callable, most: int) -> DataFrame:
        asking = asking.select("*", chunk).withColumn("group", every(groups))
        kept = dealt.groupBy("chunk", "group").cogroup(asking.groupBy("chunk", "group")).applyInArrow(_meeting(find), KEPT)
        rank = F.row_number().over(Window.partitionBy("block", "at", "slot").orderBy(F.desc("score"), "other"))
        return kept.withColumn("rank", rank).where(F.col("rank") <= most)

    order = lambda *more: F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "other", *more)))
    found = met(anchors, _same_label(positives), positives).groupBy("block", "at").agg(order().alias("positives"))
    found = stored(anchors.join(found, ["block", "at"]), "positives")  # at most a few numbers an anchor
    asking = found.select("block", "at", "label", "dim", "kind", "vector", F.transform("positives", lambda p: -p["minus"]).alias("limits"))
    slots = met(asking, _by_slots(negatives, low, high), negatives).groupBy("block", "at").agg(order("slot").alias("kept"))
    # Slots count the limits of at least a score, so those from j on hold what is at most the j-th limit, in order.
    windows = found.select("block", "at", "anchor_id", F.posexplode("positives").alias("j", "p")).join(slots, ["block", "at"])
    score = -F.col("p.minus")
    wide = lambda c: c.cast("decimal(20,0)")  # noqa: E731  a hundred times a long
    inside = F.slice(F.filter("kept", lambda c: (c["slot"] > F.col("j")) & (wide(c["minus"]) * -100 >= wide(score) * low)), 1, negatives)
    rows = windows.where("p.minus <= 0").select("anchor_id", F.col("p.other").alias("positive_id"), score.alias("positive_score"), F.posexplode(inside).alias("at", "c"))
    return rows.select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("c.other").alias("negative_id"), "positive_score", (-F.col("c.minus")).alias("negative_score"))
