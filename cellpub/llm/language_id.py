"""Language identification by prediction by partial matching (PPM) over bytes.

Learning: the byte sequences of ``ORDER`` + 1 bytes in all training texts are counted by language in partial counts, and shorter ones follow from them. They make a
context tree for each language: a context of k bytes has the bytes seen after it, with their counts. A tree is frozen once it is counted.

Scoring: a byte is coded in the longest context that the tree has. A context with n bytes, t different ones, gives a seen byte the probability count / (n + t) and
the escape t / (n + t); after an escape the next shorter context codes the byte, without the bytes that the longer one has seen; past the empty context,
the bytes never seen are equally likely. Probabilities of the 256 bytes sum to 1 in every context, so sums of -log2 are code lengths. A text's language is
that of the shortest code, ties the smaller name, and its score the share of that language if all were equally likely before: 2^-length / sum of 2^-length.

Code lengths are added as integers (2^-20 bits), so they depend neither on batches nor on partitions. All languages' lengths of a frequent sequence are in one table;
other sequences walk the trees.

Texts begin after ``ORDER`` line ends. Defined cases: null texts and texts without a letter are ``und`` with score 0, whatever they hold else; rows with a null language or text
are not learnt from; without any row to learn from, every text is ``und``; repeated rows are learnt from each time and get equal results; very long texts are read whole, in slices;
an empty table gives an empty table; of other columns, none is read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpub.llm.common import stored

#: Bytes of the longest context; nodes of all trees; cells of the table of frequent sequences; bytes of a slice; sequences that a task counts before it adds them up.
ORDER, NODES, CELLS, SLICE, HELD = 3, 2_000_000, 16_000_000, 1 << 20, 1 << 22
UNIT, BEGIN = float(1 << 20), 10
NO_LANGUAGE = "und"


def sequences(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each byte, the ``ORDER`` bytes before it in its text and itself, as a number. ``starts``: where texts begin, the first at 0."""
    now = data.astype(np.uint32)
    out = now.copy()
    for back in range(1, ORDER + 1):
        before = np.full(len(now), BEGIN, dtype=np.uint32)
        before[back:] = now[:-back]
        for k in range(back):  # bytes less than ``back`` after the beginning
            at = starts[(starts + k) < np.append(starts[1:], len(now))] + k
            before[at] = BEGIN
        out |= before << np.uint32(8 * back)
    return out


def _slices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """About a slice at a time: rows of the column, where each one's bytes begin, and the sequences of their bytes. A long text comes in slices, each after its last bytes of context."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    sizes[np.asarray(column.is_null())] = 0
    rows = np.flatnonzero(sizes)
    k = 0
    while k < len(rows):
        last = k + max(1, int(np.searchsorted(np.cumsum(sizes[rows[k:]]), SLICE, side="right")))
        some = rows[k:last]
        if len(some) == 1:  # possibly long: by slices that overlap by the context
            begin, end = offsets[some[0]], offsets[some[0]] + sizes[some[0]]
            for at in range(begin, end, SLICE):
                lead = min(ORDER, at - begin)
                yield some, np.zeros(1, np.int64), sequences(data[at - lead : min(at + SLICE, end)], np.zeros(1, np.int64))[lead:]
        else:
            pieces = [data[offsets[r] : offsets[r] + sizes[r]] for r in some]
            starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            yield some, starts, sequences(np.concatenate(pieces), starts)
        k = last


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of sequences by language: sums of a task, given out whenever it holds many."""
    held: dict[str, list[np.ndarray]] = defaultdict(list)
    n_held = 0

    def given() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            codes = np.concatenate([p[0] for p in parts])
            order = np.argsort(codes, kind="stable")
            first = np.flatnonzero(np.diff(codes[order], prepend=-1))
            sums = np.add.reduceat(np.concatenate([p[1] for p in parts])[order], first) if len(codes) else []
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(first), pa.string()), pa.array(codes[order][first], pa.int64()), pa.array(sums, pa.int64())], names=["lang", "code", "n"])
        held.clear()

    for batch in batches:
        langs = np.asarray(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            for _, _, codes in _slices(batch.column("text").filter(pa.array(langs == lang))):
                found, n = np.unique(codes, return_counts=True)
                held[lang].append((found.astype(np.int64), n))
                n_held += len(found)
        if n_held > HELD:
            yield from given()
            n_held = 0
    yield from given()


class Tree:
    """A language's frozen context tree, as sorted sequences of each length with their counts."""

    def __init__(self, depth: np.ndarray, code: np.ndarray, n: np.ndarray) -> None:
        self.codes, self.logs, self.contexts = {}, {}, {}
        counts, totals, kinds = {}, {}, {}
        for d in range(1, ORDER + 2):
            own = depth == d
            order = np.argsort(code[own])
            self.codes[d], counts[d] = code[own][order], n[own][order].astype(np.float64)
            self.logs[d] = np.log2(counts[d])
            self.contexts[d - 1], first = np.unique(self.codes[d] >> 8, return_index=True)
            totals[d - 1] = np.add.reduceat(counts[d], first) if len(first) else np.zeros(0)
            kinds[d - 1] = np.diff(np.append(first, len(self.codes[d]))).astype(np.float64)
        # Of each context: log2 of all it shares out and the cost of its escape; and the same of the next shorter one without what this one has seen.
        self.whole, self.escape, self.rest, self.rest_escape = {}, {}, {}, {}
        for k in range(ORDER + 1):
            self.whole[k], self.escape[k] = _shares(totals[k], kinds[k], kinds[k])
            if k:
                shorter = self.contexts[k] & ((1 << 8 * (k - 1)) - 1)
                at = np.searchsorted(self.contexts[k - 1], shorter)
                inner = np.searchsorted(self.codes[k], self.codes[k + 1] & ((1 << 8 * k) - 1))
                owner = np.searchsorted(self.contexts[k], self.codes[k + 1] >> 8)
                seen = np.bincount(owner, weights=counts[k][inner], minlength=len(at)) if len(owner) else np.zeros(len(at))
                self.rest[k], self.rest_escape[k] = _shares(totals[k - 1][at] - seen, kinds[k - 1][at] - kinds[k], kinds[k - 1][at])
        never = 256 - len(self.codes[1])
        self.never = np.log2(never) if never else 0.0

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Code lengths of the last byte of each sequence after the others."""
        bits, open_, begun, longer = np.zeros(len(codes)), np.ones(len(codes), bool), np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
        for k in range(ORDER, -1, -1):
            context, there = _find(self.contexts[k], (codes >> 8) & ((1 << 8 * k) - 1))
            symbol, seen = _find(self.codes[k + 1], codes & ((1 << 8 * (k + 1)) - 1))
            after = lambda first, rest: np.where(begun, rest[k + 1][longer] if len(rest.get(k + 1, ())) else 0.0, first[k][context] if len(first[k]) else 0.0)  # noqa: B023, E731
            here = open_ & (there | begun)
            hit, miss = here & seen, here & ~seen
            bits[hit] += (after(self.whole, self.rest) - (self.logs[k + 1][symbol] if len(symbol) and len(self.logs[k + 1]) else 0.0))[hit]
            bits[miss] += after(self.escape, self.rest_escape)[miss]
            open_ &= ~hit
            begun, longer = begun | there, context
        bits[open_] += self.never
        return bits


def _shares(total: np.ndarray, kinds: np.ndarray, all_kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log2 of what a context shares out, and its escape's cost: 0 where nothing else is left, none to speak of where all 256 bytes are seen."""
    whole = total + np.where(all_kinds < 256, kinds, 0)
    with np.errstate(divide="ignore"):
        logs = np.where(whole > 0, np.log2(np.maximum(whole, 1)), 0.0)
        escape = np.where(kinds > 0, logs - np.log2(np.maximum(kinds, 1)), 0.0)
    return logs, escape


def _find(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


class Model:
    """The trees of all languages and the table of code lengths of the most frequent sequences."""

    def __init__(self, lang: np.ndarray, depth: np.ndarray, code: np.ndarray, n: np.ndarray) -> None:
        self.langs = sorted(set(lang))
        self.trees = [Tree(depth[lang == x], code[lang == x], n[lang == x]) for x in self.langs]
        own = depth == ORDER + 1
        keys, inverse = np.unique(code[own], return_inverse=True)
        share = np.bincount(inverse, weights=n[own], minlength=len(keys)) if len(keys) else np.zeros(0)
        self.keys = np.sort(keys[np.argsort(-share, kind="stable")[: CELLS // max(1, len(self.langs))]]).astype(np.uint32)
        self.table = [self.units(t, self.keys).astype(np.int32) for t in self.trees]
        # The slot of a sequence holds its place in the table; where several share a slot, the others are looked up by bisection.
        self.shift = np.uint32(32 - max(10, min(22, int(len(self.keys)).bit_length() + 3)))
        self.slots = np.zeros(1 << (32 - int(self.shift)), dtype=np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(self.keys), dtype=np.int32)

    @staticmethod
    def units(tree: Tree, codes: np.ndarray) -> np.ndarray:
        return np.rint(tree.bits(codes.astype(np.int64)) * UNIT).astype(np.int64)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(2654435761)) >> self.shift

    def lengths(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Code length in each language (columns) of each text (rows)."""
        at = self.slots[self._slot(codes)]
        wrong = np.flatnonzero(self.keys[at] != codes) if len(self.keys) else np.arange(len(codes))
        place, there = _find(self.keys, codes[wrong])
        at[wrong] = place
        rare = wrong[~there]
        out = np.empty((len(starts), len(self.langs)), dtype=np.int64)
        for k, tree in enumerate(self.trees):
            units = self.table[k][at].astype(np.int64) if len(self.keys) else np.zeros(len(codes), np.int64)
            if len(rare):
                units[rare] = self.units(tree, codes[rare])
            out[:, k] = np.add.reduceat(units, starts)
        return out


def learnt(docs: DataFrame, lang: Column, text: str, learn_from: Column) -> Model | None:
    """The model of all rows where ``learn_from`` holds. Beyond ``NODES`` nodes, those of the least share of their language go, which are never inner ones."""
    rows = docs.where(learn_from).select(lang.alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    whole = rows.mapInArrow(_counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # A sequence counts for each of its ends too, as a context's byte in shorter contexts.
    ends = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.col("code").bitwiseAND(F.lit((1 << 8 * d) - 1)).alias("code")) for d in range(1, ORDER + 2)]))
    nodes = whole.select("lang", "n", ends.alias("end")).groupBy("lang", "end.depth", "end.code").agg(F.sum("n").alias("n"))
    nodes = stored(nodes, "nodes")
    if nodes.limit(NODES + 1).count() > NODES:
        total = nodes.where("depth = 1").groupBy("lang").agg(F.sum("n").alias("total"))  # a row a language
        nodes = stored(nodes.join(F.broadcast(total), "lang").withColumn("share", F.col("n") / F.col("total")), "shares")
        least = nodes.select("share").orderBy(F.desc("share")).limit(NODES + 1).agg(F.min("share")).first()[0]
        nodes = nodes.where(F.col("share") > least)
    found = nodes.select("lang", "depth", "code", "n").toArrow()
    columns = [np.asarray(found.column(c).to_pylist() if c == "lang" else found.column(c).to_numpy()) for c in ("lang", "depth", "code", "n")]
    return Model(*columns) if found.num_rows else None


def languages(docs: DataFrame, learn_from: Column, lang: str = "lang", text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ``learn_from`` reversed by the caller, lang_pred, score of every row of ``docs``."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(learnt(docs, F.col(lang), text, learn_from))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            names, scores = np.full(batch.num_rows, NO_LANGUAGE, dtype=object), np.zeros(batch.num_rows)
            if m is not None:
                lengths = np.zeros((batch.num_rows, len(m.langs)), dtype=np.int64)
                for rows, starts, codes in _slices(batch.column("text")):
                    lengths[rows] += m.lengths(codes, starts)
                best = lengths.argmin(axis=1)
                share = 1 / np.exp2(np.maximum((lengths.min(axis=1, keepdims=True) - lengths) / UNIT, -1000)).sum(axis=1)
                letters = np.asarray(batch.column("letters"))
                names[letters], scores[letters] = np.asarray(m.langs, dtype=object)[best[letters]], share[letters]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["key", "lang_pred", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(score, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)
