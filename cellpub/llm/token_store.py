"""Token ids in a content-addressed store.

Writing: texts are encoded, an end id is added, and a rolling hash over the ids cuts each stream into chunks, so equal
passages of different documents have equal chunks between their cuts. A chunk's address is the SHA-256 of its bytes.

    <path>/streams    rows of kind ``chunk``: digest, n, ids     each different chunk once, in the order of its digest in each file
    <path>/recipes    row, doc_id, start, n_tokens, digests, sizes, root    in ascending doc_id order
    <path>/manifest   level, run, n_docs, root    Merkle roots over the documents, level by level, up to one
    <path>/store      width, end_id, tokenizer (SHA-256), n_docs, n_ids    one row

``ids`` are little-endian unsigned integers of ``width`` bytes: 2 where the vocabulary allows it, else 4. ``start`` is the number of ids of all
documents before. ``root`` is the root of the Merkle tree over the document's digests. Rows of kind ``recipe`` in the streams are recipes before they were sorted.

Reading: recipes are held against the manifest, every document against its root and every chunk against its address; anything missing or changed (but not a chunk that no recipe names)
is an error. ``read_digests`` gives length and CRC-32 of every document; CRCs of chunks combine, so bytes are not
moved to their documents. ``read_ids`` rebuilds the streams themselves.

Chunks repeated within a task are sent on once only, so a chunk that very many documents have is a row for each task where
chunks meet by digest. Recipes never meet by digest.

Defined cases: null text is empty, and then the stream is the end id alone; repeated rows have a recipe each, in any order among
themselves; null doc_ids come first; other columns are not read; an empty table gives an empty store; a very long text is a slice of its own,
cut into chunks of bounded size, and is whole only as one value of one row.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellpub.llm.common import partitions, running_sum, sorted_table, stored

#: Parameters: ids of the rolling window, least, mean and most ids in a chunk.
WINDOW, LEAST, MEAN, MOST = 16, 64, 256, 2048
#: Parameters: parts of pieces, and digests, that a worker remembers; that number over the pieces that it does; bytes of the longest piece remembered; characters encoded together; ids cut together; documents of a group of the manifest as a power of two.
REMEMBERED, PIECES_SHARE, LONGEST, TOGETHER, CUT_TOGETHER, GROUP_BITS = 600_000, 4, 100, 8_000_000, 500_000, 12
#: Fixed value: an odd multiplier and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Unicode white space but blank and line feed; Latin letters.
ODD_SPACES = "\t\x0b-\x0d\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: What ``parts_of`` does not split, in a piece; and, in a text, blanks that do not stand alone between other characters.
BEYOND, UNEVEN = rf"[^\n!-~{LATIN}]", rf"[{ODD_SPACES}]| [ \n]|\n |^ | $"
LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
#: Kinds of the bytes of a piece; bytes above ASCII are in Latin letters.
SPACE, LETTER, DIGIT, SIGN = range(4)
KINDS = np.array([SPACE if b in b" \n" else LETTER if b >= 0x80 or chr(b).isalpha() else DIGIT if chr(b).isdigit() else SIGN for b in range(0x100)], dtype=np.uint8)


def byte_letters() -> list[str]:
    """The character that the byte-level alphabet writes for each byte: printable Latin-1 for itself, the others in order from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(0x100)]


def bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some strings (no nulls), and where each begins and the last ends in them."""
    ends = np.frombuffer(strings.buffers()[1] or np.zeros(1, dtype=np.int32), dtype=np.int32)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]
    return data, ends.astype(np.int64) - ends[0]


def strings_of(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))


def parts_of(pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of pieces as the byte-level pre-tokenizer splits them, and how many each has.

    A piece has ASCII letters, digits and signs, Latin letters and line feeds, and a blank at most before them. A part is a contraction, a run of one kind (with the blank
    before it) or line feeds, the last of which stands alone before anything else.
    """
    data, ends = bytes_of(pieces)
    own = np.zeros(len(data) + 4, dtype=bool)  # first bytes of pieces; ends of contractions may be looked up beyond the last
    own[ends] = True
    kind = KINDS[data]
    starts = own.copy()
    starts[1 : len(data)] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE))
    last = last[~own[last + 1]]
    starts[last] = True
    starts[last + 1] = data[last] != 0x20
    # An apostrophe that begins a part may begin a contraction, which ends inside of a run of letters.
    marks = np.flatnonzero(data == ord("'"))
    marks = marks[starts[marks] & ~own[marks + 1]]
    after = np.concatenate([data, np.zeros(3, dtype=np.uint8)])
    short = np.isin(after[marks + 1], np.frombuffer(b"stmd", dtype=np.uint8))
    two = after[marks + 1].astype(np.int64) << 8 | after[marks + 2]
    long = np.isin(two, [int.from_bytes(x) for x in (b"re", b"ve", b"ll")]) & ~own[marks + 2]
    for which, size in ((short, 2), (long, 3)):
        starts[marks[which] + 1] = False
        starts[marks[which] + size] = True
    starts = np.flatnonzero(starts[: len(data)])
    return strings_of(data, np.append(starts, len(data))), np.diff(np.searchsorted(starts, ends))


def gathered(ids: np.ndarray, ends: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the strings at some places one after another, and the ends of each; string i has ids[ends[i] : ends[i + 1]]."""
    begins = ends[place]
    sizes = ends[place + 1] - begins
    after = np.cumsum(sizes)
    take = np.repeat(begins - after + sizes, sizes)
    take += np.arange(len(take))
    return ids[take], np.concatenate([[0], after])


def flat(rows: list[list[int]], kind: str) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)))])
    return np.fromiter(chain.from_iterable(rows), dtype=kind, count=ends[-1]), ends


def put_after(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([first[0], second[0]]), np.concatenate([first[1], first[1][-1] + second[1][1:]])


class Memory:
    """Strings and their ids. ``known`` is the ids of all, and where each string's begin and the last's end."""

    def __init__(self, kind: str):
        self.words, self.uses = pa.array([], pa.string()), np.zeros(0, dtype=np.int32)
        self.known = np.empty(0, dtype=kind), np.zeros(1, dtype=np.int64)

    def make_room(self, most: int) -> None:
        """Of too many strings, those stay that were met in several slices, half of the bound at most."""
        if len(self.words) > most:
            often = np.argsort(-self.uses, kind="stable")[: most // 2]
            keep = np.sort(often[self.uses[often] > 1])
            self.words, self.uses, self.known = self.words.take(pa.array(keep)), self.uses[keep] // 2, gathered(*self.known, keep)

    def places(self, strings: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """The place of each string among the known ones and the new ones after them, and the new ones."""
        coded = strings.dictionary_encode()
        at = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        self.uses[at[at >= 0]] += 1
        at[new] = len(self.words) + np.arange(len(new))
        return at[coded.indices.to_numpy()], coded.dictionary.take(pa.array(new))

    def learn(self, new: pa.Array, found: tuple[np.ndarray, np.ndarray]) -> None:
        """New strings and their ids; long ones are not kept."""
        short = pc.less_equal(pc.binary_length(new), LONGEST).to_numpy(zero_copy_only=False)
        if not short.all():
            new, found = new.filter(pa.array(short)), gathered(*found, np.flatnonzero(short))
        self.words, self.uses = pa.concat_arrays([self.words, new]), np.concatenate([self.uses, np.ones(len(new), dtype=np.int32)])
        self.known = put_after(self.known, found)


class Encoder:
    """The tokenizer, with the ids of pieces and of their parts remembered.

    A text is split at blanks that stand alone between other characters. The byte-level pre-tokenizer always ends a
    token before such a blank and never looks behind, so pieces encoded alone, each with its blank, give the same ids as the whole text.
    Pieces of a slice of texts are told apart by Arrow, and new ones of Latin letters, digits and signs are split
    as the pre-tokenizer does, all together; only new parts become Python strings and go to the tokenizer's model. Other new pieces go to the tokenizer whole. Texts that
    may hold an added token are encoded whole, as are all texts if the tokenizer is not a plain byte-level one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = "<u2" if max(self.tokenizer.get_vocab().values()) < 1 << 16 else "<u4"
        self.code = "H" if self.kind == "<u2" else "I"
        parts = json.loads(self.tokenizer.to_str())
        pre = parts["pre_tokenizer"] or {}
        self.by_piece = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not parts["normalizer"] and parts["model"]["type"] == "BPE"
        self.added = "|".join(re.escape(t["content"]) for t in parts["added_tokens"])
        letters = [x.encode() for x in byte_letters()]
        self.letters, self.spelt_sizes = np.frombuffer(b"".join(x.ljust(2, b"\0") for x in letters), dtype=np.uint8).reshape(-1, 2), np.array([len(x) for x in letters])
        self.pieces, self.parts = Memory(self.kind), Memory(self.kind)

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        """The encoder of this Python worker, kept from task to task. Functions are shipped by value, so no module of ours lives that long."""
        kept = sys.modules.setdefault("cellpub_worker", types.ModuleType("cellpub_worker"))
        if getattr(kept, "path", None) != path:
            kept.path, kept.encoder = path, cls(path)
        return kept.encoder

    @property
    def words(self) -> pa.Array:
        return self.pieces.words

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def spelt(self, parts: pa.Array) -> list[str]:
        """Parts in the byte-level alphabet, a letter of one or two bytes for each byte."""
        data, ends = bytes_of(parts)
        letters = self.letters[data]
        after = np.concatenate([[0], np.cumsum(self.spelt_sizes[data])])
        return strings_of(letters[letters != 0], after[ends]).to_numpy(zero_copy_only=False).tolist()

    def _by_parts(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces without anything that is beyond ``parts_of``."""
        self.parts.make_room(REMEMBERED)
        parts, counts = parts_of(pieces)
        place, new = self.parts.places(parts)
        model, ids, ends = self.model.tokenize, array(self.code), array("q", [0])
        put, end = ids.append, ends.append
        for x in self.spelt(new):
            for token in model(x):
                put(token.id)
            end(len(ids))
        found = np.array(ids, dtype=self.kind), np.array(ends)
        ids, ends = gathered(*put_after(self.parts.known, found), place)
        self.parts.learn(new, found)
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]

    def _encoded(self, words: pa.Array, firsts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each with a blank before it, and then of the first pieces of texts, which have none."""
        pieces = pa.concat_arrays([pc.binary_join_element_wise("", words, " "), firsts])
        beyond = pa.concat_arrays([pc.match_substring_regex(x, BEYOND) for x in (words, firsts)])
        if not pc.any(beyond, min_count=0).as_py():
            return self._by_parts(pieces)
        both = put_after(self._by_parts(pieces.filter(pc.invert(beyond))), flat(self.whole(pieces.filter(beyond).to_pylist()), self.kind))
        beyond = beyond.to_numpy(zero_copy_only=False)
        place = np.empty(len(pieces), dtype=np.int64)
        place[np.concatenate([np.flatnonzero(~beyond), np.flatnonzero(beyond)])] = np.arange(len(pieces))
        return gathered(*both, place)

    def _streams(self, lists: pa.ListArray) -> list[np.ndarray]:
        """Ids of texts given as lists of their pieces (none is empty)."""
        self.pieces.make_room(REMEMBERED // PIECES_SHARE)
        pieces, begins = lists.flatten(), lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        place, new = self.pieces.places(pieces)
        # The first piece of a text has no blank before it; it isn't remembered.
        found = self._encoded(new, pieces.take(pa.array(begins)))
        all_ids = put_after(self.pieces.known, found)
        n_all, n_new = len(all_ids[1]) - 1, len(new)
        place[begins] = np.arange(n_all - len(begins), n_all)
        self.pieces.learn(new, (found[0][: found[1][n_new]], found[1][: n_new + 1]))
        ids, ends = gathered(*all_ids, place)
        return np.split(ids, ends[begins[1:]])

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (no nulls)."""
        out: list[np.ndarray | None] = [None] * len(texts)
        mark = lambda pattern: pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
        whole = mark(self.added) if self.added else np.zeros(len(texts), dtype=bool)
        whole = whole | (pc.utf8_length(texts).to_numpy() == 0) | (not self.by_piece)
        uneven = mark(UNEVEN) & ~whole
        even = ~whole & ~uneven
        take = lambda rows: texts.take(pa.array(np.flatnonzero(rows)))
        for rows, streams in (
            (whole, lambda: [np.array(x, dtype=self.kind) for x in self.whole(take(whole).to_pylist())]),
            (uneven, lambda: self._streams(pa.array([LONE_BLANK.split(t) for t in take(uneven).to_pylist()], pa.list_(pa.string())))),
            (even, lambda: self._streams(pc.split_pattern(take(even), " "))),
        ):
            if rows.any():
                for i, ids in zip(np.flatnonzero(rows).tolist(), streams(), strict=True):
                    out[i] = ids
        return out


def cuts(streams: list[np.ndarray]) -> list[list[int]]:
    """Ends of the chunks of each stream. A cut may follow where the hash of the last ``WINDOW`` ids says so, ``LEAST`` or more after the one before."""
    sizes = [len(x) for x in streams]
    ids = np.concatenate(streams) if streams else np.empty(0, dtype=np.uint16)
    n = len(ids)
    out: list[list[int]] = []
    wanted = np.empty(0, dtype=np.int64)
    if n >= WINDOW:
        powers = []
        for base in (INVERSE, BASE):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            powers.append(np.cumprod(p, dtype=np.uint64))
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed * powers[0], dtype=np.uint64)])
        rolling = (sums[WINDOW:] - sums[:-WINDOW]) * powers[1][WINDOW - 1 :]
        rolling = (rolling ^ (rolling >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        wanted = np.flatnonzero((rolling >> np.uint64(40)) % np.uint64(MEAN - LEAST) == 0) + WINDOW
    # Windows that begin in the stream before end too early for a cut: LEAST is not less than WINDOW.
    start = 0
    for size, some in zip(sizes, np.split(wanted, np.searchsorted(wanted, np.cumsum(sizes)[:-1], side="right")) if sizes else [], strict=True):
        own, at = [], 0
        for end in [*(some - start).tolist(), size]:
            while end - at > MOST:
                at += MOST
                own.append(at)
            if end - at >= LEAST or end == size and end > at:
                at = end
                own.append(at)
        out.append(own)
        start += size
    return out


def merkle(leaves: list[bytes]) -> bytes:
    """Root of the binary tree; leaves and nodes are told apart by a prefix, and an odd node goes up as it is."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + a + b).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with some ``most`` bytes of a column; a longer value is a part of its own or ends one."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    part = (np.cumsum(size, dtype=np.int64) - size) // most
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(bounds, bounds[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)


def all_cuts(streams: list[np.ndarray]) -> Iterator[list[int]]:
    """``cuts`` of some streams after others, so that the arrays of one call stay small."""
    some, held = [], 0
    for ids in streams:
        if some and held + len(ids) > CUT_TOGETHER:
            yield from cuts(some)
            some, held = [], 0
        some.append(ids)
        held += len(ids)
    yield from cuts(some)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = "key long, kind string, doc_id long, n long, digest binary, ids binary, digests array<binary>, sizes array<int>, root binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = Encoder.of_worker(tokenizer), set()
        width = np.dtype(encode.kind).itemsize
        end_mark = np.array([end_id], dtype=encode.kind)
        for part in (x for batch in batches for x in slices(batch, "text", TOGETHER)):
            streams = [np.append(ids, end_mark) for ids in encode(part.column("text"))]
            chunks, recipes = {}, []
            for doc, ids, ends in zip(part.column("doc_id").to_pylist(), streams, all_cuts(streams), strict=True):
                data, digests, sizes, begin = ids.tobytes(), [], [], 0
                for end in ends:
                    chunk = data[begin * width : end * width]
                    digests.append(hashlib.sha256(chunk).digest()), sizes.append(end - begin)
                    if digests[-1] not in seen:
                        chunks[digests[-1]] = chunk
                    begin = end
                recipes.append((doc, len(ids), digests, sizes, merkle(digests)))
            if len(seen) < REMEMBERED:
                seen.update(chunks)
            c, r = len(chunks), len(recipes)
            doc, n, digests, sizes, root = zip(*recipes, strict=True)
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([int.from_bytes(x[:8]) >> 1 for x in chunks] + [-1 - zlib.crc32(b"%a" % i, zlib.crc32(x)) for i, x in zip(doc, root, strict=True)], pa.int64()),
                "kind": ["chunk"] * c + ["recipe"] * r,
                "doc_id": pa.array([None] * c + list(doc), pa.int64()),
                "n": pa.array([len(x) // width for x in chunks.values()] + list(n), pa.int64()),
                "digest": pa.array(list(chunks) + [None] * r, pa.binary()),
                "ids": pa.array(list(chunks.values()) + [None] * r, pa.binary()),
                "digests": pa.array([None] * c + list(digests), pa.list_(pa.binary())),
                "sizes": pa.array([None] * c + list(sizes), pa.list_(pa.int32())),
                "root": pa.array([None] * c + list(root), pa.binary()),
            })

    # Texts are encoded once: chunks meet by digest, recipes stay spread, both in one shuffle. The key of a chunk begins its digest, so it sorts as that does, after recipes.
    met = texts.mapInArrow(run, schema).repartition(partitions(spark), "key")
    before = F.lag("digest").over(Window.partitionBy("key").orderBy("digest"))
    once = met.withColumn("before", before).where((F.col("kind") == "recipe") | F.col("before").isNull() | (F.col("before") != F.col("digest")))
    # Ids and digests hardly repeat, so a dictionary of them is wasted work.
    once.drop("key", "before").write.option("parquet.enable.dictionary", "false").parquet(f"{path}/streams")
    # The chunks are final as they are; recipes get their order and their starts.
    unsorted = spark.read.schema(schema.removeprefix("key long, ")).parquet(f"{path}/streams").where("kind = 'recipe'")
    recipes = sorted_table(unsorted.select("doc_id", "n", "digests", "sizes", "root"), ["doc_id"], "recipes")
    row = F.shiftleft(F.col("part").cast("long"), 33).bitwiseOR(F.col("at"))
    recipes = running_sum(recipes, "n", "start").select(row.alias("row"), "doc_id", F.col("start").cast("long").alias("start"), F.col("n").alias("n_tokens"), "digests", "sizes", "root")
    recipes.repartitionByRange(partitions(spark), "row").sortWithinPartitions("row").write.parquet(f"{path}/recipes")

    written = spark.read.parquet(f"{path}/recipes")
    manifest(written).write.parquet(f"{path}/manifest")
    with open(tokenizer, "rb") as f:
        of = hashlib.sha256(f.read()).hexdigest()
    width = np.dtype(Encoder.of_worker(tokenizer).kind).itemsize
    written.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_ids")).select(F.lit(width).alias("width"), F.lit(end_id).alias("end_id"), F.lit(of).alias("tokenizer"), "n_docs", "n_ids").write.parquet(f"{path}/store")


def chunk_files(spark: SparkSession, path: str) -> DataFrame:
    """digest, ids of every chunk in the store."""
    rows = spark.read.schema("kind string, digest binary, ids binary").parquet(f"{path}/streams")
    return rows.where("kind = 'chunk'").select("digest", "ids")


def manifest(recipes: DataFrame) -> DataFrame:
    """level, run, n_docs, root: Merkle roots over runs of up to 2^GROUP_BITS documents, then over runs of such roots, up to one root of the whole store."""

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [merkle([x["root"] for x in some]) for some in batch.column("some").to_pylist()]
            yield pa.RecordBatch.from_pydict({"run": batch.column("run"), "n_docs": batch.column("n_docs"), "root": pa.array(roots, pa.binary())})

    said = F.concat_ws(",", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "start", "n_tokens")
    level = recipes.select(F.col("row").alias("run"), F.lit(1).cast("long").alias("n_docs"), F.unhex(F.sha2(F.concat("root", F.encode(said, "UTF-8")), 256)).alias("root"))
    out, k = None, 0
    while True:
        some = level.groupBy(F.shiftright("run", GROUP_BITS).alias("run")).agg(F.sum("n_docs").alias("n_docs"), F.array_sort(F.collect_list(F.struct("run", "root"))).alias("some"))
        level = stored(some.mapInArrow(rooted, "run long, n_docs long, root binary"), "manifest")
        named = level.select(F.lit(k).alias("level"), "*")
        out, k = named if out is None else out.unionByName(named), k + 1
        if level.limit(2).count() < 2:
            return out


def opened(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """Bytes of an id, and the recipes, after holding them against the manifest: any that is lost, added or changed raises an error."""
    store = spark.read.parquet(f"{path}/store").first()
    recipes = spark.read.parquet(f"{path}/recipes")
    written, found = spark.read.parquet(f"{path}/manifest"), manifest(recipes)
    both = written.withColumn("side", F.lit(1)).unionByName(found.withColumn("side", F.lit(-1)))
    if not both.groupBy("level", "run", "n_docs", "root").agg(F.sum("side").alias("side")).where("side <> 0").isEmpty():
        raise ValueError("the recipes are not those of the manifest")
    return store["width"], recipes


def references(recipes: DataFrame) -> DataFrame:
    """row, doc_id, start, n_tokens, n_chunks, pos, digest, after (ids after the chunk): a row for each chunk of each document; a document that does not have its root raises an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            digests, sizes = batch.column("digests"), batch.column("sizes").flatten().to_numpy()
            flat, counts = digests.flatten(), pc.list_value_length(digests).to_numpy().astype(np.int64)
            each, ends = flat.to_numpy(zero_copy_only=False).tolist(), np.cumsum(counts)
            for end, n, root in zip(ends.tolist(), counts.tolist(), batch.column("root").to_pylist(), strict=True):
                if merkle(each[end - n : end]) != root:
                    raise ValueError("a document does not have the root of its recipe")
            sums = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            of = np.repeat(np.arange(len(counts)), counts)
            own = {c: batch.column(c).take(pa.array(of)) for c in ("row", "doc_id", "start", "n_tokens")}
            yield pa.RecordBatch.from_pydict(own | {"n_chunks": pa.array(counts[of]), "pos": pa.array(np.arange(len(of)) - (ends - counts)[of]), "digest": flat, "after": pa.array(sums[ends][of] - sums[1:])})

    return recipes.select("row", "doc_id", "start", "n_tokens", "digests", "sizes", "root").mapInArrow(run, "row long, doc_id long, start long, n_tokens long, n_chunks long, pos long, digest binary, after long")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files; a chunk, document or recipe that is missing or does not verify raises an error."""
    width, recipes = opened(spark, path)

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc, size = [], []
            for digest, ids in zip(*(batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("digest", "ids")), strict=True):
                if hashlib.sha256(ids).digest() != digest:
                    raise ValueError(f"chunk {digest.hex()} is damaged")
                crc.append(zlib.crc32(ids if width == 4 else np.frombuffer(ids, dtype=f"<u{width}").astype("<u4")))
                size.append(len(ids) // width)
            yield pa.RecordBatch.from_pydict({"digest": batch.column("digest"), "n_ids": pa.array(size, pa.int64()), "crc": pa.array(crc, pa.int64())})

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = zero_tables()
        for batch in batches:
            if batch.column("crc").null_count:
                raise ValueError("a chunk of a document is missing")
            crc = shifted(batch.column("crc").to_numpy().astype(np.uint32), 4 * batch.column("after").to_numpy(), tables)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("row", "doc_id", "start", "n_tokens", "n_chunks", "n_ids")} | {"crc": pa.array(crc.astype(np.int64))})

    chunks = chunk_files(spark, path).mapInArrow(checked, "digest binary, n_ids long, crc long")
    # A row of some 90 bytes for each reference; a frequent chunk is on the side that a skewed join splits.
    parts = references(recipes).drop("pos").join(chunks, "digest", "left").mapInArrow(moved, "row long, doc_id long, start long, n_tokens long, n_chunks long, n_ids long, crc long")
    whole = parts.groupBy("row", "doc_id", "start", "n_tokens", "n_chunks").agg(F.count("*").alias("found"), F.sum("n_ids").alias("n_ids"), F.bit_xor("crc").alias("ids_crc32"))
    fits = (F.col("found") == F.col("n_chunks")) & (F.col("n_ids") == F.col("n_tokens"))
    n_tokens = F.when(fits, F.col("n_ids")).otherwise(F.raise_error(F.lit("a document does not have the chunks of its recipe")).cast("long"))
    return whole.select("doc_id", "start", n_tokens.alias("n_tokens"), "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (array<int>) of every document, rebuilt from its chunks."""
    width, recipes = opened(spark, path)
    parts = references(recipes).select("row", "doc_id", "start", "n_tokens", "pos", "digest").join(chunk_files(spark, path), "digest", "left")
    parts = parts.groupBy("row", "doc_id", "start", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("parts"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = []
            for n, parts in zip(batch.column("n_tokens").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                if any(p["ids"] is None for p in parts):
                    raise ValueError("a chunk of a document is missing")
                whole.append(np.frombuffer(b"".join(p["ids"] for p in parts), dtype=f"<u{width}").astype(np.int32))
                if len(whole[-1]) != n:
                    raise ValueError("a document does not have the chunks of its recipe")
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "start": batch.column("start"), "ids": pa.array(whole, pa.list_(pa.int32()))})

    return parts.select("doc_id", "start", "n_tokens", "parts").mapInArrow(joined, "doc_id long, start long, ids array<int>")


# -- CRC-32 of a concatenation -------------------------------------------------------------------------------


def _times(matrix: list[int], vector: int) -> int:
    out, i = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


def zero_tables(powers: int = 48) -> np.ndarray:
    """For each power of two, what appending so many zero bytes makes of each byte of a CRC, in each of its four places."""
    matrix = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
    for _ in range(3):
        matrix = [_times(matrix, x) for x in matrix]
    byte, out = np.arange(256, dtype=np.uint32), np.zeros((powers, 4, 256), dtype=np.uint32)
    for p in range(powers):
        for bit in range(32):
            out[p, bit // 8] ^= np.where(byte >> np.uint32(bit % 8) & np.uint32(1), np.uint32(matrix[bit]), np.uint32(0))
        matrix = [_times(matrix, x) for x in matrix]
    return out


def shifted(crc: np.ndarray, after: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """What each CRC gives to that of the whole, where ``after`` bytes follow: the whole's CRC is the exclusive or of all parts'."""
    out = crc.copy()
    for p in range(int(after.max(initial=0)).bit_length()):
        on = np.flatnonzero(after >> p & 1)
        x = out[on]
        out[on] = tables[p, 0][x & 255] ^ tables[p, 1][x >> 8 & 255] ^ tables[p, 2][x >> 16 & 255] ^ tables[p, 3][x >> 24]
    return out
