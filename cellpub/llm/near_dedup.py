"""MinHash near-dedup with SuperMinHash signatures.

1. ``signed``: each text becomes its set of distinct word shingles (64-bit hashes), a SuperMinHash signature, band
   keys, an odd sketch (it bounds the difference of two sets from below) and a 128-bit key of the whole set. Texts with equal sets form a class; from here on, only classes
   are compared, so exact copies, however many, cost one row.
2. ``_stars``: in each bucket (band, key), every class is paired with the bucket's centre only: a group of n
   gives n - 1 pairs, not n (n - 1) / 2. The centre is the class with most company in all its buckets, as the text that others
   were copied from has. Pairs whose sketches rule the threshold out are dropped; for the others, whole texts are compared (``_confirmed``).
3. ``grouped``: union-find over the confirmed links: local forests in each partition, then stars over all.
4. The rest exactly: buckets where several components are left are scanned in blocks of bounded size, and classes of different
   components whose sketches are near enough become pairs. For each class and foreign component the likeliest pair is
   confirmed first; most components merge by that, and of the other pairs only those between components are left to confirm.
   So no link that shares a bucket is lost, and pairs inside a component, which cannot change the result, are never made.

With ``BANDS`` bands of ``ROWS`` values, a pair at similarity 0.8 shares no bucket with probability (1 - 0.8^6)^44 =
1.6e-6, and signatures of SuperMinHash (correlated ranks) do not exceed that.

Defined cases: null and wordless texts have an empty set and are linked with nothing; a text of fewer words
than a shingle is one shingle; repeated rows are one class; null doc_ids take part, but are kept only where
no row of the component has a doc_id (component_id is null then); very long texts are read whole, their sets one at a time; an empty table
gives an empty table; other columns are not read, and ``drop_near`` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpub.llm.common import BROADCAST_ROWS, content_key, hot_join, only_kept, partitions, small_enough, stored

BANDS, ROWS = 44, 6
SLOTS = BANDS * ROWS
#: Bits of an odd sketch.
BITS = 2048
#: Rows of a star that are checked against one reading of its centre, and classes of a bucket that are scanned together.
CHUNK, BLOCK = 64, 512
#: Elements that take a step together, and the sets that count as small.
ELEMENTS, SMALL = 4096, 100

#: Odd multipliers of the splitmix64 finaliser.
MIX_A, MIX_B, GAMMA = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, content_key, n_shingles, class_id, component_id, kept, one (the row stands for its group) for every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), content_key(F.col(text_col)).alias("content_key"))
    rows = signed(texts, shingle)
    classes = _classes(rows)
    keyed = classes.select("class_id", "n_shingles", F.explode("bands").alias("bucket"))

    shared = _shared(keyed)
    links = _confirmed(texts, _likely(_stars(shared, percent), classes, percent), classes, shingle, percent)
    roots = grouped(links)
    left = _between(shared, roots, classes, percent)
    for first in (True, False):
        some = _foremost(left, roots) if first else _apart(left, roots)
        if some.isEmpty():
            break
        links = links.unionByName(_confirmed(texts, some, classes, shingle, percent))
        roots = grouped(links)

    # A class without links is a component of its own; those of a component take the smallest row of it, a large component's where they are.
    own = F.struct(F.col("rep_doc").isNull().alias("no_id"), F.col("rep_doc").alias("doc"), F.col("rep_key").alias("key"))
    small = classes.select("set_key", "class_id", own.alias("own"), "copies")
    named = stored(small.join(roots, small["class_id"] == roots["node"], "left").select("set_key", "class_id", "own", "root", "copies"), "named")
    smallest = stored(named.where("root is not null").groupBy("root").agg(F.min("own").alias("least"), F.count("*").alias("group_rows")), "components")
    named = hot_join(named.where("root is not null"), smallest, ["root"]).select("set_key", "class_id", "least", "copies").unionByName(named.where("root is null").select("set_key", "class_id", F.col("own").alias("least"), "copies"))
    # Rows of a set with very many of them stay where they are, and those without words need no join.
    named = stored(named.withColumnRenamed("copies", "group_rows"), "least")
    rows = rows.select("doc_id", "content_key", "n_shingles", "set_key")
    with_words = hot_join(rows.where("n_shingles > 0"), named, ["set_key"]).drop("group_rows")
    found = with_words.unionByName(rows.where("n_shingles = 0"), allowMissingColumns=True)
    empty = F.col("n_shingles") == 0
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("least.doc"))
    one = empty | F.col("doc_id").eqNullSafe(F.col("least.doc")) & (F.col("content_key") == F.col("least.key"))
    return found.select("doc_id", "content_key", "n_shingles", "class_id", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), one.alias("one"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group, that of the smallest (doc_id, content key) with null last, and all documents without words; all columns stay."""
    kept = near_groups(docs, id_col, text_col, shingle, percent).where("one").select("doc_id", "content_key")
    return only_kept(docs, kept, id_col, text_col)


# -- sets and signatures -------------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles. bytes.lower and bytes.split know exactly A-Z and 20, 09-0D."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = max(1, len(words) - k + 1)
    # A whole sequence shorter than k has its length mixed in, as no shingle of k words does.
    width = min(k, len(words))
    out = np.full(n, 0 if width == k else width, dtype=np.uint64)
    for j in range(width):
        out = mixed((out + np.uint64(GAMMA)) ^ h[j : j + n])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash: element by step j, rank r + j goes to slot p(j) of the element's own permutation p.

    The sets (none of them empty) are taken in groups of some thousand elements; all elements of a group take a step together.
    After step j, a slot below j + 1 can't change any more: a set whose slots are all so far stops early.
    """
    h = np.full((len(sets), slots), np.inf)
    small = [i for i, s in enumerate(sets) if len(s) < SMALL]
    large = [i for i, s in enumerate(sets) if len(s) >= SMALL]
    for some, dense in ((small, True), (large, False)):
        group, size = [], 0
        for i in some:
            if group and size + len(sets[i]) > ELEMENTS:
                h[group] = _ranked([sets[g] for g in group], slots, dense)
                group, size = [], 0
            group.append(i)
            size += len(sets[i])
        if group:
            h[group] = _ranked([sets[g] for g in group], slots, dense)
    return h


def _ranked(sets: list[np.ndarray], slots: int, dense: bool) -> np.ndarray:
    """dense: permutations are held (small sets take many steps); else they follow from the few swaps so far."""
    e = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)) * slots, [len(s) for s in sets])
    h = np.full(len(sets) * slots, np.inf)
    perm = np.tile(np.arange(slots, dtype=np.uint16), (len(e), 1)) if dense else None
    swaps: list[tuple[np.ndarray, np.ndarray]] = []
    for j in range(slots):
        if j:
            going = h.reshape(-1, slots).max(axis=1) >= j
            if not going.any():
                break
            live = going[of // slots]
            if live.mean() < 0.8:
                e, of, swaps = e[live], of[live], [(a[live], b[live]) for a, b in swaps]
                perm = perm[live] if dense else None
        random = mixed(e + np.uint64((j + 1) * GAMMA & 0xFFFFFFFFFFFFFFFF))
        rank = (random >> np.uint64(11)).astype(np.float64) * 2.0**-53 + j
        k = j + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if dense:
            row = np.arange(len(e))
            slot = perm[row, k].astype(np.int64)
            perm[row, k] = perm[:, j]
        else:
            slot, here = k.copy(), np.full(len(e), j)
            for at, value in swaps:
                slot = np.where(at == k, value, slot)
                here = np.where(at == j, value, here)
            swaps.append((k, here))
        np.minimum.at(h, of + slot, rank)
    return h.reshape(-1, slots)


def odd_sketch(s: np.ndarray) -> bytes:
    """A bit for each of ``BITS`` groups of hashes: does the set have an odd number of them. In the exclusive or of two
    sketches each bit stands for at least one element of one set only, so its ones never exceed the symmetric difference."""
    return np.packbits((np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def unpacked(sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures, a byte a slot, and odd sketches as words."""
    rows = np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(-1, SLOTS + BITS // 8)
    return rows[:, :SLOTS], np.ascontiguousarray(rows[:, SLOTS:]).view(np.uint64)


def near_enough(sig, odd, sig_b, odd_b, n, n_b, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may reach the threshold, and their equal slots. Odd sketches rule out exactly; a signature does if it is
    five standard deviations of plain MinHash below the threshold (SuperMinHash spreads less)."""
    j = percent / 100
    least = SLOTS * j - 5 * (SLOTS * j * (1 - j)) ** 0.5
    # similarity >= p / 100 exactly if (100 + p) * symmetric difference <= (100 - p) * sum of sizes
    apart = np.bitwise_count(odd ^ odd_b).sum(axis=1, dtype=np.int64)
    same = (sig == sig_b).sum(axis=1)
    return ((100 + percent) * apart <= (100 - percent) * (n + n_b)) & (same >= least), same


def signed(texts: DataFrame, shingle: int) -> DataFrame:
    """doc_id, content_key, n_shingles, set_key, sketch (signature, a byte a slot, and odd sketch), bands; stored."""
    schema = "doc_id long, content_key long, n_shingles long, set_key binary, sketch binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), shingle) for text in batch.column("text")]
            full = [s for s in sets if len(s)]
            values = mixed(super_minhash(full).view(np.uint64))
            keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(full), 1))
            for r in range(ROWS):
                keys = mixed((keys + np.uint64(GAMMA)) ^ values[:, r::ROWS])
            sketches = (v.tobytes() + odd_sketch(s) for v, s in zip(values.astype(np.uint8), full, strict=True))
            by_set = zip((xxhash.xxh3_128_digest(s.tobytes()) for s in full), sketches, keys.view(np.int64), strict=True)
            rows = [next(by_set) if len(s) else (None, None, None) for s in sets]
            sizes = [len(s) for s in sets]
            keys, sketches, bands = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "content_key", "n_shingles", "set_key", "sketch", "bands"],
            )

    return stored(texts.mapInArrow(run, schema), "signed")


def _classes(rows: DataFrame) -> DataFrame:
    """A row for each distinct set, with a number of its own and the smallest row that has the set."""
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content_key"))
    classes = rows.where("n_shingles > 0").groupBy("set_key").agg(rep.alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"), F.count("*").alias("copies"))
    classes = classes.select(F.monotonically_increasing_id().alias("class_id"), "set_key", F.col("rep.doc_id").alias("rep_doc"), F.col("rep.content_key").alias("rep_key"), "n_shingles", "sketch", "bands", "copies")
    return stored(classes, "classes")


# -- candidates ----------------------------------------------------------------------------------------------


def _shared(keyed: DataFrame) -> DataFrame:
    """(bucket, class_id, n_shingles, n): the rows of buckets with n > 1 classes; stored."""
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return stored(keyed.join(sizes, "bucket"), "shared")


def _fits(a: str, b: str, percent: int) -> Column:
    """Sets of these sizes may reach the threshold."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _stars(shared: DataFrame, percent: int) -> DataFrame:
    """(centre, class_id): each class of a bucket with the one that has most company, if their sizes allow."""
    company = shared.groupBy("class_id").agg(F.sum("n").alias("company"))
    best = F.max(F.struct("company", (-F.col("class_id")).alias("less"), F.col("n_shingles").alias("n_centre")))
    centres = shared.join(company, "class_id").groupBy("bucket").agg(best.alias("best")).select("bucket", (-F.col("best.less")).alias("centre"), "best.n_centre")
    pairs = shared.join(centres, "bucket").where((F.col("class_id") != F.col("centre")) & _fits("n_shingles", "n_centre", percent))
    return pairs.select("centre", "class_id").distinct()


def _rooted(rows: DataFrame, roots: DataFrame, column: str, out: str) -> DataFrame:
    found = roots.select(F.col("node").alias(column), F.col("root").alias(out))
    return rows.join(found, column, "left").withColumn(out, F.coalesce(out, column))


def _between(shared: DataFrame, roots: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(centre, class_id, alike): pairs of one bucket that are in different components and near enough by size and signature; stored.

    Members of a bucket's largest component need not be compared with each other. So the others, its minor members, are cut into chunks of some
    BLOCK; every two chunks are a block, and so is each chunk with each chunk of the largest component's members (chunks beyond the minor ones). However
    large a component is, its rows are copied once for each minor chunk. Rows meet by block, and a task holds one block at a time; only pairs that pass leave it.
    """
    rooted = _rooted(shared, roots, "class_id", "root")
    open_ones = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    rooted = stored(rooted.join(open_ones, "bucket"), "open")
    sizes = rooted.groupBy("bucket", "root").agg(F.count("*").alias("members"))
    sizes = sizes.groupBy("bucket").agg(F.max(F.struct("members", "root")).alias("most")).select("bucket", F.col("most.root").alias("largest"), F.col("most.members").alias("major"))
    rows = rooted.join(sizes, "bucket").join(classes.select("class_id", "sketch"), "class_id")
    minor = F.col("root") != F.col("largest")
    chunks = lambda count: F.ceil(count / BLOCK).cast("int")
    minors, majors = chunks(F.col("n") - F.col("major")), chunks(F.col("major"))
    place = F.xxhash64("class_id")
    own = F.when(minor, F.pmod(place, minors)).otherwise(minors + F.pmod(place, majors)).cast("int")
    others = F.sequence(F.lit(0), F.when(minor, minors + majors - 1).otherwise(minors - 1))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    rows = rows.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "class_id", "root", "n_shingles", "sketch")
    rows = rows.repartition(partitions(shared.sparkSession), "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")

    def pairs_of(lo, own, ids, roots, sizes, sketches) -> tuple[np.ndarray, ...]:
        a, b, alike = [], [], []
        sig, odd = unpacked(sketches)
        own, ids, roots, sizes = np.array(own), np.array(ids), np.array(roots), np.array(sizes)
        one_chunk = (own == own[0]).all()
        for i in range(len(ids)):
            if one_chunk:
                to = np.arange(i + 1, len(ids))
            elif own[i] == lo:
                to = np.flatnonzero(own != lo)
            else:
                continue
            to = to[(roots[to] != roots[i]) & (100 * np.minimum(sizes[to], sizes[i]) >= percent * np.maximum(sizes[to], sizes[i]))]
            near, same = near_enough(sig[to], odd[to], sig[i], odd[i], sizes[to], sizes[i], percent)
            to = to[near]
            a.append(np.minimum(ids[i], ids[to])), b.append(np.maximum(ids[i], ids[to])), alike.append(same[near])
        return tuple(np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (a, b, alike))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush():
            columns = list(zip(*held, strict=True))
            if len(held) > 1 and len(set(columns[2])) > 1:
                # Blocks of two chunks pair members of different chunks; those of one chunk are the block (own, own).
                if key[1] == key[2] or len(set(columns[0])) > 1:
                    a, b, alike = pairs_of(key[1], *columns)
                    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(alike, pa.int64())], names=["centre", "class_id", "alike"])
            return None

        for batch in batches:
            for bucket, lo, hi, *row in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if key != (bucket, lo, hi):
                    if held and (out := flush()) is not None:
                        yield out
                    key, held = (bucket, lo, hi), []
                held.append(row)
        if held and (out := flush()) is not None:
            yield out

    return stored(rows.mapInArrow(run, "centre long, class_id long, alike long").distinct(), "between")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    return _rooted(_rooted(pairs, roots, "centre", "root_a"), roots, "class_id", "root_b").where("root_a <> root_b").select("centre", "class_id")


def _foremost(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """For each class and each component it is not in, the likeliest pair."""
    both = _rooted(_rooted(pairs, roots, "centre", "root_a"), roots, "class_id", "root_b")
    one = lambda x, root: both.groupBy(x, root).agg(F.max(F.struct("alike", "centre", "class_id")).alias("best")).select("best.centre", "best.class_id")
    return one("centre", "root_b").unionByName(one("class_id", "root_a")).distinct()


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and signatures allow."""
    small = classes.select("class_id", "n_shingles", "sketch")
    a = small.select(F.col("class_id").alias("centre"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"))
    joined = pairs.join(a, "centre").join(small, "class_id")
    joined = joined.where(_fits("n_a", "n_shingles", percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (sig, odd), (sig_b, odd_b) = (unpacked(batch.column(c).to_pylist()) for c in ("sketch_a", "sketch"))
            n, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_shingles"))
            keep = pa.array(near_enough(sig, odd, sig_b, odd_b, n, n_b, percent)[0])
            yield pa.RecordBatch.from_arrays([batch.column("centre").filter(keep), batch.column("class_id").filter(keep)], names=["centre", "class_id"])

    return stored(joined.select("centre", "class_id", "n_a", "n_shingles", "sketch_a", "sketch").mapInArrow(run, "centre long, class_id long"), "likely")


# -- confirmation on whole sets ------------------------------------------------------------------------------


def _confirmed(texts: DataFrame, pairs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    A star is dealt out in chunks: each member's text goes to its chunk once, the centre's once to every chunk.
    A chunk is read as a stream that holds one set at a time.
    """
    sizes = pairs.groupBy("centre").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = pairs.join(sizes, "centre")
    members = dealt.select("centre", F.pmod(F.xxhash64("class_id"), F.col("chunks")).cast("int").alias("chunk"), "class_id")
    centres = members.select("centre", "chunk", F.col("centre").alias("class_id")).distinct()
    wanted = stored(members.unionByName(centres).join(classes.select("class_id", "rep_doc", "rep_key"), "class_id"), "wanted")
    # Few rows are broadcast, so that only their texts move; beyond the bound both sides are shuffled.
    wanted = F.broadcast(wanted) if small_enough(wanted, BROADCAST_ROWS) else wanted
    # Rows repeated in the input give repeated links; grouping does not mind.
    with_text = wanted.join(texts, wanted["rep_doc"].eqNullSafe(texts["doc_id"]) & (wanted["rep_key"] == texts["content_key"]))
    stream = with_text.select("centre", "chunk", (F.col("class_id") != F.col("centre")).alias("member"), "class_id", "text")
    stream = stream.repartition(partitions(texts.sparkSession), "centre", "chunk").sortWithinPartitions("centre", "chunk", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, whole = None, None
        for batch in batches:
            a, b = [], []
            for centre, chunk, member, class_id, text in zip(*(batch.column(c).to_pylist() for c in ("centre", "chunk", "member", "class_id", "text")), strict=True):
                if not member:
                    if at != (centre, chunk):
                        at, whole = (centre, chunk), shingle_set(text, shingle)
                    continue
                own = shingle_set(text, shingle)
                both = len(np.intersect1d(whole, own, assume_unique=True))
                if 100 * both >= percent * (len(whole) + len(own) - both):
                    a.append(centre), b.append(class_id)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return stored(stream.mapInArrow(run, "a long, b long"), "links")


# -- union-find ----------------------------------------------------------------------------------------------


def grouped(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node of its component.

    First each partition reduces its links to a forest by union-find. Then, until nothing changes, every node's
    neighbours are hung on the smallest of them and itself (the stars grow at least twofold in each round).
    Links stay in tables; the driver sees one count a round.
    """

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = find(a), find(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        own = [x for x in parent if find(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([parent[x] for x in own], pa.int64())], names=["node", "root"])

    edges = stored(links.mapInArrow(forest, "node long, root long"), "forest").distinct()
    while True:
        # Small star: node > root here, so each node's smaller neighbours meet at the smallest.
        low = edges.groupBy("node").agg(F.min("root").alias("low"))
        small = edges.join(low, "node").select(F.col("root").alias("node"), F.col("low").alias("root")).where("node <> root").unionByName(low.select("node", F.col("low").alias("root"))).distinct()
        # Large star: the larger neighbours of a node, and not itself, go to its smallest neighbour.
        both = small.unionByName(small.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.first("node")).alias("low"))
        large = both.where("root > node").join(least, "node").select(F.col("root").alias("node"), F.col("low").alias("root")).distinct()
        after = stored(large, "stars")
        # Done when each node hangs on one root only and no root hangs on anything.
        open_ends = after.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").isEmpty() and after.join(after.select(F.col("node").alias("root")), "root", "left_semi").isEmpty()
        edges = after
        if open_ends:
            break
    roots = edges.select(F.col("root").alias("node"), "root").distinct()
    return stored(edges.unionByName(roots), "roots")
