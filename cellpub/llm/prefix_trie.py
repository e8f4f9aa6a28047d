"""The trie of conversation prefixes, from sorted neighbours.

1. A conversation is the sequence of its turns' ids (128 bits of SHA-256 of role and text); texts stay behind. Conversations are sorted over all partitions by
   sequence and number, so the members of each trie node are neighbours, and those that end at a node come first among them.
2. In each partition, neighbours with a common prefix are an edge of that prefix's length. A union-find takes the edges in descending depth: where components meet, a
   branching node is made (or, at its own depth, joined), and components that end above it become its children. Nodes between a branching node and its parent have one child each.
3. Nodes on the way from the partition's first and last row to the root may have members elsewhere. They are left open: the forest is contracted to them, a few rows for each
   partition, and what hangs below is summed up. The same union-find merges these rows of all partitions across the boundaries, in one small task.

Ties of turns are in the order of their ids. Defined cases: rows with a null conversation are left out; a null turn comes first; a null role or text is empty; rows that are repeated are turns
of their own; texts of any length are read whole; a table without conversations has no node; of other columns, none is read.

Bounds: a conversation is one row of some 20 bytes a turn and its neighbour's, so one of tens of millions of turns fits a task; the numbers of a node where a third of all
conversations end go through one task, as SHA-256 reads them one after another, but as a stream of pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpub.llm.common import partitions, stored

#: Bytes of a turn's id.
ID = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

#: kind 'node': a node, with ``item`` for the open parent of its topmost ones; 'open': an item of a contracted forest; 'piece': numbers that end at an open item.
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
FOUND = f"kind string, part int, item int, {NODE}, chars array<int>, seq binary, ends string"
COLUMNS = [c.split()[0] for c in FOUND.split(", ")]
KINDS = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 7, pa.string(), pa.list_(pa.int32()), pa.binary(), pa.string()]


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // ID
    if n > 64 * ID:
        return int(np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))[0]) // ID
    k = 0
    while a[k : k + ID] == b[k : k + ID]:
        k += ID
    return k // ID


class Forest:
    """Components of neighbours, each the node of its depth so far. ``parent`` is the node that a finished component hangs below, ``joined`` the one it became part of."""

    def __init__(self) -> None:
        self.depth: list[int] = []
        self.n: list[int] = []
        self.least: list[int] = []
        self.children: list[int] = []
        self.leaves: list[int] = []
        self.saved: list[int] = []
        self.chars: list[list[int]] = []
        self.ends: list[str | None] = []  # SHA-256 of the numbers that end here
        self.pieces: list[list[tuple[int, int]]] = []  # or the (part, item)s whose pieces make it
        self.joined: list[int] = []
        self.parent: list[int] = []

    def add(self, depth: int, n: int, least: int, chars: list[int], children: int = 0, leaves: int = 0, saved: int = 0, ends: str | None = None, pieces: tuple = ()) -> int:
        for values, x in zip((self.depth, self.n, self.least, self.children, self.leaves, self.saved, self.chars, self.ends), (depth, n, least, children, leaves, saved, chars, ends)):
            values.append(x)
        self.pieces.append(list(pieces))
        self.joined.append(-1)
        self.parent.append(-1)
        return len(self.depth) - 1

    def node(self, x: int) -> int:
        """The node that ``x`` is part of."""
        top = x
        while self.joined[top] >= 0:
            top = self.joined[top]
        while self.joined[x] >= 0:
            self.joined[x], x = top, self.joined[x]
        return top

    def below(self, x: int, above: int) -> tuple[int, int]:
        """Leaves and saved code points that ``x`` and the chain over it, down from depth ``above``, add to a node there."""
        return self.leaves[x] if self.children[x] else 1, self.saved[x] + (self.n[x] - 1) * sum(self.chars[x][above : self.depth[x]])

    def hang(self, x: int, under: int) -> None:
        """Finish component ``x``: a child of ``under``."""
        leaves, saved = self.below(x, self.depth[under])
        self.parent[x] = under
        self.n[under] += self.n[x]
        self.least[under] = min(self.least[under], self.least[x])
        self.children[under] += 1
        self.leaves[under] += leaves
        self.saved[under] += saved

    def join(self, a: int, b: int) -> int:
        """Two parts of one node."""
        self.joined[b] = a
        self.n[a] += self.n[b]
        self.least[a] = min(self.least[a], self.least[b])
        for values in (self.children, self.leaves, self.saved):
            values[a] += values[b]
        self.ends[a] = self.ends[a] or self.ends[b]
        self.pieces[a] += self.pieces[b]
        return a

    def meet(self, a: int, b: int, depth: int) -> int:
        """The component of neighbouring ``a`` and ``b``, whose members share ``depth`` turns."""
        if self.depth[a] == depth == self.depth[b]:
            return self.join(a, b)
        under = a if self.depth[a] == depth else b if self.depth[b] == depth else self.add(depth, 0, min(self.least[a], self.least[b]), self.chars[a])
        for x in (a, b):
            if x != under:
                self.hang(x, under)
        return under

    def merged(self, items: list[int], edges: list[int]) -> int:
        """Take all edges between neighbouring items in descending depth; the last component is the answer."""
        group = list(range(len(items)))

        def find(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        top = list(items)  # component of each group, at its representative
        for k in sorted(range(len(edges)), key=lambda k: -edges[k]):
            a, b = find(k), find(k + 1)
            made = self.meet(top[a], top[b], edges[k])
            group[b] = a
            top[a] = made
        return top[find(0)]

    def rows(self, x: int, conv: int | None, item: tuple[int, int] | None, above: int) -> Iterator[tuple]:
        """The nodes of finished component ``x`` and of the chain over it, which ends below ``above``, the depth of its parent ``conv`` (or open ``item``)."""
        least, n, saved, leaves = self.least[x], self.n[x], self.saved[x], self.leaves[x] if self.children[x] else 1
        for depth in range(self.depth[x], above, -1):
            chars = self.chars[x][depth - 1]
            own, last = depth == self.depth[x], depth == above + 1
            saved += (n - 1) * chars
            ends = (None if self.pieces[x] else self.ends[x] or NO_ENDS) if own else NO_ENDS
            part, k = (item if item and last else (None, None)) if not (own and self.pieces[x]) else self.pieces[x][0]
            yield ("node", part, k, least, depth, conv if last else least, n, self.children[x] if own else 1, leaves, saved, ends, None, None, None)


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], names=COLUMNS)


def _in_batches(rows: Iterator[tuple], n: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == n:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _forest_of_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The finished nodes of a sorted partition, and its contracted forest."""
    part, forest, items, edges, runs = TaskContext.get().partitionId(), Forest(), [], [], []
    seqs: list[bytes] = []
    for batch in batches:
        ids = np.asarray(batch.column("conv_id"))
        for seq, chars, conv in zip(batch.column("seq").to_pylist(), batch.column("chars"), ids):
            if seqs and seq == seqs[-1]:
                runs[-1].append(conv)
                continue
            seqs.append(seq)
            runs.append([conv])
            items.append(chars)
    if not seqs:
        return
    runs = [np.array(r, dtype=np.int64) for r in runs]
    last = len(seqs) - 1
    items = [forest.add(len(seq) // ID, len(run), int(run[0]), chars.as_py(), ends=None if i in (0, last) else _digest(run)) for i, (seq, chars, run) in enumerate(zip(seqs, items, runs))]
    edges = [common_turns(a, b) for a, b in zip(seqs, seqs[1:])]
    top = forest.merged(items, edges)
    # From the first and the last row up to the top.
    ways = []
    for x in (items[0], items[last]):
        way = [forest.node(x)]
        while way[-1] != top:
            way.append(forest.node(forest.parent[way[-1]]))
        ways.append(way)
    left, right = ways
    order = left + right[-2::-1]
    item = {x: k for k, x in enumerate(order)}

    def found() -> Iterator[tuple]:
        for x in range(len(forest.depth)):
            if forest.joined[x] < 0 and x not in item:
                up = forest.node(forest.parent[x])
                yield from forest.rows(x, None if up in item else forest.least[up], (part, item[up]) if up in item else None, forest.depth[up])
        for x, k in item.items():
            # What hangs below an open node without the open ones.
            n, children, leaves, saved = forest.n[x], forest.children[x], forest.leaves[x], forest.saved[x]
            for y in item:
                if y != top and y != x and forest.node(forest.parent[y]) == x:
                    its_leaves, its_saved = forest.below(y, forest.depth[x])
                    n, children, leaves, saved = n - forest.n[y], children - 1, leaves - its_leaves, saved - its_saved
            seq = seqs[0] if k == 0 else seqs[last] if k == len(order) - 1 else None
            yield ("open", part, k, forest.least[x], forest.depth[x], None, n, children, leaves, saved, forest.ends[x], forest.chars[x][: forest.depth[x]], seq, None)
        for i in {0, last}:
            for k in range(0, len(runs[i]), 100_000):
                yield ("piece", part, item[forest.node(items[i])], None, k, *[None] * 8, ",".join(map(str, runs[i][k : k + 100_000].tolist())))

    yield from _in_batches(found())


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contracted forests of all partitions, in order, to the nodes that they left open and, as rows of kind 'open', the number each item has as a parent."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    forest, items, edges, places = Forest(), [], [], {}
    for r in rows:
        own = (r["part"], r["item"])
        first_or_last = r["seq"] is not None
        places[own] = forest.add(r["depth"], r["n_convs"], r["conv_id"], r["chars"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"], [own] if first_or_last and r["ends_sha256"] is None else ())
        items.append(places[own])
    for a, b in zip(rows, rows[1:]):
        edges.append(min(a["depth"], b["depth"]) if a["part"] == b["part"] else common_turns(a["seq"], b["seq"]))
    top = forest.merged(items, edges)
    if forest.depth[top]:
        root = forest.add(0, 0, forest.least[top], [])
        forest.hang(top, root)
        top = root

    def found() -> Iterator[tuple]:
        for x in range(len(forest.depth)):
            if forest.joined[x] < 0 and x != top:
                up = forest.node(forest.parent[x])
                yield from forest.rows(x, forest.least[up], None, forest.depth[up])
        pieces = forest.pieces[top]
        yield ("node", *(pieces[0] if pieces else (None, None)), forest.least[top], 0, None, forest.n[top], forest.children[top], forest.leaves[top] if forest.children[top] else 1, forest.saved[top], None if pieces else forest.ends[top] or NO_ENDS, None, None, None)
        for own, x in places.items():
            x = forest.node(x)
            yield ("open", *own, forest.least[x], *[None] * 10)
            first = forest.pieces[x][0] if forest.pieces[x] else own
            if own in forest.pieces[x]:  # the first of the items that the piece belongs to
                yield ("piece", *own, *first, *[None] * 9)

    yield from _in_batches(found())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each group's pieces joined by commas; a group's pieces follow each other."""
    now, state = None, None
    for batch in batches:
        out = []
        for part, item, ends in zip(*[batch.column(c).to_pylist() for c in ("to_part", "to_item", "ends")]):
            if (part, item) != now:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (part, item), hashlib.sha256(ends.encode())
            else:
                state.update(b"," + ends.encode())
        yield _hashes(out)
    if now is not None:
        yield _hashes([(*now, state.hexdigest())])


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string()))], names=["part", "item", "sha"])


def rebuilt(turns: DataFrame, head: Column, borrowed: Column) -> DataFrame:
    """conv_id, seq, chars: each conversation with its first ``borrowed`` turns (at most 5) taken from conversation ``head``.

    All conversations of a head are in one task; of the head, its first five turns are added to each row there.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    role = text("role")
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text("text")).cast("binary"), 256), 1, 2 * ID)
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("id"), F.length(text("text")).alias("chars"))
    rows = rows.withColumn("head", head).repartition("head")
    own = rows.groupBy("head", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "chars"))).alias("own"))
    first = own.where(F.col("conv_id") == F.col("head")).select("head", F.slice("own", 1, 5).alias("first"))
    both = own.join(first, "head", "left").withColumn("h", borrowed)
    tail = F.when(F.size("own") > F.col("h"), F.slice(F.col("own"), F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0))))
    whole = both.select("conv_id", F.concat(F.coalesce(F.slice(F.col("first"), F.lit(1), F.col("h")), F.slice("own", 1, 0)), F.coalesce(tail, F.slice("own", 1, 0))).alias("t"))
    return whole.select("conv_id", F.unhex(F.array_join("t.id", "")).alias("seq"), F.col("t.chars").alias("chars"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``conversations(conv_id, seq, chars)``."""
    spark = conversations.sparkSession
    rows = stored(conversations, "sequences")
    n = partitions(spark)
    parts = rows.repartitionByRange(n, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    found = stored(parts.mapInArrow(_forest_of_part, FOUND), "forests")
    # Some rows for each partition.
    open_ = found.where("kind = 'open'").repartition(1).sortWithinPartitions("part", "item")
    merged = stored(open_.mapInArrow(_across, FOUND), "merged")
    parents = F.broadcast(merged.where("kind = 'open'").select("part", "item", F.col("conv_id").alias("open_parent")))
    belongs = F.broadcast(merged.where("kind = 'piece'").select("part", "item", F.col("conv_id").cast("int").alias("to_part"), F.col("depth").cast("int").alias("to_item")))
    pieces = found.where("kind = 'piece'").select("part", "item", F.col("depth").alias("at"), "ends").join(belongs, ["part", "item"])
    hashes = pieces.repartition("to_part", "to_item").sortWithinPartitions("to_part", "to_item", "part", "item", "at").mapInArrow(_hashed, "part int, item int, sha string")
    names = [c.split()[0] for c in NODE.split(", ")]
    inner = found.where("kind = 'node'").join(parents, ["part", "item"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "open_parent"))
    outer = merged.where("kind = 'node'").join(F.broadcast(hashes), ["part", "item"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", "sha"))
    return inner.select(*names).unionByName(outer.select(*names))
