"""Best-fit packing into bins of several permitted lengths.

Documents longer than the longest bin are cut into full bins and a rest, which drops nothing. Items are dealt to
shards by their place in the order of (document, part), so a shard has a bounded number of items whatever their ids are. Each is packed by itself: the job
scales with the number of shards, and each shard ends with a few bins that are not full.

A bin costs a fixed part (what a sequence costs whatever its length), its length, and a part that grows with the square of it (attention). So a
longer bin may be cheaper for each token, or dearer, and what is cheapest depends on how well the items fill it.

In a shard, items go in order of falling length to the open bin that they leave least room in. If none has room, a
bin is opened: of the lengths in use that hold the item, the one of least cost for each token that it can
still get. The lengths in use are chosen jointly: the shard is packed with each set of permitted lengths that holds its longest item, each
bin is downsized to the smallest permitted length that holds its contents, and the packing of least total cost is taken.

Defined cases: null text and texts without words have no items and give one row with null bin; repeated rows and rows with null ids are
packed as often as they occur; items of one length go in the order of id (null last) and part, and of two bins with equal room the one that got it last is taken;
very long texts are cut as above; other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpub.llm.common import running_sum, sorted_table, stored, word_count

#: Parameters: permitted lengths, items in a shard, and the parts of the cost that do not depend on a bin's length and that grow with its square.
LENGTHS, SHARD, FIXED, SQUARE_PER_TOKEN = (512, 1024, 2048, 4096), 25_000, 256, 1 / 16384


def cost(length: int) -> float:
    return FIXED + length + SQUARE_PER_TOKEN * length * length


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = LENGTHS, shard: int = SHARD) -> DataFrame:
    """doc_id, part, start, n_tokens, bin_shard, bin, place, bin_length, bin_used: one row for each item."""
    longest = max(lengths)
    rows = docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / longest)).cast("int")
    items = rows.select("doc_id", "n", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    start = F.col("part").cast("long") * longest
    items = stored(items.select("doc_id", "part", start.alias("start"), F.least(F.lit(longest), F.col("n") - start).cast("int").alias("n_tokens")), "items")
    full = items.where("n_tokens > 0")
    shards = max(1, -(-full.count() // shard))
    # Items of equal rows are alike, so it does not matter which of them has which place.
    placed = running_sum(sorted_table(full.withColumns({"piece": F.col("part"), "one": F.lit(1)}).drop("part"), ["doc_id", "piece", "n_tokens"], "places"), "one", "nth")
    dealt = placed.select("doc_id", F.col("piece").alias("part"), "start", "n_tokens", F.pmod("nth", F.lit(shards)).cast("int").alias("bin_shard"))
    bins = ("bin", "place", "bin_length", "bin_used")
    schema = f"doc_id {dict(items.dtypes)['doc_id']}, part int, start long, n_tokens int, bin_shard int, " + ", ".join(f"{c} int" for c in bins)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["n_tokens", "doc_id", "part"], ascending=[False, True, True], kind="stable", na_position="last").reset_index(drop=True)
        found = best_packing(frame["n_tokens"].to_numpy(), sorted(lengths))
        return frame.assign(**dict(zip(bins, found, strict=True)))[["doc_id", "part", "start", "n_tokens", "bin_shard", *bins]]

    empty = items.where("n_tokens <= 0").select("doc_id", "part", "start", "n_tokens", *[F.lit(None).cast("int").alias(c) for c in ("bin_shard", *bins)])
    return dealt.groupBy("bin_shard").applyInPandas(pack, schema).unionByName(empty)


def best_packing(sizes: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, ...]:
    """bin, place in the bin, and the bin's length and contents, for sizes in falling order."""
    longest = int(sizes[0]) if len(sizes) else 0
    sets = [s for n in range(1, len(lengths) + 1) for s in combinations(lengths, n) if s[-1] >= longest]
    found = [best_fit(sizes, list(s)) for s in sets]
    totals = [sum(cost(lengths[bisect_left(lengths, u)]) for u in used) for _, _, used in found]
    bins, places, used = found[int(np.argmin(totals))]
    used = np.array(used, dtype=np.int32)
    downsized = np.array(lengths, dtype=np.int32)[np.searchsorted(lengths, used)] if len(used) else used
    return bins, places, downsized[bins], used[bins]


def best_fit(sizes: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """bin, place and contents of bins, with bins of some lengths. Open bins hang on their room; bit r is set where room r has any."""
    left = int(sizes.sum())
    rooms: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]
    bits = 0
    bins, places = np.zeros(len(sizes), dtype=np.int32), np.zeros(len(sizes), dtype=np.int32)
    used: list[int] = []
    inside: list[int] = []
    # Lengths in the order of cost for each token as long as enough is left to fill them.
    by_cost = sorted(lengths, key=lambda x: (cost(x) / x, x))
    for i, size in enumerate(sizes.tolist()):
        wide_enough = bits >> size
        if wide_enough:
            room = size + (wide_enough & -wide_enough).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                bits &= ~(1 << room)
        else:
            if left >= lengths[-1]:
                room = next(x for x in by_cost if x >= size)
            else:
                room = min((x for x in lengths if x >= size), key=lambda x: (cost(x) / min(x, left), x))
            b = len(used)
            used.append(0)
            inside.append(0)
        bins[i], places[i] = b, inside[b]
        used[b] += size
        inside[b] += 1
        left -= size
        if rest := room - size:
            rooms[rest].append(b)
            bits |= 1 << rest
    return bins, places, used
