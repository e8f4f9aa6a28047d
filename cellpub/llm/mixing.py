"""Mixing sources to target weights by entropy balancing.

Each document has a rate between 0 and ``MOST`` copies. Among all rates that meet every source's token
target, those of largest (bounded) entropy around one copy each are, by the convex dual,

    rate = MOST / (1 + (MOST - 1) exp(-lambda x)),   x = size / mean size of the source,

with one multiplier lambda for each source. Newton iterations find the multipliers of all sources at once: each is
one aggregation of the histogram (source, size), which is as small as the number of different sizes, however
many documents a source has. Steps that leave the bracket known so far are halved instead. Sums are exact
integers (rates count in billionths), so neither partitioning nor order changes a multiplier.

Rates become copies by systematic rounding along the sizes: up to every size, the copies of a source differ from its
rates by at most one half, so its tokens differ by at most half of its longest document. That rest is then worked off with
documents of the fitting size, the largest first. Which documents of a (source, size) cell
get the extra copy follows from a hash; as a cell may hold a third of all rows, it is ranked in buckets, whose number and whose rows both grow with
the square root of its rows only.

Defined cases: null text has size 0 and is never taken; a null source is a source of its own and comes last; repeated
rows are documents of their own; with no words at all, all targets are 0; very long texts count whole; an empty table gives an empty table;
other columns are not read, and ``take_copies`` passes them on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from cellpub.llm.common import content_key, hot_join, running_sum, sorted_table, stored, word_count

#: Parameters: weights by the rank of the source, share of all sizes in per cent, most copies of a document.
WEIGHTS, SHARE_PERCENT, MOST = (3, 1, 2), 150, 2
#: Rates count in units of 1 / UNIT. A source is through when its tokens are this near its target; more rounds than these are an error (brackets halve at least).
UNIT, TOLERANCE, ROUNDS = 1_000_000_000, 1e-6, 80
#: A cell of n rows is ranked in sqrt(n) / NARROW buckets of NARROW * sqrt(n) rows.
NARROW = 4


def source_key(source_col: str) -> Column:
    """Not null, and sorted as the sources are, with null last."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, content_key, source (a key), size, source_size, target, copies, taken of every row of ``docs``."""
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), content_key(F.col(text_col)).alias("content_key"), source_key(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes")
    cells = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    sources = targets(cells)
    rates = balanced(cells, sources)
    taken = corrected(rounded(rates))

    buckets = F.ceil(F.sqrt(F.col("n").cast("double")) / NARROW)
    place = F.xxhash64("doc_id", "content_key")
    # Rows of a cell with very many of them stay where they are.
    ranked = hot_join(rows, taken.withColumn("group_rows", F.col("n")), ["source", "size"]).drop("group_rows").withColumns({"place": place, "bucket": F.pmod(place, buckets)})
    in_bucket = Window.partitionBy("source", "size", "bucket").orderBy("place", "doc_id")
    sizes = ranked.groupBy("source", "size", "bucket").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each bucket; a cell of one bucket needs none.
    offsets = sizes.where("bucket > 0 or rows > 0").withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).where("before > 0").select("source", "size", "bucket", "before")
    ranked = ranked.withColumn("rank", F.row_number().over(in_bucket)).join(offsets, ["source", "size", "bucket"], "left")
    copies = F.col("whole") + (F.col("rank") + F.coalesce("before", F.lit(0)) <= F.col("extra")).cast("long")
    return ranked.select("doc_id", "content_key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns stay. Documents without words go."""
    found = mixed_documents(docs, id_col, text_col, source_col)
    # Repeated rows of one id, text and source take the sum of their copies; a row of another source is one of its own.
    key = source_key(source_col)
    copies = found.groupBy("doc_id", "content_key", "source").agg(F.sum("copies").alias("__copies")).where("__copies > 0").toDF("__id2", "__key2", "__source2", "__copies")
    columns = docs.columns
    keyed = docs.withColumns({"__id": F.col(id_col), "__key": content_key(F.col(text_col)), "__source": key}).dropDuplicates(["__id", "__key", "__source"])
    joined = keyed.join(copies, keyed["__id"].eqNullSafe(copies["__id2"]) & (keyed["__key"] == copies["__key2"]) & (keyed["__source"] == copies["__source2"]))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*columns)


def targets(cells: DataFrame) -> DataFrame:
    """source, source_size, target, full: shares by weight, none above ``MOST`` times the source's size; stored.

    Sources above their limit stop there and the level of the others rises, until none is above. The
    level is one number; each round aggregates the table of sources to two sums.
    """
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("docs"))
    ordered = running_sum(sorted_table(sizes.withColumn("one", F.lit(1)), ["source"], "sources"), "one", "place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    sources = stored(ordered.select("source", "source_size", "docs", weight.cast("double").alias("weight"), (MOST * F.col("source_size")).cast("double").alias("most")), "weights")
    level, above = 0.0, -1
    while True:
        over = F.col("most") < F.col("weight") * level
        sums = sources.agg(
            F.sum("source_size").alias("all"), F.count_if(over).alias("over"),
            F.sum(F.when(over, 2 * F.col("source_size") * MOST).otherwise(0)).alias("double_taken"), F.sum(F.when(~over, F.col("weight")).otherwise(0)).alias("weights"),
        ).first()
        if not sums["all"] or sums["over"] == above or not sums["weights"]:
            break
        above = sums["over"]
        level = (sums["all"] * SHARE_PERCENT / 100 - sums["double_taken"] / 2) / sums["weights"]
    target = F.least("most", F.col("weight") * F.lit(level))
    return stored(sources.select("source", "source_size", "docs", target.alias("target"), (F.col("most") <= target).alias("full")), "targets")


def rate(multiplier: Column, x: Column) -> Column:
    # Beyond 700 the exponential leaves the range of doubles; the rate is 0 or MOST long before.
    return F.lit(float(MOST)) / (1 + (MOST - 1) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -multiplier * x))))


def _counted(rows: DataFrame, what: Column, name: str) -> tuple[DataFrame, int]:
    """``rows``, stored, and how many of them are so, counted as they are written. Tasks that ran twice may count twice, but never some as none."""
    seen = Observation(name)
    rows = stored(rows.observe(seen, F.count_if(what).alias("n")), name)
    return rows, seen.get["n"]


def balanced(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """The cells with the columns of their source and ``rate`` in billionths; stored."""
    mean = F.col("source_size") / F.col("docs")
    none = F.lit(None).cast("double")
    state = sources.select("*", F.lit(0.0).alias("multiplier"), none.alias("low"), none.alias("high"), (F.col("full") | (F.col("source_size") == 0)).alias("through"))
    state, left = _counted(state, ~F.col("through"), "state")
    x = F.col("size") / mean
    for k in range(ROUNDS + 1):
        if not left:
            break
        if k == ROUNDS:
            raise ArithmeticError(f"multipliers are not found after {ROUNDS} rounds")
        r = rate(F.col("multiplier"), x)
        tokens = (F.col("n") * F.col("size")).cast("decimal(20,0)")
        whole = lambda c: (c * UNIT).cast("long").cast("decimal(12,0)")
        going = cells.where("size > 0").join(state.where(~F.col("through")), "source")
        sums = going.groupBy("source").agg(F.sum(tokens * whole(r)).alias("tokens"), F.sum(tokens * whole(F.least(x, F.lit(1000.0)) * r * (1 - r / MOST))).alias("slope"))
        now = state.join(sums, "source", "left")
        gap = F.col("tokens").cast("double") / UNIT - F.col("target")
        near = F.abs(gap) <= TOLERANCE * F.col("source_size")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("multiplier")).otherwise(F.col("high"))
        now = now.withColumns({"gap": gap, "near": near, "low": low, "high": high})
        # No step is longer than the way so far (and 4): the dual is flat where rates are near 0 or MOST.
        longest = 4 + F.abs("multiplier")
        step = F.when(F.col("slope") > 0, F.col("gap") * UNIT / F.col("slope").cast("double")).otherwise(F.signum("gap") * longest)
        newton = F.col("multiplier") - F.greatest(-longest, F.least(longest, step))
        inside = (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high")))
        next_one = F.when(F.col("through") | F.col("near"), F.col("multiplier")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        now = now.select(*[c for c in state.columns if c not in ("multiplier", "through")], next_one.alias("multiplier"), (F.col("through") | F.col("near")).alias("through"))
        state, left = _counted(now, ~F.col("through"), "state")
    state = state.select("source", "source_size", "docs", "target", "full", "multiplier")
    r = F.when(F.col("full"), F.lit(MOST * UNIT)).otherwise((rate(F.col("multiplier"), x) * UNIT).cast("long"))
    return stored(cells.join(state, "source").select("source", "size", "n", "source_size", "target", F.when(F.col("size") > 0, r).otherwise(0).cast("long").alias("rate")), "rates")


def rounded(rates: DataFrame) -> DataFrame:
    """The cells with ``whole`` copies of every document and ``extra`` documents that get one more."""
    part = (F.col("rate") % UNIT).cast("decimal(20,0)") * F.col("n").cast("decimal(17,0)")
    before = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    cells = rates.withColumn("part", part)
    cells = cells.withColumn("start", F.coalesce(F.sum("part").over(before).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")) + F.lit(UNIT // 2))
    up_to = lambda c: F.floor(c / F.lit(UNIT).cast("decimal(10,0)")).cast("long")
    extra = up_to(F.col("start") + F.col("part")) - up_to(F.col("start"))
    return cells.select("source", "size", "n", "source_size", "target", F.floor(F.col("rate") / UNIT).cast("long").alias("whole"), extra.alias("extra"))


def corrected(cells: DataFrame) -> DataFrame:
    """Changes ``extra`` so that each source's tokens come nearer its target: in each round, in the cell of the largest size that is no more than the gap.

    Each round makes the gap of every source that has such a cell smaller, so the rounds end; mostly they are two or three.
    """
    cells = stored(cells, "extra")
    while True:
        tokens = F.sum((F.col("whole") * F.col("n") + F.col("extra")) * F.col("size"))
        gaps = cells.groupBy("source").agg((F.round(F.first("target")).cast("long") - tokens).alias("gap")).where("gap <> 0")
        free = F.when(F.col("gap") > 0, F.col("n") - F.col("extra")).otherwise(F.col("extra"))
        fitting = cells.where(f"size > 0 and whole < {MOST}").join(gaps, "source").withColumn("free", free).where("free > 0 and size <= abs(gap)")
        step = fitting.groupBy("source").agg(F.max(F.struct("size", "free", "gap")).alias("m")).select("source", "m.*")
        changes = F.least("free", F.floor(F.abs("gap") / F.col("size")).cast("long")) * F.signum("gap").cast("long")
        step = step.select("source", "size", changes.alias("change"))
        after = cells.join(step, ["source", "size"], "left").withColumn("change", F.coalesce("change", F.lit(0)))
        after, changed = _counted(after.withColumn("extra", F.col("extra") + F.col("change")), F.col("change") != 0, "extra")
        if not changed:
            return cells
        cells = after.drop("change")
