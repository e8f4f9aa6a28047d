"""Exact quantiles by selection: nothing is sorted, and no task has more than counts and the few values at the end."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellpub.sources.shared import kept

#: Bins of a span, and values that are few enough to be looked at.
BINS, FEW = 1024, 10_000


def exact_quantiles(rows: DataFrame, value: str, fractions: list[float]) -> list[float | None]:
    """The quantiles of all values that are not null, interpolated between neighbours; null for a table without values.

    Values are counted by bins of equal width between the least and the largest; for each rank that is wanted, the bin that holds it is the next span to be counted by bins, until
    it has few values or only one. Counts are combined before they are shuffled; the driver gets a row for each bin, and the few values of the last ones.
    """
    rows = kept(rows.select(F.col(value).cast("double").alias("v")).where("v is not null"), "values")
    n, least, most = rows.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(fractions)
    places = [f * (n - 1) for f in fractions]
    ranks = {int(r) for p in places for r in (math.floor(p), math.ceil(p))}
    found: dict[int, float] = {}
    # rank: (least, most, values, values below)
    spans = {r: (least, most, n, 0) for r in ranks}
    while spans:
        for r in [r for r, (a, b, _, _) in spans.items() if a == b]:
            found[r] = spans.pop(r)[0]
        few = {s for s in spans.values() if s[2] <= FEW}
        if few:
            inside = reduce(lambda a, b: a | b, [F.col("v").between(a, b) for a, b, _, _ in few])
            values = sorted(v for (v,) in rows.where(inside).collect())
            for r in [r for r, s in spans.items() if s in few]:
                a, b, _, below = spans.pop(r)
                found[r] = [v for v in values if a <= v <= b][r - below]
        if not spans:
            break
        wide = sorted(set(spans.values()))
        # Halves, as the width of a span may be more than a double holds.
        at = lambda a, b: F.least(F.lit(BINS - 1), F.floor((F.col("v") / 2 - a / 2) / (b / 2 - a / 2) * BINS)).cast("int")
        binned = F.array_compact(F.array(*[F.when(F.col("v").between(a, b), F.struct(F.lit(k).alias("span"), at(a, b).alias("bin"))) for k, (a, b, _, _) in enumerate(wide)]))
        counts = rows.select("v", F.explode(binned).alias("x")).groupBy("x.span", "x.bin").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect()
        for r, span in list(spans.items()):
            below = span[3]
            for c in sorted((c for c in counts if c.span == wide.index(span)), key=lambda c: c.bin):
                if r < below + c.n:
                    spans[r] = (c.a, c.b, c.n, below)
                    break
                below += c.n
    weighed = lambda p: found[int(p)] if p == int(p) else (math.ceil(p) - p) * found[math.floor(p)] + (p - math.floor(p)) * found[math.ceil(p)]
    return [weighed(p) for p in places]
