"""Series, rankings and rates derived from published cells. ``value`` is null where masked; a key that is absent is not there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpub.operators.quantiles import exact_quantiles


def relative_change(value: Column, base: Column) -> Column:
    """value / base - 1; null if either is null or the base is 0."""
    return F.when(base != 0, value / base - 1)


def year_over_year(series: DataFrame, keys: list[str]) -> DataFrame:
    """Each month with the same month a year before, by date and not by position, so gaps don't shift it."""
    before = series.select(*keys, F.add_months("month", 12).alias("month"), F.col("value").alias("before"))
    return series.join(before, [*keys, "month"], "left").withColumn("change", relative_change(F.col("value"), F.col("before")))


def last_n_final(series: DataFrame, keys: list[str], n: int = 24) -> DataFrame:
    """The last n months of each series that are final."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("month")))
    return series.where("status = 'final'").withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def isolated_points(series: DataFrame, keys: list[str]) -> DataFrame:
    """Values whose neighbours in the series are both null or absent."""
    w = Window.partitionBy(*keys).orderBy("month")
    beside = [F.when(f("month").over(w) == F.add_months("month", by), f("value").over(w)) for f, by in ((F.lag, -1), (F.lead, 1))]
    return series.withColumns({"__a": beside[0], "__b": beside[1]}).where("value is not null and __a is null and __b is null").drop("__a", "__b")


def atypical_months(series: DataFrame, keys: list[str], times: float = 2.0) -> DataFrame:
    """Months above ``times`` the median of their series, which has a row a month."""
    medians = series.groupBy(*keys).agg(F.median("value").alias("median"))
    return series.join(medians, keys).where(F.col("value") > times * F.col("median"))


def quantile_classes(rates: DataFrame, value: str = "rate", classes: int = 5) -> DataFrame:
    """Class 1 to ``classes`` of each positive rate, by the quantiles of all."""
    positive = rates.where(F.col(value) > 0)
    bounds = exact_quantiles(positive, value, [i / classes for i in range(1, classes)])
    return positive.withColumn("class", sum((F.when(F.col(value) > F.lit(b).cast("double"), 1).otherwise(0) for b in bounds), F.lit(1)))


def headline(windows: DataFrame, keys: list[str], last: str, before: str) -> DataFrame:
    """The last window's value, the one before and the change; null where masked or uncovered."""
    pick = lambda w: F.max(F.when(F.col("window") == w, F.col("value")))
    return windows.groupBy(*keys).agg(pick(last).alias("value"), pick(before).alias("before")).withColumn("change", relative_change(F.col("value"), F.col("before")))


def top_k(rows: DataFrame, keys: list[str], value: str, tie: str, k: int) -> DataFrame:
    """The k largest values of each key (of all for no keys) that are not masked, with rank and the number of masked rows of the key."""
    hidden = rows.groupBy(*keys).agg(F.count_if(F.col(value).isNull()).alias("masked"))
    if not keys:
        best = rows.where(F.col(value).isNotNull()).orderBy(F.desc(value), tie).limit(k)
        # k rows: ranked in one small task.
        return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(value), tie))).crossJoin(F.broadcast(hidden))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(value), tie))
    return rows.where(F.col(value).isNotNull()).withColumn("rank", rank).where(F.col("rank") <= k).join(hidden, keys)


def rank_areas(windows: DataFrame, population: DataFrame, last: str, before: str) -> DataFrame:
    """area, value, before, change, per_1000 and rank by value, nulls last."""
    rows = headline(windows, ["area"], last, before).join(population, "area")
    rows = rows.withColumn("per_1000", F.when(F.col("population") > 0, F.col("value") * 1000 / F.col("population")))
    # A row for each area: a dimension.
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("value"), "area")))


def latest_ranked(rows: DataFrame, vintage: str, value: str, *ties: str) -> DataFrame:
    """Rows of the latest vintage in falling order of the value, masked (null) ones last. The latest vintage is one number."""
    last = rows.agg(F.max(vintage).alias("__last"))
    return rows.join(F.broadcast(last), F.col(vintage) == F.col("__last")).drop("__last").orderBy(F.desc_nulls_last(value), *ties)


def sector_table(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Sectors with labels; members of unknown division take their section's, open zeros go, masked ones stay."""
    named = cells.join(labels.toDF("sector", "label"), "sector", "left")
    parent = labels.toDF("__section", "__label")
    unknown = F.when(F.col("sector").endswith("_ND"), F.regexp_replace("sector", "_ND$", ""))
    named = named.withColumn("__of", unknown).join(parent, F.col("__of") == F.col("__section"), "left")
    label = F.coalesce("label", F.concat("__label", F.lit(" (not detailed)")), F.lit("unknown"))
    return named.withColumn("label", label).where("value is null or value <> 0").drop("__of", "__section", "__label")


def balance(entries: DataFrame, exits: DataFrame, keys: list[str]) -> DataFrame:
    """entries - exits; null if either is masked. Keys that one side lacks count as 0 there."""
    a = entries.select(*keys, F.col("value").alias("entries"), F.lit(True).alias("__a"))
    b = exits.select(*keys, F.col("value").alias("exits"), F.lit(True).alias("__b"))
    zero = lambda there, c: F.when(F.col(there).isNull(), F.lit(0).cast("long")).otherwise(F.col(c))
    rows = a.join(b, keys, "full").withColumns({"entries": zero("__a", "entries"), "exits": zero("__b", "exits")}).drop("__a", "__b")
    return rows.withColumn("balance", F.col("entries") - F.col("exits"))


def arg_max(rows: DataFrame, keys: list[str], value: str, item: str) -> DataFrame:
    """The item of the largest value of each key; of ties the smallest item."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(value), item))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def hash_sample(rows: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """n rows by the order of md5(key and seed): the same rows on every run."""
    return rows.withColumn("__h", F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)).cast("binary"))).orderBy("__h", key).limit(n).drop("__h")
