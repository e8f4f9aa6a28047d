"""Data contracts: each check returns its violations as rows, and a report counts them.

A check's rows are (item, n): what violates it and how often.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpub.functions.scalars import threshold_status
from cellpub.operators.quantiles import exact_quantiles
from cellpub.sources.shared import fixed_rows


def _rows(df: DataFrame, item: Column, n: Column | None = None) -> DataFrame:
    return df.select(item.cast("string").alias("item"), (F.lit(1) if n is None else n).cast("long").alias("n"))


def unique(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Keys (columns or expressions, all not null) that occur more than once."""
    key = F.concat_ws("|", *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys])
    present = reduce(lambda a, b: a & b, [(F.col(k) if isinstance(k, str) else k).isNotNull() for k in keys])
    return _rows(df.where(present).groupBy(key.alias("k")).count().where("count > 1"), F.col("k"), F.col("count"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return _rows(df.where(F.col(column).isNull()).agg(F.count("*").alias("n")).where("n > 0"), F.lit(column), F.col("n"))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    odd = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return _rows(odd.groupBy(column).count(), F.col(column), F.col("count"))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    lost = df.where(F.col(column).isNotNull()).join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")
    return _rows(lost.groupBy(column).count(), F.col(column), F.col("count"))


def expression(df: DataFrame, column: str, predicate: Column) -> DataFrame:
    bad = df.where(F.col(column).isNotNull() & ~predicate)
    return _rows(bad.groupBy(column).count(), F.col(column), F.col("count"))


def forbidden_columns(df: DataFrame, names: list[str]) -> DataFrame:
    found = sorted(c for c in df.columns if any(n in c.lower() for n in names))
    return fixed_rows(df.sparkSession, [(c, 1) for c in found], "item string, n long")


def reconcile(left: DataFrame, right: DataFrame, what: str) -> DataFrame:
    """A row if two one-number tables differ; n is the difference."""
    both = left.toDF("a").crossJoin(right.toDF("b"))
    return _rows(both.where("a <> b"), F.lit(what), F.abs(F.col("a") - F.col("b")))


def no_empty_month(calendar: DataFrame, facts: DataFrame) -> DataFrame:
    """Months of the calendar without a fact."""
    seen = calendar.join(facts.groupBy("month").agg(F.count("*").alias("c")), "month", "left").where("c is null")
    return _rows(seen, F.date_format("month", "yyyy-MM"))


def volume_drop(series: DataFrame, least_share: float = 0.4) -> DataFrame:
    """Months below a share of the median month; n is the month's value."""
    (median,) = exact_quantiles(series, "value", [0.5])
    low = series.where(F.col("value") < F.lit(least_share) * F.lit(median).cast("double"))
    return _rows(low, F.date_format("month", "yyyy-MM"), F.col("value"))


def vintages_covered(used: DataFrame, known: DataFrame, column: str) -> DataFrame:
    return _rows(used.select(column).distinct().join(known, column, "left_anti"), F.col(column))


def future_dates(df: DataFrame, column: str, reference: Column) -> DataFrame:
    late = df.where(F.col(column) > reference)
    return _rows(late.groupBy(column).count(), F.col(column), F.col("count"))


def freshness(loaded: DataFrame, reference: Column, warn_days: int, error_days: int) -> DataFrame:
    """source, last, age_days, status for ``loaded(source, at)``."""
    rows = loaded.groupBy("source").agg(F.max("at").alias("last")).withColumn("age_days", F.datediff(reference, F.col("last")))
    status = F.when(F.col("age_days") > error_days, "error").when(F.col("age_days") > warn_days, "warn").otherwise("pass")
    return rows.withColumn("status", status)


@dataclass(frozen=True)
class Rule:
    """A check by what tables add to the groups of its items: rows of the left and of the right side. ``parts``: (table, side, item, rows that add one).

    ``kind`` says which groups violate it, given n rows on the left and m on the right, and how many rows fail:
    repeated (n > 1: n), any (n > 0: n), orphan (n > 0, m = 0: n), uncovered (n > 0, m = 0: 1), empty (n = 0, m > 0: 1), differ (n <> m: the difference),
    low (n below ``share`` of the median n of the check's groups, which should be few: n).
    """

    name: str
    severity: str
    kind: str
    parts: tuple[tuple[str, str, Column, Column], ...]
    share: float | None = None


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def unique_rule(name: str, table: str, *keys: Column | str, severity: str = "error") -> Rule:
    present = reduce(lambda a, b: a & b, [_text(k).isNotNull() for k in keys])
    return Rule(name, severity, "repeated", ((table, "left", F.concat_ws("|", *map(_text, keys)), present),))


def not_null_rule(name: str, table: str, column: str, value: Column | None = None, severity: str = "error") -> Rule:
    return Rule(name, severity, "any", ((table, "left", F.lit(column), (F.col(column) if value is None else value).isNull()),))


def value_rule(name: str, table: str, value: Column | str, holds: Column, severity: str = "error") -> Rule:
    """Accepted values, expressions, dates: values that are not null must satisfy ``holds``."""
    return Rule(name, severity, "any", ((table, "left", _text(value), _text(value).isNotNull() & ~holds),))


def reference_rule(name: str, child: tuple[str, Column | str], parent: tuple[str, Column | str, Column], kind: str = "orphan", severity: str = "error") -> Rule:
    """Values of (table, column) that none of (table, column, rows that count) has; or, of kind ``empty``, those of the second that the first lacks."""
    (left, own), (right, its, counts) = child, parent
    return Rule(name, severity, kind, ((left, "left", _text(own), _text(own).isNotNull()), (right, "right", _text(its), _text(its).isNotNull() & counts)))


def check_report(tables: dict[str, DataFrame], rules: list[Rule], known: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """check, severity, violations, failing_rows, status; checks of severity warn don't block. ``known``: checks that need no rows, as (severity, violations).

    Each table is read once: a row adds to the groups (check, item) of all its rules, counts are combined before the one shuffle, and groups are judged by kind.
    """
    spark = next(iter(tables.values())).sparkSession
    parts: dict[str, list[Column]] = {}
    for number, rule in enumerate(rules):
        for table, side, item, counts in rule.parts:
            parts.setdefault(table, []).append(F.when(counts, F.struct(F.lit(number).alias("rule"), item.alias("item"), F.lit(side == "left").alias("left"))))
    # What a row does not add is dropped after the explode: that is compiled, array functions with lambdas are not.
    rows = reduce(lambda a, b: a.unionByName(b), [tables[t].select(F.explode(F.array(*adds)).alias("x")).where("x is not null").select("x.*") for t, adds in parts.items()])
    groups = rows.groupBy("rule", "item").agg(F.count_if("left").alias("n"), F.count_if(~F.col("left")).alias("m"))
    kinds = fixed_rows(spark, [(i, r.name, r.severity, r.kind, r.share) for i, r in enumerate(rules)], "rule int, check string, severity string, kind string, share double")
    judged = groups.join(F.broadcast(kinds.select("rule", "check", "kind")), "rule")
    n, m, kind = F.col("n"), F.col("m"), F.col("kind")
    bad = F.when(kind == "repeated", n > 1).when(kind == "any", n > 0).when(kind.isin("orphan", "uncovered"), (n > 0) & (m == 0)).when(kind == "empty", (n == 0) & (m > 0)).when(kind == "differ", n != m).otherwise(False)
    weight = F.when(kind.isin("uncovered", "empty"), F.lit(1)).when(kind == "differ", F.abs(n - m)).otherwise(n)
    low = F.when(kind == "low", n)
    found = judged.groupBy("check").agg(F.count_if(bad).alias("violations"), F.sum(F.when(bad, weight)).alias("failing_rows"), F.collect_list(low).alias("ns"), F.median(low).alias("median"))
    report = F.broadcast(kinds).join(found, "check", "left").withColumn("low", F.filter("ns", lambda x: x < F.col("share") * F.col("median")))
    is_low = F.col("kind") == "low"
    report = report.select(
        "check", "severity", F.coalesce(F.when(is_low, F.size("low")).otherwise(F.col("violations")), F.lit(0)).cast("long").alias("violations"),
        F.coalesce(F.when(is_low, F.aggregate("low", F.lit(0).cast("long"), lambda t, x: t + x)).otherwise(F.col("failing_rows")), F.lit(0)).cast("long").alias("failing_rows"),
    )
    if known:
        report = report.unionByName(fixed_rows(spark, [(name, severity, k, k) for name, (severity, k) in known.items()], report.schema))
    return report.withColumn("status", F.when(F.col("violations") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))


def quality_metrics(inputs: list[tuple[str, DataFrame, dict[str, tuple[Column, float | None, str]]]]) -> DataFrame:
    """source, metric, value, threshold, sense, status. Each input is read once: all its metrics are aggregates of one row, which is then stacked."""
    parts = []
    for source, df, metrics in inputs:
        row = df.agg(*[c.cast("double").alias(name) for name, (c, _, _) in metrics.items()])
        stacked = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("value"), F.lit(t).cast("double").alias("threshold"), F.lit(sense).alias("sense")) for name, (_, t, sense) in metrics.items()])
        parts.append(row.select(F.lit(source).alias("source"), F.explode(stacked).alias("m")).select("source", "m.*"))
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.withColumn("status", threshold_status(F.col("value"), F.col("threshold"), F.col("sense")))


def latest_runs(log: DataFrame) -> DataFrame:
    """source, status and the last entry of each: the last success and the last failure."""
    rank = F.row_number().over(Window.partitionBy("source", "status").orderBy(F.desc("ended"), F.desc("run")))
    return log.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
