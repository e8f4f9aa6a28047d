"""Policy over scored labels: assign a division, else a section, else nothing; and how well that does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NONE = "ZZ"


def select_unlabelled(events: DataFrame, perimeter: DataFrame, kinds: list[str]) -> DataFrame:
    """Events inside the perimeter, of publishable kinds, with text and without a register code."""
    return events.where(F.col("code").isNull() & (F.coalesce("text", F.lit("")) != "") & F.col("kind").isin(*kinds)).join(perimeter, "area", "left_semi")


def incremental_candidates(events: DataFrame, cache: DataFrame) -> DataFrame:
    """Events whose id and fingerprint are not in the cache."""
    return events.join(cache, ["id", "print"], "left_anti")


def label_table(sectors: DataFrame, divisions: DataFrame, sections: DataFrame) -> DataFrame:
    """Distinct divisions with their section and both labels."""
    return sectors.select("division", "section").distinct().join(divisions, "division").join(sections, "section")


def section_mass(scored: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """id, section, mass: probabilities summed by section; labels outside the hierarchy add nothing. Of equal masses the smaller section is on top."""
    shares = scored.select("id", F.explode("probabilities").alias("division", "p"))
    mass = shares.join(hierarchy.select("division", "section"), "division").groupBy("id", "section").agg(F.sum("p").alias("mass"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("mass"), "section"))
    return mass.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def hierarchical_decision(scored: DataFrame, hierarchy: DataFrame, t1: float = 0.9, t2: float = 0.8) -> DataFrame:
    """id, level ('division', 'section', 'none'), division, section for ``scored(id, division, confidence, probabilities)``."""
    return decided(with_mass(scored, hierarchy), F.lit(t1), F.lit(t2)).drop("confidence", "mass", "top_section", "own_section", "choice")


def with_mass(scored: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """What a decision needs: id, choice, confidence, own_section, top_section, mass."""
    own = hierarchy.select(F.col("division").alias("choice"), F.col("section").alias("own_section"))
    top = section_mass(scored, hierarchy).withColumnRenamed("section", "top_section")
    return scored.select("id", F.col("division").alias("choice"), "confidence").join(own, "choice", "left").join(top, "id", "left")


def decided(rows: DataFrame, t1, t2) -> DataFrame:
    level = F.when(F.col("choice") == NONE, "none").when(F.col("confidence") >= t1, "division").when(F.col("mass") >= t2, "section").otherwise("none")
    rows = rows.withColumn("level", level)
    section = F.when(F.col("level") == "division", F.col("own_section")).when(F.col("level") == "section", F.col("top_section"))
    return rows.withColumns({"division": F.when(F.col("level") == "division", F.col("choice")), "section": section})


def replace_in_cache(cache: DataFrame, new: DataFrame) -> DataFrame:
    """New decisions replace those of the same id."""
    return new.unionByName(cache.join(new.select("id").distinct(), "id", "left_anti"))


def _rounded(cond: Column) -> Column:
    return F.round(F.avg(cond.cast("int")), 3)


def with_truth(scored: DataFrame, hierarchy: DataFrame, truth: DataFrame) -> DataFrame:
    """What decisions need, with true_division and true_section, for the rows whose true division is in the hierarchy."""
    true = truth.toDF("id", "true_division").join(hierarchy.select(F.col("division").alias("true_division"), F.col("section").alias("true_section")), "true_division")
    return with_mass(scored, hierarchy).join(true, "id")


def policy_grid(scored: DataFrame, hierarchy: DataFrame, truth: DataFrame, grid: DataFrame) -> DataFrame:
    """By thresholds: shares and precision of each level, overall precision, share unassigned, to three decimals; null where a level is empty.

    ``grid``: t1, t2, a few rows, broadcast; the sample is read once for all of them.
    """
    rows = decided(with_truth(scored, hierarchy, truth).crossJoin(F.broadcast(grid)), F.col("t1"), F.col("t2"))
    right = F.when(F.col("level") == "division", F.col("division") == F.col("true_division")).when(F.col("level") == "section", F.col("section") == F.col("true_section"))
    at = lambda level: F.col("level") == level
    precision = lambda cond: _rounded(F.when(cond, right))
    return rows.groupBy("t1", "t2").agg(
        F.count("*").alias("n"), _rounded(at("division")).alias("share_division"), precision(at("division")).alias("precision_division"), _rounded(at("section")).alias("share_section"),
        precision(at("section")).alias("precision_section"), precision(~at("none")).alias("precision"), _rounded(at("none")).alias("share_none"),
    )


def calibration(scored: DataFrame, truth: DataFrame, bounds: tuple[float, ...] = (0.0, 0.3, 0.5, 0.7, 0.9)) -> DataFrame:
    """By the lower bound of confidence: rows and share of right divisions, to three decimals."""
    lower = F.array_max(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("confidence")))
    rows = scored.join(truth.toDF("id", "true_division"), "id").withColumn("from_confidence", lower)
    return rows.groupBy("from_confidence").agg(F.count("*").alias("n"), _rounded(F.col("division") == F.col("true_division")).alias("accuracy"))


def forced_accuracy(scored: DataFrame, hierarchy: DataFrame, truth: DataFrame) -> DataFrame:
    """Accuracy of the best division and of its section without a policy; a choice without a section is wrong. An empty sample is an error."""
    right = lambda a, b: F.avg(F.coalesce(F.col(a) == F.col(b), F.lit(False)).cast("int"))
    found = with_truth(scored, hierarchy, truth).agg(F.count("*").alias("n"), right("choice", "true_division").alias("division_accuracy"), right("own_section", "true_section").alias("section_accuracy"))
    return found.select(F.when(F.col("n") == 0, F.raise_error(F.lit("empty sample")).cast("long")).otherwise(F.col("n")).alias("n"), "division_accuracy", "section_accuracy")
