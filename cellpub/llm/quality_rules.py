"""Quality rules at two levels: rules on each document, and verdicts on its host.

1. Each document is measured once (column expressions only) and the measures are stored without the text.
2. Rule failures are counted by host (``source``). The counts are combined before the shuffle, so a host with
   a third of all rows is a few rows there.
3. The hosts' failure rates have an empirical Beta(a, b) prior, fitted by moments over all hosts; a host's
   shrunken rate is (failures + a) / (documents + a + b). Small hosts so stay near the common rate.
4. The verdict is joined back: a document goes if its host's shrunken rate is at least ``HOST_RATE``. Where the
   host's rate is lower, a document goes only on its own failures, and the larger the host's rate, the fewer are
   needed: two of the rules below, or one where the host's rate is at least ``WATCH_RATE``.

Defined cases: null text counts as empty (no words, so it fails the base rule); a null host is a host
of its own; repeated rows count as often as they occur; a rate of exactly ``HOST_RATE`` rejects and one of exactly ``WATCH_RATE`` watches, and a
document at a limit passes; very long texts are measured whole; other columns are read by ``keep_good`` only, which keeps them under whatever
name; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpub.llm.common import BROADCAST_ROWS, hot_join, small_enough, stored, text_or_empty
from cellpub.llm.text_stats import SYMBOLS, n_dup_lines, n_matches, with_repeat_words, word_chars, words_of

#: Fixed values of the contract.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Parameters: per cent of symbols in the characters of words, duplicate lines against 100 words, rates of hosts.
MAX_SYMBOL_PERCENT, MAX_DUP_LINES_PER_100_WORDS = 10, 5
HOST_RATE, WATCH_RATE = 0.5, 0.02


def measured(docs: DataFrame, carry: list[str], text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``carry`` and the measures and failures of each document, stored."""
    text = text_or_empty(text_col)
    rows = docs.select(*[F.col(c).alias(f"own_{i}") for i, c in enumerate(carry)], F.col(host_col).alias("host"), text.alias("text"), words_of(text).alias("words"))
    rows = with_repeat_words(rows)
    rows = rows.select(
        *[f"own_{i}" for i in range(len(carry))],
        # A null host has a key of its own, so that all joins are plain equalities.
        F.coalesce(F.concat(F.lit("s"), F.col("host").cast("string")), F.lit("t")).alias("host"),
        F.size("words").cast("long").alias("n_words"),
        word_chars(F.col("text")).alias("word_chars"),
        n_matches(F.col("text"), SYMBOLS).alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"),
        "n_repeat_words",
    )
    return stored(rows.withColumns(failures()), "measured")


def failures() -> dict[str, Column]:
    fails = {
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "symbols_failed": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "lines_failed": 100 * F.col("n_dup_lines") > MAX_DUP_LINES_PER_100_WORDS * F.col("n_words"),
    }
    return fails | {"n_failed": sum(f.cast("int") for f in fails.values())}


def host_verdicts(rows: DataFrame) -> DataFrame:
    """host, n_docs, n_failing, host_rate (shrunken): one row for each host."""
    hosts = rows.groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if(F.col("n_failed") > 0).alias("n_failing"))
    hosts = stored(hosts, "hosts")
    rate = F.col("n_failing") / F.col("n_docs")
    m = hosts.agg(
        F.count("*").alias("hosts"), F.sum("n_docs").alias("docs"), F.sum("n_failing").alias("failing"),
        F.sum("n_failing").cast("double").alias("f"), F.avg(rate).alias("mean"), F.var_samp(rate).alias("var"), F.avg(1 / F.col("n_docs")).alias("inverse"),
    ).first()
    a, b = beta_prior(m["hosts"], m["docs"] or 0, m["failing"] or 0, m["mean"] or 0.0, m["var"] or 0.0, m["inverse"] or 0.0)
    return hosts.withColumn("host_rate", (F.col("n_failing") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b)))


def beta_prior(hosts: int, docs: int, failing: int, mean: float, var: float, inverse: float) -> tuple[float, float]:
    """Moments of the hosts' rates, less what sampling alone would spread them.

    With m = a / (a + b), the variance of an observed rate is v + (m(1 - m) - v) E[1/n], where v is that of the true rates.
    Hosts that differ by no more than chance get the strongest prior: as many documents as all hosts have.
    """
    if not hosts:
        return 1.0, 1.0
    m = (failing + 0.5) / (docs + 1.0) if not 0 < mean < 1 else mean
    spread = m * (1 - m)
    true_var = (var - spread * inverse) / (1 - inverse) if inverse < 1 else 0.0
    strength = spread / true_var - 1 if true_var > spread / (docs + 1.0) else float(docs)
    strength = max(strength, 1e-3)
    return m * strength, (1 - m) * strength


def judged(rows: DataFrame) -> DataFrame:
    """The measured rows with ``host_rejected`` and ``kept``. Verdicts are broadcast where a count shows that they may be; beyond that, rows of the hot hosts stay where they are."""
    verdicts = host_verdicts(rows).select("host", F.col("n_docs").alias("group_rows"), (F.col("host_rate") >= HOST_RATE).alias("host_rejected"), (F.col("host_rate") >= WATCH_RATE).alias("watched"))
    needed = F.when(F.col("watched"), 1).otherwise(2)
    kept = ~F.col("base_failed") & ~F.col("host_rejected") & (F.col("n_failed") < needed)
    joined = rows.join(F.broadcast(verdicts), "host") if small_enough(verdicts, BROADCAST_ROWS) else hot_join(rows, verdicts, ["host"])
    return joined.withColumn("kept", kept)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    rows = judged(measured(docs, [id_col], text_col, host_col))
    return rows.select(F.col("own_0").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "symbols_failed", "lines_failed", "host_rejected")


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. They are stored beside their measures, so the text is read once."""
    rows = judged(measured(docs, docs.columns, text_col, host_col)).where("kept")
    return rows.select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns)])
