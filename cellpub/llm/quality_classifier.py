"""Quality classifier: a sparse rule ensemble.

1. Statistics of every whole text are column expressions, computed once and stored without the text.
2. Small trees are boosted on a bounded sample of labelled rows; every path from a root to a node is a rule, a conjunction of
   bounds on statistics.
3. A lasso logistic fit (proximal gradient steps) gives few rules a weight.
4. The rules are compiled to one column expression, and all rows are scored with it from the stored statistics.

Defined cases: null text counts as empty; empty texts have all statistics 0 and the score that the rules give those; repeated rows get
equal scores; null labels are not learnt from; without labels of both kinds every score is the mean label (0.5 without any); a score of exactly 0.3
is good; very long texts are measured whole; an empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpub.llm.common import stored, text_or_empty
from cellpub.llm.text_stats import SYMBOLS, n_dup_lines, n_matches, with_repeat_words, word_chars, words_of

#: Parameters: labelled rows learnt from at most, trees, their depth, candidate bounds of a statistic, least rows in a node, lasso penalty, steps.
SAMPLE, TREES, DEPTH, BOUNDS, LEAST, PENALTY, STEPS = 20_000, 24, 3, 24, 15, 0.002, 300
SHRINKAGE, SEED = 0.3, 7

Rule = tuple[tuple[int, bool, float], ...]


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id and the statistics as doubles, stored."""
    text, n = F.col("text"), F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    words, chars = F.col("words"), F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    rows = docs.select(F.col("doc_id"), text_or_empty(text_col).alias("text")).withColumn("words", words_of(text))
    rows = with_repeat_words(rows)
    rows = rows.select("doc_id", "text", "words", "n_repeat_words", F.size("words").alias("n_words"), word_chars(text).alias("word_chars"))
    next_same = F.filter(words, lambda w, i: w == F.get(words, i + 1))
    upper = n_matches(text, r"\p{Lu}")
    stats = {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "word_length": F.col("word_chars") / n,
        "symbols": n_matches(text, SYMBOLS) / chars,
        "dup_lines": n_dup_lines(text) / n,
        "repeated": F.col("n_repeat_words") / n,
        "same_as_next": F.size(next_same) / n,
        "different": F.size(F.array_distinct(words)) / n,
        "upper": upper / chars,
        "exclamations": n_matches(text, "[!?]") / n,
        "pipes": n_matches(text, r"\|") / n,
        "digits": n_matches(text, "[0-9]") / chars,
        "stops": n_matches(text, r"\.") / n,
        "lines": n_matches(text, "\n") / n,
    }
    return stored(rows.select("doc_id", *[F.coalesce(c, F.lit(0.0)).cast("double").alias(k) for k, c in stats.items()]), "statistics")


def sample(stats: DataFrame, labels: DataFrame, label: str, usable: Column, bound: int = SAMPLE) -> DataFrame:
    """Statistics and ``label`` of at most ``bound`` labelled documents, chosen by a hash of their doc_id. The chosen labels are broadcast: the parameter bounds them.

    Of rows that repeat a doc_id, the one of the least statistics stays.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = stats.join(F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)), "doc_id")
    return known.groupBy("doc_id").agg(F.min(F.struct(*(c for c in known.columns if c != "doc_id"))).alias("row")).select("doc_id", "row.*")


def grown(x: np.ndarray, y: np.ndarray, bounds: list[np.ndarray], rows: np.ndarray, path: Rule, rules: list[Rule], out: np.ndarray) -> None:
    """Grow a regression tree on ``rows``; append the rule of every node, set ``out`` to the leaves' means."""
    if path:
        rules.append(path)
    best = (1e-9, None)
    if len(path) < DEPTH and len(rows) >= 2 * LEAST:
        total, n = y[rows].sum(), len(rows)
        for f, cut in enumerate(bounds):
            if not len(cut):
                continue
            place = np.searchsorted(cut, x[rows, f], side="left")  # x <= cut[k] exactly if place <= k
            sums = np.cumsum(np.bincount(place, weights=y[rows], minlength=len(cut) + 1))[:-1]
            left = np.cumsum(np.bincount(place, minlength=len(cut) + 1))[:-1]
            right = n - left
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((left >= LEAST) & (right >= LEAST), sums**2 / left + (total - sums) ** 2 / right - total**2 / n, -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), (f, float(cut[k])))
    if best[1] is None:
        out[rows] = y[rows].mean() if len(rows) else 0.0
        return
    f, cut = best[1]
    low = x[rows, f] <= cut
    grown(x, y, bounds, rows[low], (*path, (f, True, cut)), rules, out)
    grown(x, y, bounds, rows[~low], (*path, (f, False, cut)), rules, out)


def holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for f, low, cut in rule:
        out &= (x[:, f] <= cut) == low
    return out


def boosted_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    rng = np.random.default_rng(SEED)
    bounds = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BOUNDS + 2)[:-1])) for f in range(x.shape[1])]
    rules: list[Rule] = []
    margin = np.full(len(y), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    for _ in range(TREES):
        rest = y - 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(len(y)) < 0.5)
        own: list[Rule] = []
        inside = np.zeros(len(y))
        grown(x, rest, bounds, rows, (), own, inside)
        rules += own
        # Rows outside the half take the value of their leaf too.
        leaves = [r for r in own if not any(o != r and o[: len(r)] == r for o in own)]
        for leaf in leaves:
            hit = holds(x, leaf)
            used = hit[rows]
            if used.any():
                margin[hit] += SHRINKAGE * 4 * rest[rows][used].mean()
    return list(dict.fromkeys(tuple(sorted(r)) for r in rules))


def lasso(r: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> tuple[float, np.ndarray]:
    """Intercept and weights of the l1-penalised logistic fit, by accelerated proximal gradient steps. Columns of ``r`` are scaled to unit spread."""
    mean, spread = r.mean(axis=0), np.maximum(r.std(axis=0), 1e-3).astype(np.float32)
    z = (r.astype(np.float32) - mean.astype(np.float32)) / spread
    y = y.astype(np.float32)
    top = np.ones(z.shape[1], dtype=np.float32)
    for _ in range(30):  # the largest eigenvalue bounds the step
        top = z.T @ (z @ top)
        top /= np.linalg.norm(top) + 1e-12
    step = 4 / (1.1 * float(np.linalg.norm(z @ top)) ** 2 / len(y) + 1)
    w = v = np.zeros(z.shape[1], dtype=np.float32)
    b = c = math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    t = 1.0
    for _ in range(STEPS):
        g = 1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30))) - y
        u = v - step * (z.T @ g) / len(y)
        u = np.sign(u) * np.maximum(np.abs(u) - step * penalty, 0)
        d = c - step * float(g.mean())
        t, s = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        v, c = u + np.float32((s - 1) / t) * (u - w), d + (s - 1) / t * (d - b)
        w, b = u, d
    w = (w / spread).astype(float)
    return float(b - w @ mean), w


def compiled(rules: list[Rule], weights: np.ndarray, intercept: float, names: list[str]) -> Column:
    """The ensemble as one column: the logistic function of the weights of the rules that hold."""
    bound = lambda f, low, cut: f"{names[f]} {'<=' if low else '>'} {cut!r}D"
    terms = [f"IF({' AND '.join(bound(*b) for b in rule)}, {float(w)!r}D, 0D)" for rule, w in zip(rules, weights, strict=True) if w]
    return F.expr(f"1 / (1 + exp(-({' + '.join([f'{intercept!r}D', *terms])})))")


def quality(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality") -> DataFrame:
    """doc_id, score for every row of ``docs``; ``usable`` says, by doc_id, which labels may be learnt from."""
    stats = statistics(docs)
    names = [c for c in stats.columns if c != "doc_id"]
    known = sample(stats, labels, label, usable).toPandas().sort_values("doc_id")  # at most SAMPLE rows of numbers
    y = known["label"].to_numpy(dtype=float)
    if len(set(y)) < 2:
        return stats.select("doc_id", F.lit(float(y.mean()) if len(y) else 0.5).alias("score"))
    x = known[names].to_numpy()
    rules = boosted_rules(x, y)
    if not rules:
        return stats.select("doc_id", F.lit(float(y.mean())).alias("score"))
    intercept, weights = lasso(np.column_stack([holds(x, r) for r in rules]), y)
    return stats.select("doc_id", compiled(rules, weights, intercept, names).alias("score"))
