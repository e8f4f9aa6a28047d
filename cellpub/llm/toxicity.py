"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model is counted over all documents (letters folded to a-z, all else a boundary).
2. Characters without width go, and in words with Latin letters, compatible forms and look-alike letters of other alphabets are read as Latin ones. Spans that may hide a word are found:
   look-alike digits and signs with any number of letters or none (a number counts as a word only if the model finds that likelier), letters set apart by any blanks, lines or signs, words with
   signs inside, masked letters, letters drawn out or doubled again and again. Each span is a lattice: every sign stands for the letters it may mean, a mask for any letter or none, every run
   of one letter for one or two of them; letters set apart may have a word boundary between any two. A Viterbi search under the trigram
   model (the two best paths for each state) over the whole span, however long, restores words.
3. Plain and restored words are scored: a word or a beginning of a word weighs the lower confidence bound of its log odds in toxic
   documents, learnt from a bounded sample of labelled rows; a logistic function of a document's largest weights gives the score.
   The logistic part is fitted on the half of the sample that the weights were not learnt from.

Defined cases: null and empty texts have no words and get the score of such documents; repeated rows get equal scores; null
labels are not learnt from; a score of exactly 0.7 is toxic; without labels of both kinds every score is the mean label (0.5 without any); very long texts are read
whole; an empty table gives an empty table; of other columns, none is read. Scores do not depend on how rows are dealt to partitions.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellpub.llm.common import stored
from cellpub.llm.text_stats import words_of

#: Parameters: labelled rows learnt from at most, documents that a feature must be in, its least weight, lengths of beginnings.
SAMPLE, MIN_DOCS, MIN_WEIGHT, BEGINNINGS = 20_000, 6, 0.8, range(3, 8)
#: Features that a task counts before it hands them on; longest span that is remembered; spans remembered.
HELD, LONGEST, REMEMBERED = 300_000, 40, 100_000
#: Taken off the log odds that a single word gives.
CAUTION = 0.5

#: What look-alike characters may stand for.
LOOK_ALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SIGNS = "".join(LOOK_ALIKE)
EDGES = ".,;:!?\"'()[]{}*#%&$|<>+-_"

#: Characters without width, letters of other alphabets that look like Latin ones, signs that mask a letter, signs that may stand inside a word.
NO_WIDTH = dict.fromkeys([0xAD, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF])
CONFUSABLE = str.maketrans("абвеёзіїјклмнорстухѕԁһӏԛԝαβεικνορτυχ", "a6beeeiijkjmhopctyxsdhlqwabeikvoptux")
MASKS, INSIDE = "*#%&?", "_*~·.,/'’+=^-"

SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}[\"').,;:!?]*(?!\S)")
APART = re.compile(r"(?<!\S)[\"'(]*\w(?:[.\-_*~·,/]+\w){2,}[\"').,;:!?]*(?!\S)")
DRAWN, DOUBLED = re.compile(r"([^\W\d_])\1\1"), re.compile(r"([^\W\d_])\1")
#: A word with signs inside, and one with masked letters among at least two others.
BROKEN = re.compile(rf"[^\W_]+(?:[{re.escape(INSIDE)}][^\W_]+)+")
MASKED = re.compile(rf"(?=(?:.*[^\W\d_]){{2}})[^\W_]+(?:[{re.escape(MASKS)}]+[^\W_]+)+")
BEYOND = re.compile(r"[^\x00-\u024f]")
#: What is a number as it stands: amounts, dates, dialling codes, addresses.
NUMBER = re.compile(r"[($€£+<]*\d[\d.,:/\-]*[%$€£+]?\)?")
A, Z = ord("a"), 27
LIKELIHOOD = itemgetter(0)


def _fold() -> np.ndarray:
    """Class of each code point below U+0250: 1 to 26 for letters that fold to a-z, else 0."""
    table = np.zeros(0x250, dtype=np.int64)
    for point in range(0x250):
        base = unicodedata.normalize("NFD", chr(point).lower())[:1]
        if "a" <= base <= "z":
            table[point] = ord(base) - A + 1
    return table


FOLD = _fold()


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(points < len(FOLD), FOLD[np.minimum(points, len(FOLD) - 1)], 0)


def trigram_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P(c | a, b), shape (27, 27, 27). The driver gets one number for each trigram, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(Z**3, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    c = np.concatenate([[0], classes(text), [0]])
                    total += np.bincount((c[:-2] * Z + c[1:-1]) * Z + c[2:], minlength=Z**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    counts = docs.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(Z**3)
    for row in counts:
        table[row["gram"]] = row["n"]
    three = table.reshape(Z, Z, Z)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one.sum() + Z)
    p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
    p3 = (three + 20 * p2) / (three.sum(axis=2, keepdims=True) + 20)
    return np.log(p3).astype(np.float32)


MASK = [*((chr(c), -math.log(27)) for c in range(A, A + 26)), ("", -math.log(27))]


def lattice(span: str, apart: bool = False, masked: bool = False) -> list[list[tuple[str, float]]]:
    """For each run of one character, what it may stand for: letters and the log probability of writing them so. ``apart``: words may end between letters; ``masked``: there are masks."""
    out = []
    for run in re.finditer(r"(.)\1*", span):
        char, n = run[1], run.end() - run.start()
        if masked and char in MASKS:
            out += [MASK] * n
            continue
        letters = LOOK_ALIKE.get(char, char if char.isalpha() else "")
        if not letters:
            continue
        once, twice = (0.0, -3.0) if n == 1 else (-0.7, -0.7)
        arcs = [(c, once - math.log(len(letters))) for c in letters]
        if n > 1:
            arcs += [(c + c, twice - math.log(len(letters))) for c in letters]
            if apart:
                arcs += [(f"{c} {c}", twice - math.log(len(letters))) for c in letters]
        if apart and out:
            arcs += [(f" {w}", cost) for w, cost in arcs]
        out.append(arcs)
    return out


def restored(span: str, model: list, apart: bool = False, masked: bool = False) -> list[tuple[float, str]]:
    """The likeliest words (with ``apart``, sequences of words) behind a span with their log probabilities, the best first."""
    # A path is its log probability and its letters, linked from the last to the first, so a step costs the same in spans of any length.
    paths: dict[tuple[int, int], list[tuple[float, tuple | None]]] = {(0, 0): [(0.0, None)]}
    for arcs in lattice(span, apart, masked):
        after: dict[tuple[int, int], list[tuple[float, tuple | None]]] = {}
        for (a, b), best in paths.items():
            for letters, cost in arcs:
                x, y, gain = a, b, cost
                for letter in letters:
                    c = int(FOLD[ord(letter)]) if ord(letter) < len(FOLD) else 0
                    gain += model[x][y][c]
                    x, y = y, c
                after.setdefault((x, y), []).extend((p + gain, (w, letters)) for p, w in best)
        paths = {state: sorted(found, key=LIKELIHOOD, reverse=True)[:2] for state, found in after.items()}
    ends = [(p + model[a][b][0], w) for (a, b), best in paths.items() for p, w in best]
    return [(p, spelt(w)) for p, w in sorted(ends, key=LIKELIHOOD, reverse=True)[:3]]


def spelt(path: tuple | None) -> str:
    out = []
    while path:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out))


def unveiled(low: str) -> str:
    """A text without characters of no width, and with the Latin letters that those of other alphabets in Latin words look like."""
    if not BEYOND.search(low) and "\xad" not in low:
        return low

    def plain(m: re.Match) -> str:
        word = unicodedata.normalize("NFKC", m[0]).lower()
        return word.translate(CONFUSABLE) if any("a" <= c <= "z" for c in word) else word

    return re.sub(r"\S*[^\x00-\u024f]\S*", plain, low.translate(NO_WIDTH))


def drawn(word: str) -> bool:
    """Whether a letter stands three times in a row, or three letters stand twice."""
    return DOUBLED.search(word) is not None and (DRAWN.search(word) is not None or len(DOUBLED.findall(word)) > 2)


class Reader:
    """Words of a text, plain and restored."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model.tolist(), {}

    def decoded(self, span: str, apart: bool = False, masked: bool = False) -> list[str]:
        if (span, apart, masked) in self.known:
            return self.known[span, apart, masked]
        # Each step of a number is one of ten digits; what is less likely as a word isn't one.
        least = -len(lattice(span)) * math.log(10) if not apart and NUMBER.fullmatch(span) else -math.inf
        words = [w for p, w in restored(span, self.model, apart, masked) if p > least]
        if len(span) <= LONGEST:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[span, apart, masked] = words
        return words

    def __call__(self, text: str | None) -> set[str]:
        low = unveiled((text or "").lower())
        tokens = set(low.split())
        words = {t.strip(EDGES) for t in tokens}
        found = set()
        for token in tokens:
            # Closing exclamation marks and brackets are punctuation, not letters; a closing run of dollar signs may be either.
            core = token.strip(".,;:?\"'")
            if core.isalpha():
                if drawn(core):
                    found.update(self.decoded(core))
                continue
            bare = core.strip(EDGES)
            if not bare.isalnum():
                if MASKED.fullmatch(bare):
                    found.update(self.decoded(bare, masked=True))
                if BROKEN.fullmatch(bare) and re.search(r"[^\W\d_]", bare):
                    joined = re.sub(r"[\W_]", "", bare)
                    found.add(joined)
                    if not joined.isalpha():
                        found.update(self.decoded(joined))
            whole, core = core, re.sub(r"([^\w])\1+$|[!)]+$", "", core)
            for form in {core, whole} if whole.endswith("$$") else (core,):
                if len(form) >= 3 and not form.isalpha() and any(c in LOOK_ALIKE for c in form):
                    found.update(self.decoded(form))
                elif drawn(form):
                    found.update(self.decoded(form))
        for pattern in (SPACED, APART):
            for m in pattern.finditer(low):
                span = re.sub(r"[\s.\-_*~·,/\"':;?]+", "", m[0])
                if len(span) >= 3:
                    found.update(self.decoded(span))
                    found.update(w for words in self.decoded(span, apart=True) for w in words.split())
                    # A run of single letters may begin or end with true one-letter words.
                    if len(span) > 4:
                        found.update(w for s in (span[1:], span[:-1], span[1:-1]) for w in self.decoded(s)[:1])
        words |= found
        words.discard("")
        return words


def features(words: set[str]) -> set[str]:
    """The words, and their beginnings marked as such."""
    return words | {w[:n] + "-" for w in words for n in BEGINNINGS if len(w) > n}


# -- learning ------------------------------------------------------------------------------------------------


def training_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, bound: int = SAMPLE) -> DataFrame:
    """doc_id, text, label of at most ``bound`` labelled rows, chosen by a hash of their doc_id; stored.

    The chosen labels are bounded by the parameter, so they are broadcast and texts stay where they are.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # Of several texts of one doc_id the least counts, so the rows are no more than the labels.
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    # Copies, exact or near, would each count as evidence: of texts with one least three-word hash, that of the least doc_id stays.
    words = rows.withColumn("__words", words_of(F.lower("text")))
    places = F.when(F.size("__words") > 2, F.sequence(F.lit(1), F.size("__words") - 2)).otherwise(F.array(F.lit(1)))
    least = F.array_min(F.transform(places, lambda i: F.xxhash64(F.slice("__words", i, 3))))
    return stored(words.groupBy(least.alias("__least"), "label").agg(F.min(F.struct("doc_id", "text")).alias("one")).select("one.*", "label"), "labelled")


def lexicon(rows: DataFrame, model: np.ndarray) -> dict[str, float]:
    """Weights of features: log odds less 1.64 standard errors. A beginning counts only if it is in twice as many toxic documents as any one word that it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, good, bad = Reader(model), Counter(), Counter()
        rows = lambda: pa.RecordBatch.from_pydict({"feature": pa.array([*bad, *good]), "bad": pa.array([*bad.values(), *[0] * len(good)], pa.int64()), "good": pa.array([*[0] * len(bad), *good.values()], pa.int64())})
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                (bad if label else good).update(features(read(text)))
                if len(bad) + len(good) > HELD:
                    yield rows()
                    bad.clear(), good.clear()
        if bad or good:
            yield rows()

    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_bad, n_good = totals.get(1, 0), totals.get(0, 0)
    counts = rows.select("text", "label").mapInArrow(run, "feature string, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    bad, good = F.col("bad") + 0.5, F.col("good") + 0.5
    odds = F.log(bad / (n_bad + 1 - F.col("bad") + 0.5)) - F.log(good / (n_good + 1 - F.col("good") + 0.5))
    weight = odds - 1.64 * F.sqrt(1 / bad + 1 / good)
    counts = stored(counts.where("bad > 0"), "features")
    most = counts.where("not endswith(feature, '-')").select("bad", F.explode(F.array(*[F.when(F.length("feature") > n, F.concat(F.substring("feature", 1, n), F.lit("-"))) for n in BEGINNINGS])).alias("feature"))
    most = most.where("feature is not null").groupBy("feature").agg(F.max("bad").alias("of_one"))
    kept = counts.where(f"bad >= {MIN_DOCS}").join(most, "feature", "left").where("not endswith(feature, '-') or bad >= 2 * of_one")
    kept = kept.select("feature", weight.alias("weight")).where(f"weight >= {MIN_WEIGHT}")
    # Bounded by the sample: a feature is in MIN_DOCS of its at most SAMPLE documents.
    return {r["feature"]: float(r["weight"]) for r in kept.collect()}


def measured(words: set[str], weights: dict[str, float]) -> tuple[float, float, float]:
    """The largest weight, the second largest of another word, and the log of the number of weighty words."""
    best = sorted((m for w in words if (m := max([weights.get(w, 0.0), *(weights.get(w[:n] + "-", 0.0) for n in BEGINNINGS if len(w) > n)])) > 0), reverse=True)
    first, second = (best + [0.0, 0.0])[:2]
    return first, second, math.log1p(len(best))


def scored_by(docs: DataFrame, weights: dict[str, float], model: np.ndarray, beta: list[float], prior: float, carry: list[str]) -> DataFrame:
    """Scores: the logistic function of the three measures, or what the weightiest word alone says about a document with these prior odds, if that is more."""
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(model)
        for batch in batches:
            x = np.array([measured(read(t), weights) for t in batch.column("text").to_pylist()]).reshape(-1, 3)
            margin = np.where(x[:, 0] > 0, np.maximum(beta[0] + x @ np.array(beta[1:]), x[:, 0] + prior - CAUTION), beta[0])
            score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            own = {c: batch.column(c) for c in carry}
            yield pa.RecordBatch.from_pydict(own | {"x1": pa.array(x[:, 0]), "x2": pa.array(x[:, 1]), "x3": pa.array(x[:, 2]), "score": pa.array(score)})

    return docs.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in carry), "x1 double", "x2 double", "x3 double", "score double"]))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, sweeps: int = 400) -> list[float]:
    """A logistic model with intercept and weights that are not negative, by Newton steps for one weight after another (the problem is convex)."""
    z = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(z.shape[1])
    margin = np.zeros(len(x))
    for _ in range(sweeps):
        most = 0.0
        for k in range(len(beta)):
            p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            penalty = ridge if k else 1e-6
            step = (z[:, k] @ (p - y) + penalty * beta[k]) / ((z[:, k] ** 2) @ (p * (1 - p)) + penalty)
            new = beta[k] - float(np.clip(step, -2, 2))
            new = max(0.0, new) if k else new
            margin += (new - beta[k]) * z[:, k]
            most, beta[k] = max(most, abs(new - beta[k])), new
        if most < 1e-7:
            break
    return beta.tolist()


def toxicity(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic") -> DataFrame:
    """doc_id, score for every row of ``docs``; ``usable`` says, by doc_id, which labels may be learnt from."""
    rows = training_rows(docs, labels, label, usable)
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if len(totals) < 2:
        mean = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
        return texts.select("doc_id", F.lit(float(mean)).alias("score"))
    model = trigram_model(docs)
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    weights = lexicon(rows.where(half == 0), model)
    found = scored_by(rows.where(half == 1), weights, model, [0.0] * 4, 0.0, ["label"]).toPandas()  # at most SAMPLE rows of four numbers
    beta = fit_logistic(found[["x1", "x2", "x3"]].to_numpy(), found["label"].to_numpy())
    prior = math.log(totals[1] / totals[0])
    return scored_by(texts, lexicon(rows, model), model, beta, prior, ["doc_id"]).select("doc_id", "score")
