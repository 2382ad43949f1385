"""Toxicity by weak supervision.

Many voters look at a text: lexicon voters (terms that labelled toxic texts favour, one voter per word stem) and
pattern voters. A generative label model estimates by expectation-maximisation how often each voter speaks in either
class, measures how voters go together beyond the class, and discounts those that repeat each other. Its posterior
labels train a linear classifier, which scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.tasks import own_columns, small_batches, spare_names, stored, with_python_columns

# Everything that is fitted (lexicon, label model, classifier) comes from this many labelled rows of each class at
# most, those with the smallest hash of their id.
MOST_LABELLED_PER_CLASS = 10_000
# Voters made of the lexicon's terms: the stems of the surest ones have a voter each, all others share one.
MOST_STEMS = 60
STEM = 4
# Log odds that a term must reach at least, at the lower bound.
LEAST_ODDS = 1.0
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED_WORDS = 300_000
_SHOUTED = re.compile(r"(?<=[a-z] )[A-Z]{4,}\b")
_STRETCHED = re.compile(r"([a-z])\1{3}")
_PATTERNS = 8


def terms_of(word: str) -> list[str]:
    """A lower-case word and its beginnings of 4 to 7 letters (written with an asterisk)."""
    return [word] + [word[:n] + "*" for n in range(STEM, STEM + 4) if len(word) > n]


def patterns_of(text: str) -> list[bool]:
    """Pattern voters: stressed exclamations, mostly capitals, insistent marks, direct address, accusation, command, a word
    shouted among others, stretched letters."""
    letters = sum(map(str.isupper, text))
    lower = text.lower()
    return [
        text.count("!") > 2 + len(text) // 200, letters > len(text) // 2 > 10, "!!" in text or "?!" in text, "you " in lower,
        "you are " in lower or "you're " in lower, "go away" in lower or "shut up" in lower or "get out" in lower,
        _SHOUTED.search(text) is not None, _STRETCHED.search(text) is not None]


def held_out(doc_id: Column) -> Column:
    """Rows kept apart from learning: crc32 of the id as text leaves 2 when divided by 4; an id of NULL is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, most_per_class: int = MOST_LABELLED_PER_CLASS) -> DataFrame:
    """``text``, ``toxic`` of labelled rows that are not held out, bounded per class, written to the shared folder.

    Labels of NULL (id or label) are left out; an id labelled twice is toxic if one label says so.
    """
    single = clean_labels(labels)
    of_class = [
        single.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_class) for c in (0, 1)
    ]
    chosen = F.broadcast(of_class[0].union(of_class[1]))  # 2 * most_per_class ids at most
    # of an id that repeats one text stands for it, so the bound on ids is one on rows
    own = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    one = own.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("toxic").alias("toxic"))
    return stored(one.select("text", "toxic"), "labelled")


def clean_labels(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``toxic`` of the labels that may be learnt from, one row per id."""
    clean = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return clean.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each term, by class, summed per task."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(*[c.to_pylist() for c in batch.columns]):
            found = set()
            for word in set(_WORD.findall(text.lower())):
                found.update(terms_of(word))
            counts[toxic].update(found)
    terms = list(counts[0].keys() | counts[1].keys())
    for i in range(0, len(terms), 50_000):
        part = terms[i:i + 50_000]
        yield pa.RecordBatch.from_pydict({"term": part, "clean": [counts[0][t] for t in part], "toxic": [counts[1][t] for t in part]})


def learn_lexicon(sample: DataFrame, n_clean: int, n_toxic: int) -> list[tuple[str, float]]:
    """Terms whose log odds ratio is well above chance, with the lower bound of its confidence interval, highest first.

    All of them: they come from a bounded sample, and each stands in three of its toxic texts or more."""
    counts = sample.mapInArrow(_count_terms, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    cells = [F.col("toxic") + 0.5, F.lit(n_toxic + 0.5) - F.col("toxic"), F.col("clean") + 0.5, F.lit(n_clean + 0.5) - F.col("clean")]
    odds = F.log(cells[0]) - F.log(cells[1]) - F.log(cells[2]) + F.log(cells[3])
    error = F.sqrt(sum((1 / c for c in cells[1:]), 1 / cells[0]))
    sure = counts.where("toxic >= 3").select("term", (odds - 1.64 * error).alias("low")).where(F.col("low") > LEAST_ODDS)
    return [(r["term"], r["low"]) for r in sure.orderBy(F.col("low").desc(), "term").collect()]


class Voters:
    """Which terms and voters speak in a text."""

    def __init__(self, lexicon: list[tuple[str, float]]):
        self.terms = {t: i for i, (t, _) in enumerate(lexicon)}
        self.strength = [low for _, low in lexicon]
        stems = {}
        for t, _ in lexicon:
            stems.setdefault(t[:STEM], len(stems))
        self.stem = [stems[t[:STEM]] for t, _ in lexicon]
        self.count = MOST_STEMS + 1 + _PATTERNS
        self.known: dict[str, tuple[int, ...]] = {}

    def look(self, text: str) -> tuple[list[int], list[float]]:
        """Voters that speak, and the numbers the classifier sees besides them."""
        words = set(_WORD.findall(text.lower()))
        known, hits, hit_words = self.known, set(), 0
        for word in words:
            found = known.get(word)
            if found is None:
                if len(known) >= _REMEMBERED_WORDS:
                    known.clear()
                found = known[word] = tuple(self.terms[t] for t in terms_of(word) if t in self.terms)
            if found:
                hits.update(found)
                hit_words += 1
        strongest: dict[int, float] = {}
        for h in hits:
            strongest[self.stem[h]] = max(strongest.get(self.stem[h], 0.0), self.strength[h])
        numbers = [float(np.log1p(sum(strongest.values()))), float(np.log1p(len(strongest))), max(strongest.values(), default=0.0),
                   10.0 * hit_words / (len(words) + 10)]
        patterns = patterns_of(text)
        # the last lexicon voter takes the stems beyond the limit
        spoken = {min(s, MOST_STEMS) for s in strongest}
        return sorted(spoken) + [MOST_STEMS + 1 + i for i in range(_PATTERNS) if patterns[i]], numbers


def label_model(votes: np.ndarray, gold: np.ndarray, weight: np.ndarray, rounds: int = 12, with_given: bool = True) -> np.ndarray:
    """Posterior probability of the class "toxic" per row.

    ``votes`` (rows, voters) says who speaks. The given label starts the estimation and, ``with_given``, counts as one more
    voter with an accuracy of its own, which is held high, so that the two classes keep their meaning: left to the voters
    alone, the classes drift to whatever most voters agree on.
    """
    everyone = np.column_stack([votes, gold]).astype(float) if with_given else votes.astype(float)
    post = np.where(gold == 1, 0.95, 0.05)
    for _ in range(rounds):
        w1, w0 = weight * post, weight * (1 - post)
        speaks1 = (everyone.T @ w1 + 0.5) / (w1.sum() + 1)
        speaks0 = (everyone.T @ w0 + 0.5) / (w0.sum() + 1)
        if with_given:
            speaks1[-1], speaks0[-1] = max(speaks1[-1], 0.9), min(speaks0[-1], 0.02)
        # what goes together beyond the class: correlation of the residuals
        rest = (everyone - post[:, None] * speaks1 - (1 - post)[:, None] * speaks0) * np.sqrt(weight)[:, None]
        covariance = rest.T @ rest
        spread = np.sqrt(np.diag(covariance)) + 1e-9
        together = np.clip(covariance / spread[:, None] / spread, 0, 1)
        np.fill_diagonal(together, 0)
        together[together < 0.1] = 0
        trust = 1 / (1 + together.sum(axis=1))
        if with_given:
            trust[-1] = 1
        spoken, silent = np.log(speaks1 / speaks0) * trust, np.log((1 - speaks1) / (1 - speaks0)) * trust
        prior = np.log(w1.sum() + 1) - np.log(w0.sum() + 1)
        logit = prior + everyone @ spoken + (1 - everyone) @ silent
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post


def train_linear(inputs: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the first column is the constant."""
    beta = np.zeros(inputs.shape[1])
    penalty = np.full(inputs.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(inputs @ beta, -30, 30)))
        slope = inputs.T @ (weight * (target - p)) - penalty * beta
        bend = (inputs * (weight * p * (1 - p) + 1e-9)[:, None]).T @ inputs + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(
    documents: DataFrame, labels: DataFrame, most_per_class: int = MOST_LABELLED_PER_CLASS, with_given: bool = True,
) -> dict:
    """The fitted classifier: ``lexicon`` and ``weights``. Without labelled rows every text scores 0."""
    small_batches(documents.sparkSession)
    sample = labelled_sample(documents, labels, most_per_class)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return {"lexicon": [], "weights": [-30.0 if not n_toxic else 30.0]}
    lexicon = learn_lexicon(sample, n_clean, n_toxic)

    def make():
        voters = Voters(lexicon)

        def compute(texts):
            seen = [voters.look(t) for t in texts]
            return [[s[0] for s in seen], [s[1] for s in seen]]

        return compute

    rows = with_python_columns(sample, ["text"], "votes array<int>, numbers array<double>", make).select("toxic", "votes", "numbers").collect()
    gold = np.array([r["toxic"] for r in rows])
    numbers = np.array([r["numbers"] for r in rows])
    votes = np.zeros((len(rows), MOST_STEMS + 1 + _PATTERNS))
    for i, r in enumerate(rows):
        votes[i, r["votes"]] = 1
    # sampling by class changed the shares; weights restore those of the labelled rows
    totals = {r["toxic"]: r["count"] for r in clean_labels(labels).groupBy("toxic").count().collect()}
    weight = np.where(gold == 1, totals[1] / n_toxic, totals[0] / n_clean)
    weight *= len(rows) / weight.sum()
    post = label_model(votes, gold, weight, with_given=with_given)
    inputs = np.column_stack([np.ones(len(rows)), numbers, votes])
    return {"lexicon": lexicon, "weights": train_linear(inputs, post, weight).tolist()}


def score_texts(df: DataFrame, model: dict, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with ``score`` (0 to 1, toxic likelier when higher). NULL and empty texts are scored like a text without
    words; repeated rows score alike; whole texts are read, however long. A column of the name is replaced."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # terms of the bounded sample and some seventy numbers

    def make():
        voters, weights = Voters(sent.value["lexicon"]), sent.value["weights"]
        n = len(weights)

        def one(t):
            if n == 1:
                logit = weights[0]
            else:
                spoken, numbers = voters.look(t or "")
                logit = weights[0] + sum(a * b for a, b in zip(weights[1:5], numbers)) + sum(weights[5 + v] for v in spoken)
            return float(1 / (1 + np.exp(-max(-30.0, min(30.0, logit)))))

        return lambda texts: [[one(t) for t in texts]]

    return with_python_columns(df, [text], f"`{score}` double", make)


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` (same columns, which may have any name) without those scored at ``threshold`` or above.

    The classifier is fitted on the labels of the documents' own ids. NULL and empty texts are scored like a text without
    words, repeated rows stay or go together, whole texts are read. Without labels, or with labels of one class only, every
    text is of that class (clean without any). An empty table stays empty.
    """
    score, = spare_names(documents, 1)
    kept = score_texts(documents, fit(documents, labels), score=score).where(F.col(score) < threshold)
    return kept.select(*own_columns(kept, documents))
