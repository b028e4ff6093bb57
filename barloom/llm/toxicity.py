"""Toxicity by weak supervision: lexicon and pattern voters, a label model, a linear classifier.

Voters are mined from labelled texts (words and word beginnings that toxic texts have
and others have not) and joined by patterns of style. A generative model estimates
how often each voter fires in either class and which voters fire together anyway;
its posteriors are the labels a logistic regression over many features learns from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.base import map_batches, prepared, stored

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
# The label model and the classifier are fitted on so many labelled rows at most (by hash of doc_id).
MOST_LABELLED = 20_000
MOST_FEATURES = 4_000
LEXICON_VOTERS = 96
# A word and its beginnings, or two words of one phrase, are one voter from this overlap on.
SAME_VOTER = 0.8
LEAST_SUPPORT = 5
# Signed root of the likelihood ratio from which a feature is no chance find among millions.
LEAST_ASSOCIATION = 5.0
# How often a given label is taken to be right. It is the one rate that is not estimated: it holds
# the classes to their meaning, while voters may still overrule a label.
LABEL_TRUST = 0.98
THRESHOLD = 0.3
# Patterns of style. Each is a voter; none decides alone.
PATTERNS = {
    "shouting": re.compile(r"\b[A-Z]{4,}\b[^a-z]*\b[A-Z]{4,}\b"),
    "exclaiming": re.compile(r"!{2,}"),
    "masked word": re.compile(r"\b\w+[*#@$]{2,}\w*"),
    "drawn-out letters": re.compile(r"([^\W\d_])\1{3,}"),
    "addressed": re.compile(r"(?i)\b(you|your|du|dein|tu|vous|usted)\b"),
}
SCORES = "doc_id long, score double"


def features(text: str) -> set[str]:
    """Words (`w:`) and beginnings of longer words (`4:`, `5:`, `6:`) of a text."""
    found = set()
    for word in set(WORD.findall(text.lower())):
        found.update(word_features(word))
    return found


def word_features(word: str) -> list[str]:
    return [f"w:{word}", *(f"{n}:{word[:n]}" for n in BEGINNINGS if len(word) > n)]


def association(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Signed root of the likelihood-ratio statistic; positive for features of toxic texts."""
    total, n = toxic + clean, n_toxic + n_clean

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / expected), 0.0)

    statistic = 2 * (
        part(toxic, total * n_toxic / n)
        + part(clean, total * n_clean / n)
        + part(n_toxic - toxic, np.maximum((n - total) * n_toxic / n, 1e-9))
        + part(n_clean - clean, np.maximum((n - total) * n_clean / n, 1e-9))
    )
    sign = np.where(toxic * n_clean >= clean * n_toxic, 1.0, -1.0)
    return sign * np.sqrt(np.maximum(statistic, 0))


def _sketch(text: str) -> int:
    """The smallest hash of three words in a row: equal for most near copies of a text."""
    words = WORD.findall(text.lower()) or [""]
    shifted = zip(*(words[i:] for i in range(min(3, len(words)))), strict=False)
    return min(xxhash.xxh64_intdigest(" ".join(s)) for s in shifted) >> 1


def labelled_sample(documents: DataFrame, labels: DataFrame, training: str, most: int) -> DataFrame:
    """(text, toxic) of at most `most` labelled documents that meet `training`, near copies once.

    A document with several labels is toxic if one of them says so. The ids are a
    bounded broadcast, so the texts are filtered where they are read. Copies would
    make every word of theirs a sign of their label.
    """
    chosen = (
        labels.where(training)
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )

    def sketched(columns: dict[str, list]) -> dict[str, list]:
        return {**columns, "sketch": [_sketch(t) for t in columns["text"]]}

    return (
        map_batches(
            texts.select("text", "toxic"), sketched, "text string, toxic int, sketch long"
        )
        .groupBy("sketch", "toxic")
        .agg(F.min("text").alias("text"))
        .select("text", "toxic")
    )


def feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, clean): in how many labelled texts of either class a feature occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            columns = batch.to_pydict()
            for text, toxic in zip(columns["text"], columns["toxic"], strict=True):
                seen[int(toxic > 0)].update(features(text))
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([seen[1][f] for f in names], pa.int64()),
                pa.array([seen[0][f] for f in names], pa.int64()),
            ],
            names=["feature", "toxic", "clean"],
        )

    partial = sample.select("text", "toxic").mapInArrow(count, "feature string, toxic long, clean long")
    return partial.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class LabelModel:
    """Firing rates of voters in either class, and weights that discount voters that agree
    beyond what the class explains.

    A voter that does not fire abstains; only the last one, the given label, also
    speaks when it does not fire. The last but one fires where no word of the lexicon
    does. These two are no copies of others by chance, so they are not discounted.
    """

    prior: float
    toxic_rate: np.ndarray
    clean_rate: np.ndarray
    weight: np.ndarray

    @classmethod
    def fit(cls, votes: np.ndarray, start: np.ndarray, rounds: int = 15) -> LabelModel:
        """Expectation maximisation from first guesses `start` of the classes."""
        posterior, weight = start.astype(float), np.ones(votes.shape[1])
        for _ in range(rounds):
            model = cls._rates(votes, posterior, weight)
            model.weight = weight = model._discounts(votes, posterior)
            posterior = model.posterior(votes)
        return model

    @classmethod
    def _rates(cls, votes: np.ndarray, posterior: np.ndarray, weight: np.ndarray) -> LabelModel:
        toxic, clean = posterior.sum(), (1 - posterior).sum()
        toxic_rate = (posterior @ votes + 0.5) / (toxic + 1)
        clean_rate = ((1 - posterior) @ votes + 0.5) / (clean + 1)
        toxic_rate[-1], clean_rate[-1] = LABEL_TRUST, 1 - LABEL_TRUST
        return cls((toxic + 1) / (toxic + clean + 2), toxic_rate, clean_rate, weight)

    def _discounts(self, votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
        """One over the variance shared with all voters, given the class; 1 for a voter that
        is independent of the others, 1/k for each of k voters that always agree."""
        expected = np.outer(posterior, self.toxic_rate) + np.outer(1 - posterior, self.clean_rate)
        residual = votes - expected
        spread = np.sqrt((residual**2).mean(axis=0)) + 1e-6
        correlation = residual.T @ residual / len(votes) / np.outer(spread, spread)
        np.fill_diagonal(correlation, 1)
        weight = 1 / (correlation[:-2, :-2] ** 2).sum(axis=0)
        return np.append(weight, [1.0, 1.0])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        fired = np.log(self.toxic_rate / self.clean_rate)
        silent = np.log((1 - self.toxic_rate[-1]) / (1 - self.clean_rate[-1]))
        logit = np.log(self.prior / (1 - self.prior)) + votes @ (self.weight * fired)
        logit += (1 - votes[:, -1]) * self.weight[-1] * silent
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def distinct_voters(present: list[list[int]], names: int, most: int) -> list[int]:
    """The first `most` features, in order, that do not fire in nearly the same texts as an earlier one."""
    fires: list[set[int]] = [set() for _ in range(names)]
    for row, own in enumerate(present):
        for feature in own:
            fires[feature].add(row)
    chosen: list[int] = []
    for feature, rows in enumerate(fires):
        if rows and all(
            len(rows & fires[c]) < SAME_VOTER * len(rows | fires[c]) for c in chosen
        ):
            chosen.append(feature)
            if len(chosen) == most:
                break
    return chosen


@dataclass
class Classifier:
    """Logistic regression over presence of features."""

    bias: float
    weights: dict[str, float]

    @classmethod
    def fit(
        cls, rows: list[list[int]], names: list[str], target: np.ndarray, rounds: int = 300
    ) -> Classifier:
        """Full-batch steps on soft labels, each weight scaled by its own gradients, small ridge."""
        at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        which = np.array([i for r in rows for i in r], dtype=np.int64)
        rate = np.clip(target.mean(), 1e-6, 1 - 1e-6)
        # the bias is the last weight
        weights = np.append(np.zeros(len(names)), np.log(rate / (1 - rate)))
        mean, square = np.zeros_like(weights), np.zeros_like(weights)
        for step in range(1, rounds + 1):
            logit = weights[-1] + np.bincount(at, weights[which], len(rows))
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target
            slope = np.append(np.bincount(which, error[at], len(names)), error.sum()) / len(rows)
            slope[:-1] += 1e-5 * weights[:-1]
            mean = 0.9 * mean + 0.1 * slope
            square = 0.999 * square + 0.001 * slope**2
            size = np.sqrt(square / (1 - 0.999**step)) + 1e-8
            weights -= 0.05 * mean / (1 - 0.9**step) / size
        kept = {n: float(w) for n, w in zip(names, weights[:-1], strict=True) if abs(w) > 1e-4}
        return cls(float(weights[-1]), kept)

    def scorer(self):
        """A function from texts to scores, remembering the weights of words it has met."""
        weights, known = self.weights, {}

        def of_word(word: str) -> frozenset[str]:
            found = frozenset(f for f in word_features(word) if f in weights)
            if len(known) > 500_000:
                known.clear()
            known[word] = found
            return found

        def score(texts: list[str]) -> list[float]:
            out = []
            for text in texts:
                present: set[str] = set()
                for word in set(WORD.findall(text.lower())):
                    found = known.get(word)
                    if found is None:
                        found = of_word(word)
                    if found:
                        present |= found
                # a fixed order of summation, whatever the set's
                logit = self.bias + sum([weights[f] for f in sorted(present)])
                out.append(float(1 / (1 + np.exp(-np.clip(logit, -30, 30)))))
            return out

        return score


def lexicon(sample: DataFrame, counted: DataFrame) -> list[str]:
    """Names of the features that speak for toxicity, strongest association first.

    Features of at least LEAST_SUPPORT toxic texts and LEAST_ASSOCIATION;
    at most MOST_FEATURES reach the driver.
    """
    totals = sample.agg(F.sum((F.col("toxic") > 0).cast("long")), F.count("*")).first()
    toxic, clean = totals[0] or 0, (totals[1] or 0) - (totals[0] or 0)
    ratio = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    strength = F.log(ratio) * F.sqrt("toxic")
    best = (
        counted.where(F.col("toxic") >= LEAST_SUPPORT)
        .withColumn("strength", strength)
        .orderBy(F.col("strength").desc(), "feature")
        .limit(MOST_FEATURES)
        .toPandas()
    )
    if best.empty:
        return []
    force = association(
        best["toxic"].to_numpy(float), best["clean"].to_numpy(float), toxic, max(clean, 1)
    )
    order = [i for i in np.lexsort((best["feature"], -force)) if force[i] >= LEAST_ASSOCIATION]
    return best["feature"].iloc[order].tolist()


def train(sample: DataFrame) -> Classifier:
    """Label model and classifier from (text, toxic); without both classes a constant."""
    names = lexicon(sample, feature_counts(sample))
    number = {name: i for i, name in enumerate(names)}

    def read(columns: dict[str, list]) -> dict[str, list]:
        present = [sorted(number[f] for f in features(t) if f in number) for t in columns["text"]]
        fired = [[int(bool(p.search(t))) for p in PATTERNS.values()] for t in columns["text"]]
        return {"toxic": [int(t > 0) for t in columns["toxic"]], "present": present, "fired": fired}

    rows = map_batches(
        sample.select("text", "toxic"), read, "toxic int, present array<int>, fired array<int>"
    ).toPandas()  # bounded by MOST_LABELLED rows and MOST_FEATURES numbers
    toxic = rows["toxic"].to_numpy(float)
    if not names or not 0 < toxic.sum() < len(toxic):
        rate = float(toxic.mean()) if len(toxic) else 0.0
        return Classifier(float(np.log((rate + 1e-6) / (1 - rate + 1e-6))), {})
    present = [list(r) for r in rows["present"]]
    voters = distinct_voters(present, len(names), LEXICON_VOTERS)
    column = {feature: i for i, feature in enumerate(voters)}
    votes = np.zeros((len(rows), len(voters) + len(PATTERNS) + 2))
    for i, own in enumerate(present):
        votes[i, [column[f] for f in own if f in column]] = 1
    votes[:, len(voters) : -2] = np.array(rows["fired"].tolist())
    votes[:, -2] = ~votes[:, : len(voters)].any(axis=1)  # no word of the lexicon
    votes[:, -1] = toxic  # the given label is one more voter
    model = LabelModel.fit(votes, start=0.02 + 0.96 * toxic)
    return Classifier.fit(present, names, model.posterior(votes))


def score_texts(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id and score of every whole text, one row per input row; NULL texts are empty."""
    spark = prepared(documents.sparkSession)
    shared = spark.sparkContext.broadcast(classifier)  # at most MOST_FEATURES weights

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in batches:
            scores = score([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return documents.select("doc_id", "text").mapInArrow(apply, SCORES)


def toxicity(
    documents: DataFrame, labels: DataFrame, training: str, most_labelled: int = MOST_LABELLED
) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.3 on), one row per input row.

    `training` is a condition on doc_id; only labels of rows that meet it are used.
    A NULL text scores as an empty one; a NULL doc_id is scored and never trained on;
    labels without a document, with a NULL id or NULL toxic are ignored; without
    labels of both classes every score is their constant rate. Repeated documents
    give repeated rows.
    """
    prepared(documents.sparkSession)
    sample = stored(labelled_sample(documents, labels, training, most_labelled), "toxic-sample")
    return score_texts(documents, train(sample)).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
