"""Language identification with interpolated Kneser-Ney character models.

Per language, counts of character 4-grams over all training texts; lower orders use
continuation counts. An n-gram that is very rare in its own language leaves its
probability to the shorter one; no language's n-grams compete with another's. All n-grams are 64-bit hashes in sorted arrays shared by the
languages. A text gets the language of the lowest cross-entropy per character, and
is rejected if that is far above what the language's own training texts have.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.base import prepared, small_groups, stored

ORDER = 4
UNDETERMINED = "und"
# An n-gram with a smaller share of its own language's counts is left to back-off, and its
# probability with it. A language has at most 1 / RARE such n-grams per order, whatever the others have.
RARE = 1e-7
# A text is rejected above median + SLACK x (99th percentile - median) of its language, plus
# SHORT / sqrt(letters): single letters cost some 1.5 nats more or less, short texts vary by that.
SLACK, SHORT = 8.0, 6.0
SPACE, START = 32, 1
# The least that a context leaves to the lower order, so that its logarithm exists.
LEAST_LEFT = 1e-12
# Characters scored at once, some 60 bytes of working memory each.
AT_ONCE = 400_000
SCORES = "doc_id long, lang string, letters long, best string, entropy double, score double"


@cache
def _alphabet() -> np.ndarray:
    """Lower-case letters by code point, a blank for everything else in the first plane."""
    table = np.full(1 << 16, SPACE, dtype=np.uint64)
    for point in range(1 << 16):
        char = chr(point)
        if unicodedata.category(char)[0] in "LM":
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def symbols(text: str) -> tuple[np.ndarray, int]:
    """A text as letters and single blanks after START symbols, and how many letters it has.

    Letters beyond the first plane are folded into its private area.
    """
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    mapped = _alphabet()[points & 0xFFFF]
    beyond = np.nonzero(points > 0xFFFF)[0]
    for i in beyond:
        letter = unicodedata.category(chr(points[i]))[0] in "LM"
        mapped[i] = 0xE000 + int(points[i]) % 0x1900 if letter else SPACE
    blank = mapped == SPACE
    keep = np.ones(len(mapped), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    start = np.full(ORDER - 1, START, dtype=np.uint64)
    return np.concatenate([start, mapped[keep]]), int(len(mapped) - blank.sum())


def grams(sequence: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each symbol after the START symbols, 16 bits per symbol."""
    n = len(sequence) - ORDER + 1
    keys = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(ORDER):
        keys = keys << np.uint64(16) | sequence[i : i + n]
    return keys


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(unique)).astype(np.int64)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (text, lang); counted per task, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                texts.setdefault(lang, []).append(text or "")
            for lang, own in texts.items():
                for group in small_groups(own, AT_ONCE):
                    keys = np.concatenate([grams(symbols(t)[0]) for t in group])
                    found = np.unique(keys, return_counts=True)
                    before = [total[lang]] if lang in total else []
                    total[lang] = _summed(*map(list, zip(*before, found)))
        for lang, (keys, counts) in total.items():
            names = pa.array([lang] * len(keys), pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"]
            )

    partial = labelled.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def by_order(counted: DataFrame) -> DataFrame:
    """(lang, ord, gram, n): the 4-grams, and shorter n-grams with their continuation counts, that
    is, in how many longer types they end."""
    orders = [counted.select("lang", F.lit(ORDER).alias("ord"), "gram", "n")]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("gram")
        grouped = orders[-1].groupBy("lang", shorter).agg(F.count("*").alias("n"))
        orders.append(grouped.select("lang", F.lit(order).alias("ord"), "gram", "n"))
    return reduce(DataFrame.union, orders)


def sizes(grams: DataFrame) -> DataFrame:
    """(lang, ord, total, once, twice): the sum of counts, and how many counts are 1 and 2."""
    return grams.groupBy("lang", "ord").agg(
        F.sum("n").alias("total"),
        F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice"),
    )


def kept_grams(grams: DataFrame, rare: float) -> DataFrame:
    """(lang, ord, gram, n, head_n) of the n-grams with at least the share `rare` of their language's
    counts; head_n is the count of the context over all n-grams, kept or not."""
    head = F.shiftrightunsigned("gram", 16).alias("head")
    heads = grams.groupBy("lang", "ord", head).agg(F.sum("n").alias("head_n"))
    totals = F.broadcast(sizes(grams))  # four rows per language
    often = grams.join(totals, ["lang", "ord"]).where(F.col("n") >= F.col("total") * rare)
    return often.select("lang", "ord", "gram", "n", head).join(heads, ["lang", "ord", "head"]).drop("head")


def discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


@dataclass
class Counts:
    """Kept n-grams of one order and language: sorted keys, counts, counts of their contexts, discount."""

    keys: np.ndarray
    counts: np.ndarray
    heads: np.ndarray
    discount: float


def _position(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return at, (sorted_keys[at] == keys) if len(sorted_keys) else np.zeros(len(keys), dtype=bool)


@dataclass
class Models:
    """Per order 1..4: sorted n-gram keys with log-probabilities, sorted context keys with
    log back-off weights; one column per language."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: np.ndarray

    @classmethod
    def build(cls, counted: dict[str, list[Counts]]) -> Models:
        """From the n-grams of orders 1..4 of each language."""
        languages = sorted(counted)
        own = [[counted[lang][order] for lang in languages] for order in range(ORDER)]
        union = [np.unique(np.concatenate([c.keys for c in of])) for of in own]
        contexts = [np.unique(u >> np.uint64(16)) for u in union]
        # below all orders, every symbol of any language and one unseen symbol are equally likely
        floor = np.full(len(languages), -np.log(len(union[0]) + 1))
        models = cls(languages, [], [], [], [], floor)
        for order in range(1, ORDER + 1):
            keys, heads = union[order - 1], contexts[order - 1]
            logs = np.empty((len(keys), len(languages)), dtype=np.float32)
            weights = np.zeros((len(heads), len(languages)), dtype=np.float32)
            for start in range(0, len(keys), AT_ONCE):
                part = keys[start : start + AT_ONCE] & np.uint64((1 << 16 * (order - 1)) - 1)
                logs[start : start + AT_ONCE] = models.score(part, order - 1)
            of_key = np.searchsorted(heads, keys >> np.uint64(16))
            for column, known in enumerate(own[order - 1]):
                share = np.maximum(known.counts - known.discount, 0) / known.heads
                head = np.searchsorted(heads, known.keys >> np.uint64(16))
                # what a context's kept n-grams leave goes to the lower order: discounts and rare n-grams
                left = np.maximum(1 - np.bincount(head, weights=share, minlength=len(heads)), LEAST_LEFT)
                weights[:, column] = np.log(left)
                probability = left[of_key] * np.exp(logs[:, column], dtype=np.float64)
                probability[np.searchsorted(keys, known.keys)] += share
                logs[:, column] = np.log(probability)
            models.keys.append(keys)
            models.logs.append(logs)
            models.contexts.append(heads)
            models.weights.append(weights)
        return models

    def score(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Natural log-probability of each n-gram's last symbol, per language."""
        out = np.tile(self.floor, (len(keys), 1))
        if order == 0 or not len(keys):
            return out
        at, found = _position(self.keys[order - 1], keys)
        out[found] = self.logs[order - 1][at[found]]
        if not found.all():
            rest = keys[~found]
            shorter = self.score(rest & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)
            at, seen = _position(self.contexts[order - 1], rest >> np.uint64(16))
            shorter[seen] += self.weights[order - 1][at[seen]]
            out[~found] = shorter
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per symbol (text x language), number of symbols, number of letters."""
        read = [symbols(t) for t in texts]
        each = [grams(s) for s, _ in read]
        sizes = np.array([len(k) for k in each], dtype=np.int64)
        letters = np.array([n for _, n in read], dtype=np.int64)
        sums = np.zeros((len(texts), len(self.languages)))
        unique, inverse = np.unique(np.concatenate(each), return_inverse=True)
        if len(unique):
            scores = self.score(unique).astype(np.float32)
            full = np.nonzero(sizes)[0]
            starts = (np.cumsum(sizes) - sizes)[full]
            for column in range(len(self.languages)):
                of_symbol = scores[:, column][inverse]
                sums[full, column] = np.add.reduceat(of_symbol, starts, dtype=np.float64)
        return -sums / np.maximum(sizes, 1)[:, None], sizes, letters


def train(labelled: DataFrame, rare: float = RARE) -> Models | None:
    """Models of all languages in (text, lang), counted over all rows; None without rows.

    Continuation counts, discounts and context counts are of all n-grams; only those with at
    least the share `rare` of their language's counts get a probability of their own.
    """
    prepared(labelled.sparkSession)
    counted = stored(gram_counts(labelled.where("text IS NOT NULL AND lang IS NOT NULL")), "grams")
    grams = stored(by_order(counted), "orders")
    kept = kept_grams(grams, rare).toPandas()  # at most 1 / rare rows per language and order
    if kept.empty:
        return None
    model: dict[str, list[Counts]] = {}
    for size in sizes(grams).orderBy("lang", "ord").collect():  # four rows per language
        rows = kept[(kept["lang"] == size["lang"]) & (kept["ord"] == size["ord"])]
        rows = rows.assign(key=rows["gram"].to_numpy().view(np.uint64)).sort_values("key")
        columns = (rows[name].to_numpy() for name in ("key", "n", "head_n"))
        model.setdefault(size["lang"], []).append(Counts(*columns, discount(size["once"], size["twice"])))
    return Models.build(model)


def scored(documents: DataFrame, models: Models | None) -> DataFrame:
    """doc_id, lang, letters, best language, its cross-entropy and posterior, per row."""
    shared = documents.sparkSession.sparkContext.broadcast(models)  # bounded by RARE

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            letters, best, entropy, posterior = [], [], [], []
            for group in small_groups(texts, AT_ONCE):
                if models is None:
                    letters += [symbols(t)[1] for t in group]
                    best += [None] * len(group)
                    entropy += [None] * len(group)
                    posterior += [0.0] * len(group)
                    continue
                h, sizes, n = models.entropies(group)
                lowest = h.argmin(axis=1)
                # differences of entropies weigh more in longer texts, by the root of their length
                logits = (h.min(axis=1, keepdims=True) - h) * np.sqrt(sizes)[:, None]
                letters += n.tolist()
                best += [models.languages[i] for i in lowest]
                entropy += h.min(axis=1).tolist()
                posterior += (1 / np.exp(logits).sum(axis=1)).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("lang"),
                    pa.array(letters, pa.int64()),
                    pa.array(best, pa.string()),
                    pa.array(entropy, pa.float64()),
                    pa.array(posterior, pa.float64()),
                ],
                names=[part.split(" ")[0] for part in SCORES.split(", ")],
            )

    return documents.select("doc_id", "lang", "text").mapInArrow(score, SCORES)


def rejection_limits(found: DataFrame, training: str, slack: float) -> dict[str, float]:
    """Per language the entropy from which a long text is rejected, from rows of `scored`."""
    usual = found.where(training).where("lang IS NOT NULL AND letters > 0 AND best IS NOT NULL")
    quantiles = usual.groupBy("best").agg(
        F.percentile_approx("entropy", 0.5).alias("middle"),
        F.percentile_approx("entropy", 0.99).alias("high"),
    )
    return {
        row["best"]: row["middle"] + slack * (row["high"] - row["middle"])
        for row in quantiles.collect()  # one row per language
    }


def decisions(found: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Adds `known` (a language could be named) and `rejected` to rows of `scored`."""
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]) if limits else None
    known = (F.col("letters") > 0) & F.col("best").isNotNull()
    above = F.lit(False)
    if limit is not None:
        allowed = F.element_at(limit, F.col("best")) + SHORT / F.sqrt(F.col("letters"))
        above = F.coalesce(known & (F.col("entropy") > allowed), F.lit(False))
    return found.withColumn("known", known).withColumn("rejected", ~known | above)


def _models_and_limits(
    documents: DataFrame, training: str, slack: float
) -> tuple[Models | None, DataFrame, dict[str, float]]:
    models = train(documents.where(training))
    found = stored(scored(documents.select("doc_id", "lang", "text"), models), "languages")
    return models, found, rejection_limits(found, training, slack)


def identify(documents: DataFrame, training: str, slack: float = SLACK) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1), rejected and entropy, one row per input row.

    `training` is a condition on doc_id; of the rows that meet it and have a language,
    models and rejection limits are learned. lang_pred is `und` with score 0 for a NULL
    text, a text without letters, and if there is nothing to learn from; these are
    rejected. Other rejected rows keep their closest language. A NULL doc_id or lang
    keeps a row out of training only; repeated rows count repeatedly; an empty table
    gives no rows.
    """
    prepared(documents.sparkSession)
    _, found, limits = _models_and_limits(documents, training, slack)
    return decisions(found, limits).select(
        "doc_id",
        F.when(F.col("known"), F.col("best")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("known"), F.col("score")).otherwise(0.0).alias("score"),
        "rejected",
        "entropy",
    )


def accepted(documents: DataFrame, training: str, slack: float = SLACK) -> DataFrame:
    """The documents, all columns, that are not rejected; decided row by row, so NULL or
    repeated ids do no harm."""
    spark = prepared(documents.sparkSession)
    models, _, limits = _models_and_limits(documents, training, slack)
    shared = spark.sparkContext.broadcast((models, limits))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, limits = shared.value
        for batch in batches:
            kept: list[bool] = []
            for group in small_groups([t or "" for t in batch.column("text").to_pylist()], AT_ONCE):
                if models is None:
                    kept += [False] * len(group)
                    continue
                h, _, letters = models.entropies(group)
                limit = np.array([limits.get(lang, np.inf) for lang in models.languages])
                allowed = limit[h.argmin(axis=1)] + SHORT / np.sqrt(np.maximum(letters, 1))
                kept += ((letters > 0) & (h.min(axis=1) <= allowed)).tolist()
            yield batch.filter(pa.array(kept, pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
