"""Quality classifier without hand labels: overlapping heuristic labellers and a linear scorer.

Labellers look at one property of a text each and say clean, junk or nothing. Their accuracies are
estimated by expectation-maximisation (Dawid and Skene) from how often they agree over all documents:
the votes are counted by pattern, at most 3 ** len(LABELLERS) rows, and the driver iterates over
those. Every pattern thereby has a posterior probability of being clean. A logistic scorer over
hashed byte n-grams is trained on posteriors, on a sample of at most 2 * ``TRAINING_ROWS`` documents
picked by hash over the whole table, and then scores every whole text.

Nothing is shuffled but the pattern counts; the broadcast model has ``2 ** HASH_BITS`` numbers.

A null or blank text gets score 0 and is rejected. Repeated rows get equal scores. On an empty table
there is no model and no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmill.llm.common import BLANKS, pieces
from salesmill.llm.quality_rules import STOP_WORDS, words

JUNK, CLEAN, SILENT = 0, 1, 2
HASH_BITS = 15
#: About so many documents are trained on, picked by hash; at most twice as many.
TRAINING_ROWS = 4000
#: A document is kept from this probability of being clean on.
THRESHOLD = 0.3
#: What a labeller is believed to be worth beforehand, and the weight of that in documents.
PRIOR_ACCURACY, PRIOR_WEIGHT = 0.9, 0.01


@dataclass(frozen=True)
class Labeller:
    """Says junk if a measure is outside ``plausible``, clean if inside ``clean``, else nothing.

    What looks at one kind of junk only never says clean: its absence is no sign of anything.
    """

    measure: str
    plausible: tuple[float, float]
    clean: tuple[float, float] | None = None


LABELLERS = (
    Labeller("symbols_per_word", (0.0, 0.1)),
    Labeller("stop_word_share", (0.03, 1.0), clean=(0.12, 0.7)),
    Labeller("distinct_word_share", (0.2, 1.0), clean=(0.5, 1.0)),
    Labeller("distinct_pair_share", (0.5, 1.0), clean=(0.8, 1.0)),
    Labeller("upper_case_share", (0.0, 0.2)),
    Labeller("exclamations_per_word", (0.0, 0.1)),
    Labeller("chars_per_word", (3.5, 8.5)),
)


def votes(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep`` and ``votes``, an array with each labeller's word; all silent without words."""
    value = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(*keep, value.alias("_value"), words(value).alias("_words"))
    n = F.size("_words").cast("double")

    def per(count: Column, of: Column) -> Column:
        return F.try_divide(count.cast("double"), of)

    length = F.length("_value").cast("double")
    measures = {
        "symbols_per_word": per(F.regexp_count("_value", F.lit("[#*$%&|<>]")), n),
        "stop_word_share": per(F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))), n),
        "distinct_word_share": per(F.size(F.array_distinct("_words")), n),
        "distinct_pair_share": per(
            F.size(
                F.array_distinct(
                    F.transform(
                        "_words", lambda w, i: F.xxhash64(w, F.get(F.col("_words"), i + 1))
                    )
                )
            ),
            n,
        ),
        "upper_case_share": per(F.regexp_count("_value", F.lit("[A-Z]")), length),
        "exclamations_per_word": per(F.regexp_count("_value", F.lit("!!")), n),
        "chars_per_word": per(length, n),
    }
    measured = split.select(*keep, *(m.alias(f"_{name}") for name, m in measures.items()))

    def says(labeller: Labeller) -> Column:
        x = F.col(f"_{labeller.measure}")
        word = F.when(~x.between(*labeller.plausible), JUNK)
        if labeller.clean:
            word = word.when(x.between(*labeller.clean), CLEAN)
        return word.otherwise(SILENT)

    return measured.select(*keep, F.array(*(says(own) for own in LABELLERS)).alias("votes"))


@dataclass(frozen=True)
class LabelModel:
    """P(word | class) of each labeller as [labeller, class, word], and P(clean)."""

    words: np.ndarray
    clean: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(clean) for rows of words."""
        of = np.arange(patterns.shape[1])
        junk, clean = (np.log(self.words[of, c, patterns]).sum(1) for c in (JUNK, CLEAN))
        odds = clean - junk + np.log(self.clean / (1 - self.clean))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over patterns of words and how often they occur."""
    n, labellers = counts.sum(), patterns.shape[1]
    prior = np.empty((labellers, 2, 3))
    for c in (JUNK, CLEAN):
        prior[:, c, c], prior[:, c, 1 - c] = PRIOR_ACCURACY, 1 - PRIOR_ACCURACY
        prior[:, c, SILENT] = 0.5
    prior /= prior.sum(2, keepdims=True)
    model = LabelModel(prior, 0.8)
    shown = np.stack([patterns == word for word in range(3)], 2)  # pattern, labeller, word
    for _ in range(rounds):
        clean = model.posterior(patterns)
        weights = np.stack([counts * (1 - clean), counts * clean])
        seen = np.einsum("cp,plw->lcw", weights, shown) + prior * (PRIOR_WEIGHT * n + 1)
        share = (weights[CLEAN].sum() + 1) / (n + 2)
        model = LabelModel(seen / seen.sum(2, keepdims=True), float(share))
    return model


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of a text: places and weights of length one in all.

    The share of trigrams that are distinct is a feature of its own, in tenths.
    """
    mask = np.uint32((1 << HASH_BITS) - 1)
    data = np.frombuffer(f"  {text}  ".encode(errors="replace"), np.uint8)
    total = np.zeros(1 << HASH_BITS, np.float32)
    for at in range(0, len(data) - 2, 1 << 20):  # a piece at a time: texts may be very long
        b = data[at : at + (1 << 20) + 2].astype(np.uint32)
        mixed = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(0x9E3779B1)
        total += np.bincount((mixed >> np.uint32(32 - HASH_BITS)) & mask, minlength=len(total))
    places = np.flatnonzero(total)
    weights = np.log1p(total[places])
    weights /= np.sqrt((weights**2).sum())
    tenth = min(9, 10 * len(places) // max(1, len(data) - 2))
    return (
        np.append(places, tenth).astype(np.int32),
        np.append(weights, 0.5).astype(np.float32),
    )


def train(
    rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, rounds: int = 150
) -> np.ndarray:
    """Weights of a logistic scorer, the last one its constant, for probabilities as targets."""
    size = 1 << HASH_BITS
    weights = np.zeros(size + 1)
    if not rows:
        return weights
    place = np.concatenate([p for p, _ in rows])
    value = np.concatenate([v for _, v in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    # Junk is rarer: both classes weigh alike.
    share = np.clip(targets.mean(), 0.02, 0.98)
    weigh = targets / (2 * share) + (1 - targets) / (2 * (1 - share))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):  # Adam, over all rows at once
        odds = np.bincount(row, weights[place] * value, len(rows)) + weights[-1]
        error = weigh * (1 / (1 + np.exp(-np.clip(odds, -50, 50))) - targets) / len(rows)
        slope = np.append(np.bincount(place, error[row] * value, size), error.sum())
        slope[:-1] += 1e-6 * weights[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= 0.2 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return weights


@dataclass(frozen=True)
class Classifier:
    """The label model, its patterns and the scorer's weights."""

    labels: LabelModel
    weights: np.ndarray

    def probability(self, text: str | None) -> float:
        """P(clean); 0 for a null or blank text."""
        if not text or not text.strip(BLANKS):
            return 0.0
        places, values = features(text)
        odds = float(self.weights[places] @ values + self.weights[-1])
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Classifier | None:
    """Label model over all documents, scorer over a sample; None for an empty table."""
    counted = votes(docs, text).groupBy("votes").agg(F.count("*").alias("n")).collect()
    if not counted:
        return None
    labels = estimate(np.array([r.votes for r in counted]), np.array([r.n for r in counted], float))
    total = sum(r.n for r in counted)
    picked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(
        F.length(F.btrim("_text", F.lit(BLANKS))) > 0
    )
    if total > TRAINING_ROWS:
        places = 1 << 40
        draw = F.pmod(F.xxhash64("_key", "_text"), F.lit(places))
        picked = picked.where(draw < TRAINING_ROWS * places // total)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, "_text", 4_000_000):
            found = [features(t) for t in frame["_text"]]
            yield pd.DataFrame(
                {
                    "votes": frame["votes"],
                    "places": [p for p, _ in found],
                    "weights": [w for _, w in found],
                }
            )

    rows = (
        votes(picked, "_text", "_text")
        .select("_text", "votes")
        .mapInPandas(run, "votes array<int>, places array<int>, weights array<float>")
        .limit(2 * TRAINING_ROWS)
        .toPandas()
    )
    targets = labels.posterior(np.array(rows["votes"].tolist()).reshape(-1, len(LABELLERS)))
    return Classifier(labels, train(list(zip(rows["places"], rows["weights"], strict=True)), targets))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (probability of being clean) and ``kept`` of every row."""
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    model = fit(docs, key, text)
    scored = rows.select(key, probability(model, docs)("_text").alias("score"))
    return scored.withColumn("kept", F.col("score") >= THRESHOLD)


def probability(model: Classifier | None, docs: DataFrame):
    """The scorer as a function on columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def own(texts: pd.Series) -> pd.Series:
        if shared.value is None:
            return texts.map(lambda _: 0.0)
        return texts.map(shared.value.probability)

    return own


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are."""
    model = fit(docs, key, text)
    return docs.where(probability(model, docs)(F.col(text)) >= THRESHOLD)
