"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models, linear in hashed words and character n-grams. Each
model also reads the probabilities of the categories before it. When it is trained, those probabilities are out of
fold: every labelled text gets them from a model that has not seen it. Models are fitted on a bounded sample of labelled
rows (``sample_rows``); scoring reads whole texts.

Weights are found by follow-the-regularised-leader descent, whose first-order penalty leaves the many n-grams that say
nothing at zero, so that long texts don't add up noise.

Defined results: a text without words has the probabilities of the offsets alone. Null labels teach nothing; a
category without rows of both kinds gets its known share everywhere (0 without rows). A null id keeps its row. Repeated
rows count each time. Columns other than those named are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import by_batch
from quern.llm.subwords import REMEMBERED, Subwords, featured, in_order, labelled

BUCKETS = 1 << 18
SHORTEST, LONGEST = 4, 6
#: What a probability of an earlier category is multiplied with, to be as strong as a few words.
CHAIN_WEIGHT = 4.0
FOLDS = 3

#: Common words of contempt by what they are aimed at, as weak labels of the first categories.
MIND = ("idiot", "moron", "stupid", "dumb", "imbecile", "clown", "fool")
WORTH = ("worthless", "pathetic", "loser", "trash", "scum", "garbage", "disgusting", "useless")

_words = re.compile(r"\w+").findall


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"(?i)\b(" + "|".join(words) + r")\b").cast("int")


class Distinct(Subwords):
    """Buckets of the distinct words of a text in lower case, and in how many of them each occurs."""

    def __init__(self) -> None:
        super().__init__(BUCKETS, SHORTEST, LONGEST, pairs=False)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        own = [self.of_word(word) for word in set(_words((text or "").lower()))]
        if not own:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        place, times = np.unique(np.concatenate(own), return_counts=True)
        return place, times.astype(np.float32)


@dataclass
class Linear:
    """One category's weights of buckets and of earlier categories, and its offset."""

    weights: np.ndarray
    chain: np.ndarray
    offset: float

    def probability(self, place: np.ndarray, times: np.ndarray, before: np.ndarray) -> float:
        out = self.offset + float(self.weights[place] @ times) + float(self.chain @ before)
        return float(1 / (1 + np.exp(-np.clip(out, -30, 30))))


def descend(rows, before: np.ndarray, labels: np.ndarray, which: np.ndarray, rounds: int = 3, seed: int = 7) -> Linear:
    """Fit one model on the rows in ``which``; alpha 0.1, beta 1, first-order penalty 3 (none on the chain)."""
    alpha, beta, penalty = 0.1, 1.0, 3.0
    width = before.shape[1]
    if not len(which) or labels[which].min() == labels[which].max():
        share = float(labels[which].mean()) if len(which) else 0.0
        return Linear(np.zeros(BUCKETS), np.zeros(width), 30.0 if share else -30.0)
    z, n = np.zeros(BUCKETS + width), np.zeros(BUCKETS + width)
    offset, seen = 0.0, 0.0
    own = np.arange(BUCKETS, BUCKETS + width)
    random = np.random.default_rng(seed)

    def weights_of(z: np.ndarray, n: np.ndarray, least: np.ndarray) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - least, 0) * alpha / (beta + np.sqrt(n))

    for _ in range(rounds):
        for i in random.permutation(which):
            place = np.concatenate([rows[i][0], own])
            value = np.concatenate([rows[i][1], before[i]])
            least = np.where(place < BUCKETS, penalty, 0.0)
            weight = weights_of(z[place], n[place], least)
            wrong = 1 / (1 + np.exp(-np.clip(weight @ value + offset, -30, 30))) - labels[i]
            slope = wrong * value
            z[place] += slope - (np.sqrt(n[place] + slope * slope) - np.sqrt(n[place])) / alpha * weight
            n[place] += slope * slope
            seen += wrong * wrong
            offset -= 0.1 * wrong / np.sqrt(1 + seen)
    found = weights_of(z, n, np.where(np.arange(BUCKETS + width) < BUCKETS, penalty, 0.0))
    return Linear(found[:BUCKETS], found[BUCKETS:], float(offset))


def train_chain(rows, labels: np.ndarray) -> list[Linear]:
    """A model for each column of ``labels``, in order. Folds go by the place of a row."""
    fold = np.arange(len(rows)) % FOLDS
    before, models = np.zeros((len(rows), 0)), []
    for k in range(labels.shape[1]):
        mark = labels[:, k]
        models.append(descend(rows, before, mark, np.arange(len(rows))))
        if k + 1 == labels.shape[1]:
            break
        unseen = np.zeros((len(rows), 1))
        for part in range(FOLDS):
            model = descend(rows, before, mark, np.flatnonzero(fold != part))
            for i in np.flatnonzero(fold == part):
                unseen[i] = CHAIN_WEIGHT * model.probability(*rows[i], before[i])
        before = np.concatenate([before, unseen], 1)
    return models


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", held_out: str = "false",
    categories: dict[str, tuple[str, ...]] | None = None, sample_rows: int = 6_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> list[Linear]:
    """Models of ``categories`` (weak labels: the text has one of the words) and last of ``label_col``."""
    named = {"mind": MIND, "worth": WORTH} if categories is None else categories
    chosen = labelled(labels, label_col, held_out, sample_rows, id_col)
    # At most sample_rows pairs of an id and a label: small enough to send to every task.
    rows = docs.select(F.col(id_col).alias("_id"), text_col).join(F.broadcast(chosen), "_id")
    rows = rows.select(text_col, *[contains_any(F.col(text_col), w).alias(f"_c{k}") for k, w in enumerate(named.values())], "_label")
    marks = [*(f"_c{k}" for k in range(len(named))), "_label"]
    table = featured(rows, text_col, marks, Distinct().counts)
    return train_chain(*in_order(table, marks))


def probabilities(
    docs: DataFrame, models: list[Linear], names: list[str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, a probability for each name) for every whole text; the models run in order, each fed by those before."""
    # A fixed number of buckets for each category, most of them zero.
    weights = np.stack([m.weights for m in models], 1).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast((weights, [m.chain for m in models], [m.offset for m in models]))
    subwords, seen = Distinct(), {}
    nothing = np.zeros(len(models))

    def score(text: str | None) -> list[float]:
        weights, chains, offsets = sent.value
        total = nothing.copy()
        for word in set(_words((text or "").lower())):
            known = seen.get(word)
            if known is None:
                if len(seen) > 2 * REMEMBERED:
                    seen.clear()
                own = weights[subwords.of_word(word)].sum(0, dtype=np.float64)
                seen[word] = known = own if own.any() else False
            if known is not False:
                total += known
        out: list[float] = []
        for k in range(len(total)):
            z = offsets[k] + total[k] + sum(c * CHAIN_WEIGHT * p for c, p in zip(chains[k], out, strict=True))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([score(t.as_py()) for t in batch.column(1)]).reshape(-1, len(names))
        return pa.record_batch([batch.column(0), *map(pa.array, found.T)], ["id", *names])

    schema = ", ".join(["id long", *(f"{n} double" for n in names)])
    return by_batch(docs.select(F.col(id_col).cast("long").alias("id"), text_col), make, schema)
