"""A quality classifier of supervised subword embeddings.

A document is the mean of the vectors of its words, their character n-grams and its word pairs, all hashed into a table
of fixed size; a softmax layer turns it into the probability of label 1. Vectors and layer are learned by stochastic
gradient descent on a bounded sample of labelled rows (``sample_rows``). Scoring reads whole texts. Since a mean and a
linear layer change places freely, each distinct word of a stretch of texts is reduced to the sum of the layer over its
vectors, and the texts' sums follow from these by whole arrays.

Defined results: a text without words (null, empty or blank) scores what the layer's bias says. Labels that are null,
and labelled ids without a document, teach nothing; without any label every score is one half. Repeated labels count
each time. A null id keeps its row. Columns other than those named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quern.llm.shared import by_batch
from quern.llm.subwords import Bags, Subwords, featured, in_order, labelled, stretches

BUCKETS, WIDTH = 1 << 16, 8
#: Bytes of texts that are scored together.
AT_ONCE = 1 << 21


@dataclass
class Model:
    """Vectors of the buckets, and the output layer."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def margins(self) -> np.ndarray:
        """Each bucket's share in the difference of the two outputs."""
        return (self.vectors @ (self.layer[1] - self.layer[0])).astype(np.float64)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def train(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 20_000, rate: float = 4.0, seed: int = 7
) -> Model:
    """Stochastic gradient descent over whole rounds of the rows, with a rate that falls to zero."""
    random = np.random.default_rng(seed)
    vectors = ((random.random((BUCKETS, WIDTH), np.float32) - 0.5) / WIDTH).astype(np.float32)
    layer, bias = np.zeros((2, WIDTH), np.float32), np.zeros(2, np.float32)
    rounds = min(50, max(3, -(-steps // max(1, len(rows)))))
    done, whole = 0, rounds * len(rows)
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            place, times = rows[i]
            now, done = rate * (1 - done / whole), done + 1
            share = times / times.sum() if len(place) else times
            mean = share @ vectors[place] if len(place) else np.zeros(WIDTH, np.float32)
            out = layer @ mean + bias
            wrong = np.exp(out - out.max())
            wrong /= wrong.sum()
            wrong[labels[i]] -= 1
            back = layer.T @ wrong
            layer -= now * np.outer(wrong, mean)
            bias -= 0.1 * now * wrong
            if len(place):
                vectors[place] -= now * share[:, None] * back
    return Model(vectors, layer, bias)


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str, held_out: str = "false", sample_rows: int = 4_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> Model:
    """Learn ``label_col`` (0 or 1) from at most ``sample_rows`` labelled rows that are not held out (``held_out``: SQL on the id)."""
    chosen = labelled(labels, label_col, held_out, sample_rows, id_col)
    # At most sample_rows pairs of an id and a label: small enough to send to every task.
    rows = docs.select(F.col(id_col).alias("_id"), text_col).join(F.broadcast(chosen), "_id")
    table = featured(rows, text_col, ["_label"], Subwords(BUCKETS).counts)
    rows, marks = in_order(table, ["_label"])
    return train(rows, marks[:, 0])


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``: the probability of label 1 for every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast((model.margins(), model.offset()))  # 65,536 numbers
    subwords = Subwords(BUCKETS)
    place = docs.columns.index(text_col)

    def score(texts: pa.Array) -> np.ndarray:
        margins, offset = sent.value
        total, count = Bags(subwords, texts).sums(margins)
        return 1 / (1 + np.exp(-np.clip(offset + total / np.maximum(count, 1), -700, 700)))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [score(part) for part in stretches(batch.column(place), AT_ONCE)]
        column = pa.array(np.concatenate(found) if found else [], pa.float64())
        return pa.record_batch([*batch.columns, column], [*batch.schema.names, score_col])

    return by_batch(docs, make, StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    return scored(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), model).drop("text")
