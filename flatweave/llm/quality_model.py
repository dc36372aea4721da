"""A quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features are single words, pairs of words, and both of word shapes (letters, digits and signs collapsed), and
whether a word repeats the one before.  Within each kind a feature's value is its share of the text, so the score of a
text is a sparse dot product whatever its length.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import Vocabulary, give_back, hash_sample, held_out, kept_in_worker, small_batches, words_of

HASH_BITS = 20
MOST_LABELLED = 6_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-4
_KINDS = 5
_SCALE = 8.0

_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_LETTERS = re.compile(r"[^\W\d_A]+")
_DIGITS = re.compile(r"\d+")
_SAME = re.compile(r"(.)\1+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def shape(word: str) -> str:
    """Runs of capitals, other letters, digits and equal signs, each as one."""
    return _SAME.sub(r"\1", _DIGITS.sub("9", _LETTERS.sub("a", _UPPER.sub("A", word))))


def _hashes(words: list[str]) -> np.ndarray:
    """A hash of each word and one of its shape."""
    digest = xxhash.xxh64_intdigest
    found = [(digest(word), digest(shape(word), 1)) for word in words]
    return np.array(found, np.uint64).reshape(-1, 2)


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return ((hashes + np.uint64(kind)) * _MIX[0] >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _kinds_of(hashed: np.ndarray) -> list[np.ndarray]:
    """Feature numbers of each kind, repeats included."""
    word, form = hashed[:, 0], hashed[:, 1]
    pairs = word[:-1] * _MIX[1] + word[1:] * _MIX[2]
    forms = form[:-1] * _MIX[1] + form[1:] * _MIX[2]
    repeats = (word[1:] == word[:-1]).astype(np.uint64)
    return [_slots(one, kind) for kind, one in enumerate((word, pairs, form, forms, repeats))]


@dataclass
class Model:
    """Weights and the bias; ``key`` names the model in a worker's memory."""

    weights: np.ndarray
    bias: float
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def margin(self, hashed: np.ndarray) -> float:
        total = self.bias
        for slots in _kinds_of(hashed):
            if len(slots):
                total += _SCALE * float(self.weights[slots].mean())
        return total


def _sigmoid(margin: float) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35.0, 35.0)))


def train(texts: list[str | None], labels: list[int], epochs: int = EPOCHS) -> Model:
    """FTRL-proximal (McMahan et al., Ad click prediction) over the texts in the given order.

    Without texts every score is one half.
    """
    vocabulary = Vocabulary(_hashes)
    z, n = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    bias_z = bias_n = 0.0
    examples = []
    for text in texts:
        words = words_of(text or "")
        numbers, values = [], []
        for slots in _kinds_of(vocabulary.rows(words)) if words else []:
            if len(slots):
                own, counts = np.unique(slots, return_counts=True)
                numbers.append(own)
                values.append(counts * (_SCALE / len(slots)))
        if numbers:
            own, back = np.unique(np.concatenate(numbers), return_inverse=True)
            examples.append((own, np.bincount(back, np.concatenate(values))))
        else:
            examples.append((np.empty(0, np.int64), np.empty(0)))

    def weights_at(own):
        active = np.abs(z[own]) > L1
        made = (np.sign(z[own]) * L1 - z[own]) / ((BETA + np.sqrt(n[own])) / ALPHA + L2)
        return np.where(active, made, 0.0)

    for _ in range(epochs):
        for (own, values), label in zip(examples, labels):
            w = weights_at(own)
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
            error = _sigmoid(float(w @ values) + bias) - label
            gradient = error * values
            z[own] += gradient - (np.sqrt(n[own] + gradient**2) - np.sqrt(n[own])) / ALPHA * w
            n[own] += gradient**2
            bias_z += error - (np.sqrt(bias_n + error**2) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += error**2
    final = weights_at(np.arange(1 << HASH_BITS)).astype(np.float32)
    return Model(final, float(-bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> DataFrame:
    """At most ``most`` labelled rows that are not held out, evenly by a hash of the id: the bound of the model's input."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    usable = usable.groupBy("doc_id").agg(F.max(label).alias("__llm_label"))
    usable = hash_sample(usable, "doc_id", most)
    # Broadcast: at most ``most`` ids.  An id may have any number of rows, of which this many are enough.
    found = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id")
    return found.withColumn("__llm_order", F.xxhash64("text")).orderBy(F.xxhash64("doc_id"), "doc_id", "__llm_order").limit(most).drop("__llm_order")


def train_from(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> Model:
    """The sample is bounded, so the driver can learn from it."""
    rows = labelled_sample(docs, labels, label, most).collect()
    rows.sort(key=lambda row: (xxhash.xxh64_intdigest(str(row["doc_id"])), row["text"] or ""))
    model = train([row["text"] for row in rows], [row["__llm_label"] for row in rows])
    rows.clear()
    give_back()
    return model


def score(model: Model, spark, text: Column | str = "text") -> Column:
    """The chance that a text is good: 0 to 1; null and empty texts have that of the bias."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        own = shared.value
        vocabulary = kept_in_worker(f"quality-{own.key}", lambda: Vocabulary(_hashes))
        made = []
        for one in texts:
            words = words_of(one or "")
            made.append(_sigmoid(own.margin(vocabulary.rows(words)) if words else own.bias))
        return pd.Series(made, dtype="float64")

    return scores(text)
