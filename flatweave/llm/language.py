"""Languages of words and texts: a linear-chain conditional random field.

Each word is labelled.  Its features are prefixes and suffixes, letter trigrams and the language in which the
training texts use it nearly only (a lexicon); learned transitions join neighbours, so that a
code-switched text gets runs of labels.  Labels are the posterior of forward-backward.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatweave.llm.common import Vocabulary, give_back, hash_sample, held_out, kept_in_worker, slices_by_size, small_batches, words_of

UNKNOWN = "und"
HASH_BITS = 17
MOST_DOCUMENTS = 3_000
SEQUENCES, SEQUENCE_WORDS, SPAN_WORDS = 5_000, 64, (6, 40)
BATCH = 64
RATE = 0.25
LEXICON_WORDS, LEXICON_SHARE, LEXICON_COUNT = 20_000, 0.9, 3
MOST_CHARS_AT_ONCE = 600_000
MIN_SCORE = 1 / 3

_NOT_LETTERS = re.compile(r"[\W\d_]+")


class _Slots(dict):
    """Numbers of feature names; names of few letters come again and again."""

    def __missing__(self, name: str) -> int:
        if len(self) > 300_000:
            self.clear()
        slot = self[name] = zlib.crc32(name.encode()) & ((1 << HASH_BITS) - 1)
        return slot


_slots = _Slots()


def _features(word: str, lexicon: dict[str, str]) -> list[int]:
    """Hashed features; none for a word without letters."""
    letters = word if word.isalpha() else _NOT_LETTERS.sub("", word)
    if not letters:
        return []
    letters = letters.lower()
    edged = f"^{letters}$"
    names = [edged[at : at + 3] for at in range(len(edged) - 2)]
    names += ("p" + letters[:2], "p" + letters[:3], "s" + letters[-2:], "s" + letters[-3:])
    if letters in lexicon:
        names.append(f"lexicon {lexicon[letters]}")
    made = list(map(_slots.__getitem__, names))
    made.append(zlib.crc32(f"word {letters}".encode()) & ((1 << HASH_BITS) - 1))
    return made


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # feature, language
    start: np.ndarray
    moves: np.ndarray  # from, to
    lexicon: dict[str, str]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of each word for each language, and whether it has a letter."""
        made = np.zeros((len(words), len(self.languages) + 1), np.float32)
        lists = [_features(word, self.lexicon) for word in words]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        if sizes.any():
            own = np.flatnonzero(sizes)
            flat = np.concatenate([lists[at] for at in own]).astype(np.int64)
            starts = np.r_[0, np.cumsum(sizes[own])[:-1]]
            made[own, :-1] = np.add.reduceat(self.weights[flat], starts, axis=0)
            made[own, -1] = 1
        return made


def forward_backward(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Posteriors of every word of texts laid end to end, longest text first.

    All texts go forward, then backward, in step; those that have ended drop out.
    """
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))
    first = np.exp(start - start.max())
    across = np.exp(moves - moves.max())
    offsets = np.cumsum(lengths) - lengths
    # Texts of at least t + 1 words: a prefix, since lengths fall.
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
    forward = np.empty_like(psi)
    now = first * psi[offsets]
    now /= now.sum(axis=1, keepdims=True)
    forward[offsets] = now
    for t in range(1, lengths[0]):
        at = offsets[: active[t]] + t
        now = (now[: active[t]] @ across) * psi[at]
        now /= now.sum(axis=1, keepdims=True)
        forward[at] = now
    back = np.ones((len(lengths), psi.shape[1]), psi.dtype)
    gamma = forward
    for t in range(lengths[0] - 2, -1, -1):
        count = active[t + 1]
        following = (back[:count] * psi[offsets[:count] + t + 1]) @ across.T
        following /= following.sum(axis=1, keepdims=True)
        back[:count] = following
        gamma[offsets[:count] + t] *= following
    gamma /= gamma.sum(axis=1, keepdims=True)
    return gamma


def _lexicon(words: dict[str, Counter]) -> dict[str, str]:
    """The words that the training texts use nearly only in one language."""
    total: Counter = Counter()
    for counts in words.values():
        total.update(counts)
    chosen = {}
    for word, count in total.most_common(LEXICON_WORDS):
        language = max(words, key=lambda one: (words[one][word], one))
        if count >= LEXICON_COUNT and words[language][word] >= LEXICON_SHARE * count:
            chosen[word] = language
    return chosen


def train(texts: list[str], languages: list[str], seed: int = 7) -> Model:
    """Learns from sequences put together from spans of the texts, so that labels change within them.

    Weights follow the gradient of the log likelihood, scaled coordinate by coordinate (Adagrad).
    """
    names = sorted(set(languages))
    by_language = {name: [] for name in names}
    counts: dict[str, Counter] = {name: Counter() for name in names}
    for text, name in zip(texts, languages):
        words = words_of(text or "")
        if words:
            by_language[name].append(words)
            counts[name].update(filter(None, (_NOT_LETTERS.sub("", word).lower() for word in words)))
    names = [name for name in names if by_language[name]]
    model = Model(
        names, np.zeros((1 << HASH_BITS, len(names)), np.float32), np.zeros(len(names)), np.zeros((len(names),) * 2), {}
    )
    if not names:
        return model
    model.lexicon = _lexicon({name: counts[name] for name in names})
    random = np.random.default_rng(seed)
    numbers: dict[str, int] = {}
    lists: list[list[int]] = []
    k = len(names)
    squares, square_moves = np.full(model.weights.shape, 1e-6, np.float32), np.full((k + 1, k), 1e-6)

    def sequence() -> tuple[list[int], list[int]]:
        ids, labels = [], []
        while len(ids) < SEQUENCE_WORDS:
            label = int(random.integers(k))
            words = by_language[names[label]][random.integers(len(by_language[names[label]]))]
            span = int(random.integers(*SPAN_WORDS))
            at = int(random.integers(max(1, len(words) - span + 1)))
            for word in words[at : at + span]:
                number = numbers.setdefault(word, len(numbers))
                if number == len(lists):
                    lists.append(_features(word, model.lexicon))
                ids.append(number)
                labels.append(label)
        return ids[:SEQUENCE_WORDS], labels[:SEQUENCE_WORDS]

    for _ in range(SEQUENCES // BATCH):
        made = [sequence() for _ in range(BATCH)]
        ids, labels = (np.array(part) for part in zip(*made))
        own, back = np.unique(ids, return_inverse=True)
        back = back.reshape(-1)
        sizes = np.array([len(lists[at]) for at in own])
        flat = np.concatenate([np.array(lists[at], np.int64) for at in own]) if sizes.any() else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(own)), sizes)
        word_scores = np.zeros((len(own), k))
        np.add.at(word_scores, owner, model.weights[flat])
        scores = word_scores[back].reshape(BATCH, SEQUENCE_WORDS, k)

        psi = np.exp(scores - scores.max(axis=2, keepdims=True))
        first, across = np.exp(model.start), np.exp(model.moves)
        forward, backward = np.empty_like(psi), np.ones_like(psi)
        now = first * psi[:, 0]
        forward[:, 0] = now / now.sum(axis=1, keepdims=True)
        for t in range(1, SEQUENCE_WORDS):
            now = (forward[:, t - 1] @ across) * psi[:, t]
            forward[:, t] = now / now.sum(axis=1, keepdims=True)
        for t in range(SEQUENCE_WORDS - 2, -1, -1):
            now = (backward[:, t + 1] * psi[:, t + 1]) @ across.T
            backward[:, t] = now / now.sum(axis=1, keepdims=True)
        gamma = forward * backward
        gamma /= gamma.sum(axis=2, keepdims=True)
        pairs = forward[:, :-1, :, None] * across * (psi[:, 1:] * backward[:, 1:])[:, :, None, :]
        pairs /= pairs.sum(axis=(2, 3), keepdims=True)

        truth = np.eye(k)[labels]
        word_gradient = np.zeros((len(own), k))
        np.add.at(word_gradient, back, (truth - gamma).reshape(-1, k))
        gradient = np.zeros((len(flat), k), np.float32)
        gradient += word_gradient[owner]
        slots, where = np.unique(flat, return_inverse=True)
        summed = np.zeros((len(slots), k), np.float32)
        np.add.at(summed, where, gradient)
        summed -= 1e-3 * model.weights[slots]
        squares[slots] += summed**2
        model.weights[slots] += RATE * summed / np.sqrt(squares[slots])
        seen = np.zeros((k, k))
        np.add.at(seen, (labels[:, :-1].reshape(-1), labels[:, 1:].reshape(-1)), 1.0)
        moved = np.vstack([seen - pairs.sum(axis=(0, 1)), (truth[:, 0] - gamma[:, 0]).sum(axis=0)[None]])
        square_moves += moved**2
        step = RATE * moved / np.sqrt(square_moves)
        model.moves += step[:-1]
        model.start += step[-1]
    return model


def train_from(docs: DataFrame, most: int = MOST_DOCUMENTS) -> Model:
    """Learns from at most ``most`` rows with a language that are not held out, evenly by a hash of the id."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    rows = hash_sample(usable.select("doc_id", "text", "lang"), "doc_id", most).collect()
    rows.sort(key=lambda row: (row["doc_id"], row["text"], row["lang"]))
    model = train([row["text"] for row in rows], [row["lang"] for row in rows])
    rows.clear()
    _slots.clear()
    give_back()
    return model


def label_words(model: Model, text: str) -> list[tuple[str, str]]:
    """Each word with its likeliest language, ``und`` for a word without letters."""
    words = words_of(text)
    if not words or not model.languages:
        return [(word, UNKNOWN) for word in words]
    rows = model.emissions(words)
    gamma = forward_backward(rows[:, :-1].astype(np.float64), np.array([len(words)]), model.start, model.moves)
    best = gamma.argmax(axis=1)
    return [(word, model.languages[at] if has else UNKNOWN) for word, at, has in zip(words, best, rows[:, -1])]


def _shares(model: Model, vocabulary: Vocabulary, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The language with the most posterior over a text's words with letters, and its share."""
    labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return labels, scores
    sizes = np.fromiter((len(text or "") for text in texts), np.int64, len(texts))
    for part in slices_by_size(sizes, MOST_CHARS_AT_ONCE):
        split = [words_of(texts[at] or "") for at in part]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        order = np.argsort(-lengths, kind="stable")[: np.count_nonzero(lengths)]  # longest first
        part, lengths = part[order], lengths[order]
        if not len(part):
            continue
        rows = np.concatenate([vocabulary.rows(split[at]) for at in order])
        gamma = forward_backward(rows[:, :-1], lengths, model.start.astype(np.float32), model.moves.astype(np.float32))
        gamma = gamma * rows[:, -1:]
        starts = np.cumsum(lengths) - lengths
        total = np.add.reduceat(gamma.astype(np.float64), starts, axis=0)
        letters = np.add.reduceat(rows[:, -1].astype(np.float64), starts)
        for at, mass, words in zip(part, total, letters):
            if words:
                best = int(mass.argmax())
                labels[at] = model.languages[best]
                scores[at] = min(1.0, mass[best] / words)
    return labels, scores


def identify(model: Model, spark, text: Column | str = "text") -> Column:
    """struct<lang_pred, score>: ``und`` and 0 for a null text or one without letters.

    ``score`` is the mean posterior of the language over the text's words, so it falls where a text switches.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def labels(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        vocabulary = kept_in_worker(f"language-{own.key}", lambda: Vocabulary(own.emissions))
        found, scores = _shares(own, vocabulary, list(texts))
        return pd.DataFrame({"lang_pred": found, "score": scores})

    return labels(text)


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents of a known language, with the columns they came with.

    Rejected: null texts, texts without letters, and those of which no language has at least ``min_score``.
    """
    found = identify(train_from(docs), docs.sparkSession)
    kept = docs.withColumn("__llm_language", found)
    return kept.where(
        (F.col("__llm_language.lang_pred") != UNKNOWN) & (F.col("__llm_language.score") >= min_score)
    ).select(*docs.columns)
