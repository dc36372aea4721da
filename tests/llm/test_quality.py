import base64
import re
import zlib

import numpy as np
import odd
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flatweave.llm import common, quality_model, quality_rules


def plain_rules(text):
    text = text or ""
    words = re.findall(common.WORD, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    dups = sum(bool(re.search(common.WORD, line)) and line in lines[:i] for i, line in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dups, len(covered), failed


def rules_of(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab é\n\t#", max_size=80))
def test_counts(text):
    words = common.words_of(text)
    n_words, _, _, dups, repeats, _ = plain_rules(text)
    assert (len(words), quality_rules.dup_lines(text), quality_rules.repeat_words(words)) == (n_words, dups, repeats)


def plain_verdict(text):
    """The bands again, read from their table by hand."""
    press = zstandard.ZstdCompressor(level=3)
    content = (text or "").encode()
    if not content:
        return True
    ratio = len(press.compress(content)) / len(content)
    low, high = [(low, high) for least, low, high in quality_rules.BANDS if len(content) >= least][-1]
    chunks = [content[i : i + 4096] for i in range(0, len(content), 4096)]
    chunks = [len(press.compress(c)) / 4096 for c in chunks if len(c) == 4096]
    outside = sum(not 0.15 <= c <= 0.75 for c in chunks)
    return low <= ratio <= high and outside <= 0.25 * len(chunks)


@pytest.mark.parametrize("source", ["documents", "odd"])
def test_rules(spark, documents, source):
    df = documents.where(F.length("text") < 4000) if source == "documents" else odd.documents(spark)
    small = df.where("text IS NULL OR length(text) < 20000")
    found = quality_rules.quality_rules(small).collect()
    expected = [(str(row.doc_id), *plain_rules(row.text), plain_verdict(row.text)) for row in small.collect()]
    expected = [(*one[:-1], one[-1] and not one[-2]) for one in expected]
    assert sorted((str(row.doc_id), *rules_of(row), row.kept) for row in found) == sorted(expected)
    assert quality_rules.quality_rules(df).count() == df.count()


def test_bands_reject_repetition_and_noise():
    press = zstandard.ZstdCompressor(level=3)
    random = np.random.default_rng(1)
    words = ["".join(random.choice(list("aeinorst"), random.integers(1, 9))) for _ in range(400)]
    prose = " ".join(random.choice(words, 3_000))
    noise = base64.b64encode(random.bytes(9_000))
    for content, kept in ((prose.encode(), True), (b"again and " * 900, False), (noise, False)):
        assert quality_rules.within_bands(len(content), *quality_rules.compression(content, press)) is kept


def test_rules_of_nothing(spark):
    assert quality_rules.quality_rules(odd.no_documents(spark)).count() == 0


def test_model_tells_held_out_texts_apart(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = common.read(spark, folder, "documents"), common.read(spark, folder, "labels")
    model = quality_model.train_from(docs, labels)
    scored = docs.select("doc_id", common.held_out().alias("held"), quality_model.score(model, spark).alias("score"))
    rows = [row for row in scored.join(labels, "doc_id").where("held").collect()]
    good = [row.score for row in rows if row.quality == 1]
    bad = [row.score for row in rows if row.quality == 0]
    assert len(bad) > 10
    area = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert area > 0.97
    assert sum((row.score >= 0.5) == (row.quality == 1) for row in rows) > 0.95 * len(rows)


def test_held_out_rows_and_odd_labels_are_not_learnt(spark):
    docs = odd.documents(spark)
    labels = spark.createDataFrame([(i, q) for i in range(-5, 14) for q in (i % 2, None, 7)], "doc_id long, quality int")
    sample = quality_model.labelled_sample(docs, labels).collect()
    assert sample and all(zlib.crc32(str(row.doc_id).encode()) % 3 != 1 for row in sample)
    assert {row["__llm_label"] for row in sample} <= {0, 1}
    assert len(quality_model.labelled_sample(docs, labels, most=2).select("doc_id").distinct().collect()) <= 2
    model = quality_model.train_from(docs, labels)
    scores = [row[0] for row in docs.select(quality_model.score(model, spark)).collect()]
    assert len(scores) == docs.count() and all(0 <= score <= 1 for score in scores)


def test_model_of_nothing(spark):
    model = quality_model.train_from(odd.no_documents(spark), spark.createDataFrame([], "doc_id long, quality int"))
    assert {row[0] for row in odd.documents(spark).select(quality_model.score(model, spark)).collect()} == {0.5}
    assert odd.no_documents(spark).select(quality_model.score(model, spark)).count() == 0


def test_vocabulary_forgets_without_losing_rows():
    small, large = (common.Vocabulary(quality_model._hashes, most) for most in (3, 10_000))
    for words in (["a", "b", "a"], ["c", "d", "e", "f"], ["a", "g"], [], ["f"]):
        assert (small.rows(words) == large.rows(words)).all()
        assert len(small.rows(words)) == len(words)


def test_training_rows_are_bounded_however_often_an_id_repeats(spark):
    docs = spark.range(10_000).selectExpr("CAST(id % 2 AS BIGINT) AS doc_id", "concat('text ', id) AS text")
    docs = docs.unionByName(spark.createDataFrame([(i, "other") for i in range(2, 12)], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    rows = quality_model.labelled_sample(docs, labels, most=50).collect()
    assert len(rows) == 50
    assert len(quality_model.labelled_sample(docs.where("doc_id > 1"), labels, most=50).collect()) <= 10


def plain_features(text):
    """Weights of hashed word and shape features, in a dictionary: each kind's counts share one scale."""
    mask, mix = (1 << 64) - 1, [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]
    words = re.findall(common.WORD, text)
    word = [xxhash.xxh64_intdigest(w) for w in words]
    form = [xxhash.xxh64_intdigest(quality_model.shape(w), 1) for w in words]

    def pairs(one):
        return [(a * mix[1] + b * mix[2]) & mask for a, b in zip(one, one[1:])]

    made = {}
    for kind, hashes in enumerate((word, pairs(word), form, pairs(form), [int(a == b) for a, b in zip(word, word[1:])])):
        for one in hashes:
            slot = (((one + kind) * mix[0]) & mask) >> (64 - quality_model.HASH_BITS)
            made[slot] = made.get(slot, 0.0) + 8.0 / len(hashes)
    return made


def test_training_and_scores_against_plain_dictionaries(documents):
    """FTRL-proximal one weight at a time, then sparse dot products."""
    rows = [row.text or "" for row in documents.orderBy("doc_id").limit(40).collect() if len(row.text or "") < 3_000]
    labels = [i % 3 == 0 for i in range(len(rows))]
    alpha, beta, l1, l2 = quality_model.ALPHA, quality_model.BETA, quality_model.L1, quality_model.L2
    z, n = {}, {}

    def weight(key, flat=False):
        if not flat and abs(z.get(key, 0.0)) <= l1:
            return 0.0
        if flat:
            return -z.get(key, 0.0) / ((beta + n.get(key, 0.0) ** 0.5) / alpha)
        sign = 1 if z[key] > 0 else -1
        return (sign * l1 - z[key]) / ((beta + n.get(key, 0.0) ** 0.5) / alpha + l2)

    def update(key, gradient, w):
        before = n.get(key, 0.0)
        z[key] = z.get(key, 0.0) + gradient - ((before + gradient**2) ** 0.5 - before**0.5) / alpha * w
        n[key] = before + gradient**2

    for _ in range(quality_model.EPOCHS):
        for text, label in zip(rows, labels):
            own = plain_features(text)
            w = {slot: weight(slot) for slot in own}
            bias = weight("bias", flat=True)
            error = 1 / (1 + np.exp(-(sum(w[s] * v for s, v in own.items()) + bias))) - label
            for slot, value in own.items():
                update(slot, error * value, w[slot])
            update("bias", error, bias)
    model = quality_model.train(rows, [int(label) for label in labels])
    assert model.bias == pytest.approx(weight("bias", flat=True), abs=1e-9)
    vocabulary = common.Vocabulary(quality_model._hashes)
    for text in rows:
        margin = sum(weight(slot) * value for slot, value in plain_features(text).items()) + weight("bias", flat=True)
        words = common.words_of(text)
        found = model.margin(vocabulary.rows(words)) if words else model.bias
        assert found == pytest.approx(margin, abs=1e-4)
