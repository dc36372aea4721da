from itertools import product

import numpy as np
import odd
from pyspark.sql import functions as F

from flatweave.llm import common, language


def test_forward_backward_sums_over_all_paths():
    random = np.random.default_rng(3)
    lengths = np.array([5, 3, 1, 1])
    scores, start, moves = random.normal(size=(10, 3)), random.normal(size=3), random.normal(size=(3, 3))
    found = language.forward_backward(scores, lengths, start, moves)
    at = 0
    for length in lengths:
        own, expected = scores[at : at + length], np.zeros((length, 3))
        for path in product(range(3), repeat=int(length)):
            total = start[path[0]] + sum(own[t, label] for t, label in enumerate(path))
            total += sum(moves[a, b] for a, b in zip(path, path[1:]))
            for t, label in enumerate(path):
                expected[t, label] += np.exp(total)
        assert np.allclose(found[at : at + length], expected / expected.sum(axis=1, keepdims=True))
        at += length


def trained(spark):
    docs = common.read(spark, "/root/testdata/sf0.01", "documents")
    return docs, language.train_from(docs)


def test_held_out_texts_and_code_switching(spark):
    docs, model = trained(spark)
    found = docs.select("lang", "text", language.identify(model, spark).alias("f"), common.held_out().alias("held"))
    rows = [row for row in found.collect() if row.held]
    assert sum(row.lang == row.f.lang_pred for row in rows) > 0.99 * len(rows)
    assert all(0 <= row.f.score <= 1 for row in rows)
    texts = {}
    for row in rows:
        if len(row.text) > 600 and row.f.score > 0.97:
            texts.setdefault(row.lang, " ".join(row.text.split()[:30]))
    assert len(texts) >= 3
    # Words of a text that switches are labelled by their own part.
    mixed = " ".join(texts.values())
    truth = [name for name, text in texts.items() for _ in text.split()]
    labels = [label for _, label in language.label_words(model, mixed)]
    assert sum(a == b for a, b in zip(labels, truth)) > 0.8 * len(truth)
    shares = language._shares(model, common.Vocabulary(model.emissions), [mixed, *texts.values()])
    assert shares[1][0] < 0.6 < min(shares[1][1:])


def test_odd_rows(spark):
    docs, model = trained(spark)
    df = odd.documents(spark)
    rows = df.select("text", language.identify(model, spark).alias("f")).collect()
    assert len(rows) == df.count()
    for row in rows:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.f.lang_pred == "und") == (not letters)
        assert row.f.lang_pred in (*model.languages, "und") and (row.f.score > 0) == letters
    # A model of these rows: null languages and held out rows teach nothing.
    kept = language.keep_identified(df)
    assert kept.columns == df.columns and kept.count() <= df.where("text IS NOT NULL").count()


def test_nothing_to_learn(spark):
    df = odd.no_documents(spark)
    assert language.keep_identified(df).count() == 0
    model = language.train_from(df)
    rows = odd.documents(spark).select(language.identify(model, spark).alias("f")).collect()
    assert {(row.f.lang_pred, row.f.score) for row in rows} == {("und", 0.0)}


def test_text_of_many_words_is_read_whole(spark):
    docs, model = trained(spark)
    german = docs.where("lang = 'de'").select(F.max_by("text", F.length("text"))).first()[0]
    english = docs.where("lang = 'en'").select(F.min_by("text", F.abs(F.length("text") - 2000))).first()[0]
    text = english + " " + " ".join([german] * 30)
    labels, scores = language._shares(model, common.Vocabulary(model.emissions), [text])
    assert labels == ["de"] and scores[0] > 0.9
