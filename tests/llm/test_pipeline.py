"""The registered queries and the pipeline on the smallest tables."""

import numpy as np
import odd
import pytest
from test_mixing import plain_targets
from test_simhash import expected as near_duplicates
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from flatweave.llm import common, language, pii, tokens
from flatweave.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op4": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
            "sequence_id": "bigint", "offset": "bigint"},
    "op6": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
            "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op7": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op8": {"doc_id": "bigint", "text": "string"},
    "op9": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op10": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
             "formatted_chars": "bigint"},
    "op12": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
    "op13": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
             "explained": "double", "identity_error": "double"},
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_query(spark, table, name):
    found = entry.queries()[name](spark, SF_DIR)
    wanted = COLUMNS[name.split("_")[0]]
    assert {column: kind for column, kind in found.dtypes if column in wanted} == wanted
    rows, number = found.count(), name.split("_")[0]
    if number == "op11":
        assert rows == table("conversations").select("conv_id").distinct().count() + 1
    elif number == "op12":
        assert rows >= table("documents").select("lang", "source").distinct().count()
    elif number == "op13":
        assert rows == 32 * table("embeddings").count()
    else:
        expected = table({"op4": "embeddings", "op7": "pages"}.get(number, "documents")).count()
        assert rows >= expected if number == "op5" else rows == expected


def test_every_number_has_one_query():
    assert sorted(name.split("_")[0] for name in QUERIES if name != "pipeline") == sorted(COLUMNS)
    assert entry.queries().keys() > QUERIES.keys()


def plain_stages(spark, documents):
    """Each stage's documents again, one after the other, without Spark's operators."""
    rows = [row.asDict() for row in documents.collect()]
    model = language.train_from(documents)
    labels, scores = language._shares(model, common.Vocabulary(model.emissions), [row["text"] for row in rows])
    rows = [row for row, label, score in zip(rows, labels, scores) if label != "und" and score >= language.MIN_SCORE]
    yield rows
    components = near_duplicates([(row["doc_id"], row["text"]) for row in rows])
    rows = [row for row, (own, _, least) in zip(rows, components) if own == least]
    yield rows
    yield [row | {"text": pii.replace(row["text"], pii.DEFAULT_KEY, lambda kind, normal: 0)[0]} for row in rows]


def test_pipeline_against_a_plain_version(spark, documents):
    docs, results = documents, []
    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, SF_DIR), f"test-{name}")
        results.append(docs)
    for found, expected in zip(results, plain_stages(spark, documents)):
        assert found.columns == documents.columns
        by_id = lambda row: row["doc_id"]
        assert sorted((row.asDict() for row in found.collect()), key=by_id) == sorted(expected, key=by_id)

    before, mixed = results[2].collect(), results[3].collect()
    known = {row.doc_id: row for row in before}
    assert all(known[row.doc_id] == row for row in mixed)
    size = lambda row: len(common.words_of(row.text))
    sizes = {}
    for row in before:
        sizes[row.source] = sizes.get(row.source, 0) + size(row)
    for source, target in plain_targets(sizes).items():
        taken = sum(size(row) for row in mixed if row.source == source)
        assert abs(taken - target) <= max(size(row) for row in before if row.source == source)

    pieces = results[4].collect()
    tokenizer = Tokenizer.from_file(tokens.public_tokenizer())
    tokenizer.encode_special_tokens = True
    total = sum(len(tokenizer.encode(row.text, add_special_tokens=False).ids) + 1 for row in mixed)
    assert sum(row.length for row in pieces) == total
    used = {}
    for row in pieces:
        used[row.sequence_id] = used.get(row.sequence_id, 0) + row.length
    assert max(used.values()) <= 2048 and len(used) <= np.ceil(total / 2048) * 1.02 + 1


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.count() > 100 and "sequence_id" in found.columns


def test_stages_bear_odd_rows_and_empty_tables(spark):
    for start in (odd.documents(spark), odd.no_documents(spark)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            # Each stage sees all the odd rows, which an earlier one would have rejected.
            docs = common.staged(stage(spark, start, SF_DIR), f"odd-{name}")
            if name != "packing":
                assert docs.columns == start.columns
        assert (docs.count() > 0) == (start.count() > 0)
