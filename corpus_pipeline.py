"""From raw documents to packed training sequences: language, near duplicates, personal data, mix, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from flatweave.llm import language, mixing, packing, pii, simhash
from flatweave.llm.common import read, recording, staged
from flatweave.session import drop_stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []


def _owned(stage: Stage) -> Stage:
    """A stage that first drops the tables that the stage called before it has staged.

    A stage's result is written before the next one is called, so nothing reads them any more.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            path = _left.pop()
            if spark.sparkContext.applicationId in path:  # not those of an application that has ended
                drop_stage(spark, path)
        with recording() as paths:
            result = stage(spark, docs, sf_dir)
        _left.extend(paths)
        return result

    return run_stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those that the classifier rejects go.

    Rejected are null texts, those without letters, and those of which no language has a third.
    """
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Texts without words are near copies of each other; of rows with one id, and of rows without, one stays for each group.
    """
    return simhash.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates in place of personal data and secrets; null and empty texts stay as they are, and all rows."""
    return pii.replace_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, which may be not at all; null sources are a source, texts without words go."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences, with their token ids (little-endian unsigned 32-bit integers).

    Each row is a document of its own, repeated or not; a null text is empty, and an empty one is a piece of the end id.
    """
    return packing.pack_documents(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language", _owned(identify_language)),
    ("near_duplicates", _owned(drop_near_duplicates)),
    ("personal_data", _owned(replace_personal_data)),
    ("mix", _owned(mix_sources)),
    ("packing", _owned(pack)),
]

# No stage can be expressed in DuckDB's SQL; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    A result goes when that of the next stage is written; an empty table goes through all of them.
    """
    docs, before = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with recording() as written:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        for path in before:
            drop_stage(spark, path)
        before = written
    return docs
