"""Text quality rules: counts of words, lines and windows, and compression bands."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from flatweave.llm.common import map_batches, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEAT_PERCENT = 50
WINDOW = 3
LEVEL = 3
CHUNK_BYTES = 4096
# From this length in bytes on, the compressed size lies between these shares of the plain one.
# Short texts compress badly whatever they say, long ones well, so the band narrows and sinks.
BANDS = ((0, 0.0, float("inf")), (256, 0.25, 1.05), (512, 0.22, 0.85), (2048, 0.18, 0.75), (8192, 0.15, 0.70))
CHUNK_BAND = (0.15, 0.75)
MOST_CHUNKS_OUTSIDE = 0.25

RULES_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, chunks_outside double, base_failed boolean, kept boolean"
)


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of words that occurs at least twice."""
    if len(words) < window + 1:
        return 0
    numbers: dict[str, int] = {}
    number = numbers.setdefault
    ids = np.fromiter((number(word, len(numbers)) for word in words), np.int64, len(words))
    codes = ids[: len(ids) - window + 1]
    for step in range(1, window):
        # Numbered again at each step, so that no code can overflow.
        codes = codes * len(numbers) + ids[step : len(ids) - window + 1 + step]
        codes, counts = np.unique(codes, return_inverse=True, return_counts=True)[1:]
    twice = counts[codes] > 1
    covered = np.zeros(len(ids), bool)
    for step in range(window):
        covered[step : len(ids) - window + 1 + step] |= twice
    return int(covered.sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    found = 0
    for line in text.split("\n"):
        if line in seen:
            found += 1
        elif words_of(line):
            seen.add(line)
    return found


def compression(content: bytes, press: zstandard.ZstdCompressor) -> tuple[float | None, float]:
    """Ratio of the whole, and the share of full chunks whose ratio lies outside the chunks' band."""
    if not content:
        return None, 0.0
    chunks = [content[at : at + CHUNK_BYTES] for at in range(0, len(content) - CHUNK_BYTES + 1, CHUNK_BYTES)]
    low, high = CHUNK_BAND
    outside = sum(not low <= len(press.compress(chunk)) / CHUNK_BYTES <= high for chunk in chunks)
    return len(press.compress(content)) / len(content), outside / len(chunks) if chunks else 0.0


def within_bands(size: int, ratio: float | None, chunks_outside: float) -> bool:
    """The method's verdict: neither repetitive nor incompressible, for its length."""
    if ratio is None:
        return True
    low, high = next((low, high) for least, low, high in reversed(BANDS) if size >= least)
    return low <= ratio <= high and chunks_outside <= MOST_CHUNKS_OUTSIDE


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdicts of (doc_id, text), a row for each row.

    A null text has no words; it and an empty one fail the base rules.  Null ids stay null.  Chunks are ``CHUNK_BYTES``
    each; a rest shorter than that counts in the whole only.
    """

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=LEVEL)
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            words = words_of(text)
            repeats = repeat_words(words)
            failed = len(words) < MIN_WORDS or 100 * repeats > MOST_REPEAT_PERCENT * len(words)
            content = text.encode()
            ratio, outside = compression(content, press)
            rows.append(
                {
                    "doc_id": doc_id,
                    "n_words": len(words),
                    "word_chars": sum(map(len, words)),
                    "n_symbols": sum(map(text.count, SYMBOLS)),
                    "n_dup_lines": dup_lines(text),
                    "n_repeat_words": repeats,
                    "ratio": ratio,
                    "chunks_outside": outside,
                    "base_failed": failed,
                    "kept": not failed and within_bands(len(content), ratio, outside),
                }
            )
        kinds = [("doc_id", pa.int64())]
        kinds += [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        kinds += [("ratio", pa.float64()), ("chunks_outside", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
        return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    return map_batches(docs.select("doc_id", "text"), measure, RULES_SCHEMA)
