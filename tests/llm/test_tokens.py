import random
import sys
import zlib

import numpy as np
import odd
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flatweave.llm import common, packing, token_files, tokens
from flatweave.session import new_stage_path


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokens.public_tokenizer())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = [
    "a  b", "a \nb", " lead", "trail ", "a  b", "x　y z", "\n a", "", "  ", " ", None, "a\x1c b", "a \x85b", "don't can't",
    "<|endoftext|> a b<|endoftext|>", "q\r\n r", "​ z w​ v", "你好 世界", "9 99 999", "a  b",
]


@pytest.mark.parametrize("most", [600, 160 << 20])
def test_ids_are_those_of_whole_texts(documents, plain, most):
    texts = ODD_TEXTS + [row.text for row in documents.select("text").collect()] + [text for _, text, *_ in odd.rows()]
    encoder = tokens.Encoder(tokens.public_tokenizer(), most)
    for _ in range(2):
        found = [np.frombuffer(ids, "<u4").tolist() for first in range(0, len(texts), 50) for ids in encoder.ids(texts[first : first + 50])]
        assert found == [plain(text) for text in texts]


def written(spark, df, **options):
    folder = new_stage_path(spark, "test-ids")
    return token_files.write_token_files(df, folder, **options), folder


@pytest.mark.parametrize("size", [1, 64 << 20])
def test_files_hold_every_document_in_order(spark, documents, plain, size):
    files, folder = written(spark, documents, max_file_bytes=size)
    found = [tuple(row) for row in token_files.read_token_files(files, folder).orderBy("doc_id").collect()]
    start, expected = 0, []
    for row in documents.orderBy("doc_id").collect():
        ids = np.array([*plain(row.text), 0], "<u4").tobytes()
        expected.append((row.doc_id, start, len(ids) // 4, ids))
        start += len(ids) // 4
    assert found == expected
    assert files.agg(F.sum("docs")).first()[0] == len(expected)


def test_reader_takes_single_documents_and_sees_damage(spark, documents, plain, tmp_path):
    files, folder = written(spark, documents.coalesce(1))
    wanted = documents.orderBy(F.desc("doc_id")).first()
    name = files.orderBy(F.desc("file")).first().file
    reader = token_files.Reader(f"{folder}/{name}")
    assert reader.find(wanted.doc_id) == [np.array([*plain(wanted.text), 0], "<u4").tobytes()]
    # Any zstandard tool reads the frames one after the other.
    content = open(f"{folder}/{name}", "rb").read()
    with zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True) as stream:
        assert stream.read() == b"".join(reader.ids(number) for number in range(len(reader.docs)))
    assert zlib.crc32(reader.ids(0)) != 0
    reader.table[0, 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        reader.ids(0)
    broken = tmp_path / "broken.ids.zst"
    broken.write_bytes(content[:-1] + b"?")
    with pytest.raises(ValueError, match="not a seekable file"):
        token_files.Reader(str(broken))


def test_files_of_odd_rows(spark, plain):
    df = odd.documents(spark)
    files, folder = written(spark, df)
    found = token_files.read_token_files(files, folder).collect()
    expected = sorted((row.doc_id is not None, row.doc_id or 0, len(plain(row.text)) + 1) for row in df.collect())
    assert sorted((row.doc_id is not None, row.doc_id or 0, row.n_tokens) for row in found) == expected
    in_order = sorted(found, key=lambda row: row.start)
    assert [row.start for row in in_order] == np.cumsum([0, *(row.n_tokens for row in in_order[:-1])]).tolist()
    ids = [row.doc_id for row in in_order]
    assert ids == sorted(ids, key=lambda one: (one is not None, one or 0))
    files, folder = written(spark, odd.no_documents(spark))
    assert files.count() == 0 and token_files.read_token_files(files, folder).count() == 0


def check_packing(rows, capacity=packing.SEQUENCE_TOKENS):
    places = {}
    for row in rows:
        places.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in places.values():
        parts.sort()
        ends = np.cumsum([length for _, length in parts])
        assert ends[-1] <= capacity
        assert [offset for offset, _ in parts] == [0, *ends[:-1].tolist()]
    return len(places)


@pytest.mark.parametrize("source", ["documents", "odd"])
def test_packing(spark, documents, plain, source):
    df = documents if source == "documents" else odd.documents(spark)
    packed = packing.pack_documents(df)
    rows = packed.collect()
    used = check_packing(rows)
    lengths = np.array([row.length for row in rows])
    assert packing.lower_bound(lengths, 2048) <= used <= packing.lower_bound(lengths, 2048) + 1
    assert all(zlib.crc32(row.ids) == row.ids_crc32 and len(row.ids) == 4 * row.length for row in rows)
    expected = []
    for row in df.collect():
        ids, start = [*plain(row.text), 0], 0
        for number, length in enumerate(packing.cut(len(ids), 2048)):
            expected.append((str(row.doc_id), number, start, np.array(ids[start : start + length], "<u4").tobytes()))
            start += length
    assert sorted((str(r.doc_id), r.piece, r.start, bytes(r.ids)) for r in rows) == sorted(expected)
    joined = packing.sequences(packed).collect()
    assert len(joined) == used and sum(len(row.ids) for row in joined) == 4 * lengths.sum()


def test_cut():
    assert packing.cut(1, 8) == [1] and packing.cut(8, 8) == [8]
    assert packing.cut(17, 8) == [1, 8, 8] and packing.cut(16, 8) == [8, 8]


def test_exchange_between_partitions_saves_bins(spark):
    random = np.random.default_rng(1)
    lengths = random.integers(1, 120, 1_500).tolist()
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], f"{packing.PIECE} long, length long")
    counts = []
    for rounds in (1, 6):
        placed = packing.pack_pieces(frame, 120, partition_pieces=150, rounds=rounds).join(frame, packing.PIECE)
        rows = placed.collect()
        assert sorted(row[packing.PIECE] for row in rows) == list(range(1_500))
        counts.append(check_packing(rows, 120))
    assert counts[1] < counts[0]
    assert counts[1] <= 1.015 * packing.lower_bound(np.array(lengths), 120)


def test_lower_bounds_never_pass_the_optimum():
    # Optimum known: bins cut into parts without waste.
    random = np.random.default_rng(2)
    for _ in range(50):
        lengths = []
        for _ in range(10):
            cuts = np.sort(random.choice(np.arange(1, 60), random.integers(0, 4), replace=False))
            lengths += np.diff([0, *cuts, 60]).tolist()
        assert packing.lower_bound(np.array(lengths), 60) == 10
    assert packing.lower_bound(np.array([31] * 7), 60) == 7  # more than half each
    assert packing.lower_bound(np.array([21] * 6), 60) == 3


def test_packing_nothing(spark):
    assert packing.pack_documents(odd.no_documents(spark)).count() == 0


def test_a_workers_store_is_bounded_in_bytes():
    """Runs without spaces, of any length: ids stay right, and what is kept stays small."""
    rng = random.Random(3)
    runs = ["".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(rng.choice((3, 40, 60, 5_000)))) for _ in range(4_000)]
    texts = [" ".join(runs[i : i + 40]) for i in range(0, len(runs), 40)]
    encoder = tokens.Encoder(tokens.public_tokenizer(), most=200_000)
    plain = Tokenizer.from_file(tokens.public_tokenizer())
    plain.encode_special_tokens = True
    for text in texts:
        ids = np.frombuffer(encoder.ids([text])[0], "<u4").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids
    kept = sum(sys.getsizeof(w) + sys.getsizeof(i) for d in (encoder._known, encoder._first) for w, i in d.items())
    assert encoder.bytes <= 200_000 and kept <= 200_000
    assert max(map(len, [*encoder._known, *encoder._first])) <= common.LONGEST_KEPT


SIGNS = [
    *[" "] * 12, "a", "the", "Ab", "\u00e9", "\u00d1", "\u00d7", "\u00f7", "\u00ff", "\u024f", "\u0250", "\u0434", "\u047f", "\u0482", "1", "22", "\u00b2", "\u0663",
    ".", ",", "&&&", "|", "_", "'", "'s", "don't", "\u2019", "\u2014", "\n", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x00", "\x7f", "\x85", "\xa0", "\xad", "\u1680",
    "\u180e", "\u2003", "\u200b", "\u200d", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\u4f60", "\u304b", "\ud55c", "\U0001f600", "e\u0301", "\u03a9", "\u0627", "<|endoftext|>",
]


def test_ids_of_texts_cut_into_pieces(plain, monkeypatch):
    """Random texts of signs that meet in every way, as a list and as a part of an Arrow column, in any portions."""
    rng = random.Random(5)
    texts = ["".join(rng.choices(SIGNS, k=rng.randrange(30))) for _ in range(4_000)] + [None, "", None]
    expected = [plain(text) for text in texts]
    column = pa.array(["before", *texts, "after"])
    for at_once, pieces in ((tokens._BYTES_AT_ONCE, tokens._PIECES_AT_ONCE), (100, 7)):
        monkeypatch.setattr(tokens, "_BYTES_AT_ONCE", at_once)
        monkeypatch.setattr(tokens, "_PIECES_AT_ONCE", pieces)
        encoder = tokens.Encoder(tokens.public_tokenizer())
        for given in (texts, column[1:-1]):
            assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.ids(given)] == expected
    assert encoder.ids([]) == [] and encoder.ids(column[:0]) == []


def test_pieces_are_encoded_once(plain, monkeypatch):
    """Signs and line ends do not make new pieces of known words."""
    encoder = tokens.Encoder(tokens.public_tokenizer())
    encoder.ids(["Alpha beta gamma. x\nBeta\nGamma,"])
    for name in ("_whole", "_pieces"):
        monkeypatch.setattr(encoder, name, lambda pieces: pytest.fail(f"encoded again: {pieces}") if pieces else [])
    text = "Alpha.\nGamma beta,\nBeta gamma,\nAlpha x."
    assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == plain(text)


def test_a_new_operator_clears_the_stores_of_others():
    first = common.kept_in_worker("one", lambda: [1])
    assert common.kept_in_worker("one", lambda: [2]) is first
    common.kept_in_worker("two")
    assert common.kept_in_worker("one", lambda: [3]) == [3]


def test_vocabulary_is_bounded_in_bytes():
    made = common.Vocabulary(lambda words: np.array([[len(w), hash(w) & 0xFFFF] for w in words]).reshape(len(words), 2), most=50_000)
    for first in range(0, 3_000, 50):
        words = [f"w{i}" * (1 + i % 40) for i in range(first, first + 50)] + ["same", f"w{first}"]
        assert made.rows(words).tolist() == [[len(w), hash(w) & 0xFFFF] for w in words]
        assert made.bytes <= 50_000
    assert max(map(len, made._numbers)) <= common.LONGEST_KEPT
