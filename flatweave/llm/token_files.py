"""Token ids in seekable zstandard files: one frame for each document.

A file is a row of independent zstandard frames, one for each document, holding its ids as
little-endian unsigned 32-bit integers.  Two skippable frames follow: the ids of the
documents, and the seek table of the published seekable format (sizes and a checksum of
each frame: the low 32 bits of XXH64 of its content).  A reader opens the table from the end of the file and
decompresses only the frames it wants; any zstandard tool can decompress the whole file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flatweave.llm import tokens
from flatweave.llm.common import small_batches, staged

# Fixed values of the published formats.
SEEKABLE_MAGIC = 0x8F92EAB1
SEEK_TABLE_FRAME = 0x184D2A5E
DOC_IDS_FRAME = 0x184D2A50
HAS_CHECKSUMS = 0x80

LEVEL = 3
MAX_FILE_BYTES = 64 << 20
MOST_FRAMES = 1_000_000
_NO_ID = np.iinfo(np.int64).min


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Any store that Arrow knows, by URI; a plain path is a shared mount."""
    return fs.FileSystem.from_uri(path)


class Writer:
    """Writes under another name and moves the file into place when complete, so a lost task leaves no part file."""

    def __init__(self, folder: str, name: str):
        self._fs, self._folder = file_system(folder)
        self.name = name
        self._partial = f"{self._folder}/_{name}.{uuid.uuid4().hex}"
        self._out = self._fs.open_output_stream(self._partial)
        self._press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
        self._frames: list[tuple[int, int, int]] = []
        self._docs: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self._press.compress(ids)
        self._out.write(frame)
        self.size += len(frame)
        self._frames.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self._docs.append(_NO_ID if doc_id is None else doc_id)

    @property
    def frames(self) -> int:
        return len(self._frames)

    def close(self) -> dict:
        docs = np.array(self._docs, "<i8").tobytes()
        table = np.array(self._frames, "<u4").tobytes()
        foot = struct.pack("<IBI", len(self._frames), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", DOC_IDS_FRAME, len(docs)) + docs)
        self._out.write(struct.pack("<II", SEEK_TABLE_FRAME, len(table) + len(foot)) + table + foot)
        self._out.close()
        final = f"{self._folder}/{self.name}"
        if self._fs.get_file_info(final).type == fs.FileType.File:
            self._fs.delete_file(final)  # of an attempt whose result was lost
        self._fs.move(self._partial, final)
        return {
            "file": self.name,
            "docs": len(self._frames),
            "ids": sum(size for _, size, _ in self._frames) // tokens.ID_BYTES,
        }


class Reader:
    """Ids of single documents of one file; reads its tables first, then only the frames asked for."""

    def __init__(self, path: str):
        store, place = file_system(path)
        self._file = store.open_input_file(place)
        end = self._file.size()
        frames, descriptor, magic = struct.unpack("<IBI", self._read(end - 9, 9))
        if magic != SEEKABLE_MAGIC or descriptor != HAS_CHECKSUMS:
            raise ValueError(f"not a seekable file with checksums: {path}")
        table_at = end - 9 - 12 * frames - 8
        kind, size = struct.unpack("<II", self._read(table_at, 8))
        if kind != SEEK_TABLE_FRAME or size != 12 * frames + 9:
            raise ValueError(f"broken seek table: {path}")
        self.table = np.frombuffer(self._read(table_at + 8, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        docs_at = table_at - 8 * frames - 8
        kind, size = struct.unpack("<II", self._read(docs_at, 8))
        if kind != DOC_IDS_FRAME or size != 8 * frames or docs_at != self.table[:, 0].sum():
            raise ValueError(f"broken document ids: {path}")
        self.docs = [None if one == _NO_ID else one for one in np.frombuffer(self._read(docs_at + 8, 8 * frames), "<i8").tolist()]
        self._starts = np.r_[0, np.cumsum(self.table[:, 0])]
        self._open = zstandard.ZstdDecompressor()

    def _read(self, at: int, size: int) -> bytes:
        self._file.seek(at)
        return self._file.read(size)

    def ids(self, number: int) -> bytes:
        packed, size, checksum = self.table[number].tolist()
        frame = self._read(int(self._starts[number]), packed)
        content = self._open.decompress(frame, max_output_size=size) if size else b""
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} does not match its checksum")
        return content

    def find(self, doc_id: int) -> list[bytes]:
        """The ids of each document with this id."""
        return [self.ids(number) for number, one in enumerate(self.docs) if one == doc_id]

    def close(self) -> None:
        self._file.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, max_file_bytes: int = MAX_FILE_BYTES
) -> DataFrame:
    """Encodes (doc_id, text) whole and writes ids with an end id, in ascending doc_id order over all files.

    Returns the files (file, docs, ids, start), ``start`` counting the ids of all earlier files.  File names sort in
    document order.  Null texts are empty; null doc_ids come first; rows with one id are ordered by
    a hash of their text.  An empty table makes no file.
    """
    small_batches(docs.sparkSession)
    store, place = file_system(folder)
    store.create_dir(place, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = tokens.encoder(tokenizer or tokens.public_tokenizer())
        end = tokens.END.to_bytes(tokens.ID_BYTES, "little")
        part, number, writer, done = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1))):
                if writer is None:
                    writer = Writer(folder, f"part-{part:06d}-{number:04d}.ids.zst")
                    number += 1
                writer.add(doc_id, ids + end)
                if writer.size >= max_file_bytes or writer.frames >= MOST_FRAMES:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema([("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    # The hash spreads rows without an id.
    order = F.xxhash64("text")
    ranged = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id"), order)
    ranged = ranged.sortWithinPartitions("doc_id", order)
    files = staged(ranged.mapInArrow(write, "file string, docs long, ids long"), "token-files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, each frame checked; ids little-endian and with the end id."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
        )
        for batch in batches:
            for one in batch.to_pylist():
                reader, start, rows = Reader(f"{folder}/{one['file']}"), one["start"], []
                for number, doc_id in enumerate(reader.docs):
                    ids = reader.ids(number)
                    rows.append({"doc_id": doc_id, "start": start, "n_tokens": len(ids) // tokens.ID_BYTES, "ids": ids})
                    start += len(ids) // tokens.ID_BYTES
                    if len(rows) >= 1_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                reader.close()
                yield pa.RecordBatch.from_pylist(rows, schema)

    # A task for each file; a given number is not lowered by adaptive execution, for which these rows are tiny.
    each = files.select("file", "start").repartition(max(1, files.count()))
    return each.mapInArrow(frames, "doc_id long, start long, n_tokens long, ids binary")
