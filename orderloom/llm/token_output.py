"""Token ids in seekable Zstandard files: one frame per document, a seek table at the end.

A file is a row of independent frames, one per document with its ids as little-endian unsigned
32-bit integers, then one frame that lists the doc_ids (a line each, empty for null), then a
skippable frame with the seek table: compressed size, size and checksum (low half of xxh64) of
every frame, their number, a flag byte and the format's magic number. A reader takes the table
from the end of the file and decompresses the frames it wants, each checked.

Documents go to files in ascending doc_id order (nulls first, equal ids in the order of their
texts), files in ascending order of their names. Null and empty texts hold the end id alone.
Repeated rows are written as often as they come; extra columns are not read; an empty table gives
no files. Files are closed at about `file_bytes`. A lost task writes its files anew under the
same names. Words are encoded by the library once and remembered: white space parts the library's
own pieces, so no merge crosses it.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from orderloom.llm.common import Remembered, SharedFile, in_ranges, kept, open_shared, pick, shared
from orderloom.llm.pretokens import as_letters

# the seekable format, fixed values
TABLE_MAGIC, FOOTER_MAGIC, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
#: Letters that NFC leaves alone and that have one lower-case letter, with closing marks.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-Þß-öø-ÿ]+)([.,;:!?]*)")


class WordTokens:
    """ids of texts under a tokenizers file that drops white space, as bytes."""

    def __init__(self, path: str, remember: int = 300_000) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.of_word = Remembered(self._word, remember)
        self.of_part = Remembered(self._part, remember)
        self.of_marks = Remembered(self._marks, 10_000)
        self.packed = [_pack([k]) for k in range(max(self.tokenizer.get_vocab().values()) + 1)]

    def _word(self, word: str) -> bytes:
        """A word whose normal form is its lower case, by the library's model alone."""
        letters = word.lower()
        if not word.isascii():
            letters = as_letters(unicodedata.normalize("NFC", word).lower().encode("utf-8"))
        return self._ids(letters)

    def _ids(self, letters: str) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenizer.model.tokenize(letters)])

    def _part(self, part: bytes) -> bytes:
        text = part.decode("utf-8")
        m = _PLAIN.fullmatch(text)
        if m:
            return self.of_word[m[1]] + (self.of_marks[m[2]] if m[2] else b"")
        return _pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _marks(self, marks: str) -> bytes:
        return self._ids(marks)

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.of_part.__getitem__, text.encode("utf-8").split())) if text else b""


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(path: str) -> WordTokens:
    """One encoder per file and worker process."""
    return kept(path, lambda: WordTokens(path))


class SeekableWriter:
    def __init__(self, uri: str) -> None:
        self.out = SharedFile(uri)
        self.compressor = zstandard.ZstdCompressor(level=1)
        self.table: list[bytes] = []
        self.doc_ids: list[str] = []
        self.tokens = 0

    def _frame(self, data: bytes) -> None:
        held = self.compressor.compress(data)
        self.table.append(ENTRY.pack(len(held), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.out.write(held)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._frame(ids)
        self.doc_ids.append("" if doc_id is None else str(doc_id))
        self.tokens += len(ids) // 4

    def close(self) -> None:
        self._frame("\n".join(self.doc_ids).encode())
        body = b"".join(self.table) + FOOTER.pack(len(self.table), CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(body)) + body)
        self.out.close()


class SeekableReader:
    """Random access to the documents of one file."""

    def __init__(self, uri: str) -> None:
        self.file = open_shared(uri)
        size = self.file.size()
        if size < FOOTER.size + 8:
            raise ValueError(f"{uri}: no seek table")
        n, flags, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != FOOTER_MAGIC or not flags & CHECKSUMS:
            raise ValueError(f"{uri}: no seek table with checksums at the end")
        length = n * ENTRY.size + FOOTER.size
        at = size - length - 8
        if at < 0 or struct.unpack("<II", self.file.read_at(8, at)) != (TABLE_MAGIC, length):
            raise ValueError(f"{uri}: seek table does not fit its frame")
        self.entries = list(ENTRY.iter_unpack(self.file.read_at(n * ENTRY.size, at + 8)))
        self.starts = [0]
        for held, _, _ in self.entries:
            self.starts.append(self.starts[-1] + held)
        if not self.entries or self.starts[-1] != at:
            raise ValueError(f"{uri}: frames do not end where the seek table begins")
        self.decompressor = zstandard.ZstdDecompressor()
        lines = self.frame(len(self.entries) - 1).decode().split("\n") if n > 1 else []
        self.doc_ids = [int(x) if x else None for x in lines]
        if len(self.doc_ids) != n - 1:
            raise ValueError(f"{uri}: {n - 1} documents, {len(self.doc_ids)} ids")

    def frame(self, k: int) -> bytes:
        held, size, checksum = self.entries[k]
        data = self.decompressor.decompress(self.file.read_at(held, self.starts[k]), max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} differs from its size or checksum")
        return data

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, ids before it in the file, ids) of all or of the wanted documents; only the
        frames of these are read."""
        start = 0
        for k, doc_id in enumerate(self.doc_ids):
            if wanted is None or doc_id in wanted:
                yield doc_id, start, self.frame(k)
            start += self.entries[k][1] // 4


def write(docs: DataFrame, path: str, end_id: int = 1, file_bytes: int = 256 << 20) -> list[tuple[str, int]]:
    """Encode all texts into files; returns (file, ids before it), in order."""
    spark = docs.sparkSession
    _, folder = shared(spark, "tokens")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        in_ranges(pick(docs, "doc_id", "text"), "doc_id", n)
        .repartitionById(n, "part")
        .sortWithinPartitions("part", "doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).encode, _pack([end_id])
        made: list[tuple[str, int]] = []
        out, number = None, 0
        for batch in batches:
            for doc_id, text, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    uri = f"{folder}/tokens-{part:06d}-{number:06d}.zst"
                    out, number = SeekableWriter(uri), number + 1
                out.add(doc_id, encode(text) + end)
                if out.out.size >= file_bytes:
                    out.close()
                    made.append((uri, out.tokens))
                    out = None
        if out is not None:
            out.close()
            made.append((uri, out.tokens))
        files, tokens = zip(*made, strict=True) if made else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(tokens, pa.int64())], names=["file", "tokens"]
        )

    files, start = [], 0
    for r in sorted(ordered.mapInArrow(run, "file string, tokens long").collect()):
        files.append((r["file"], start))
        start += r["tokens"]
    return files


def read(spark: SparkSession, files: list[tuple[str, int]], wanted: Iterable[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (binary) of all or of the wanted documents."""
    asked = None if wanted is None else set(wanted)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
        arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, size = [], 0
                for doc_id, start, ids in SeekableReader(uri).documents(asked):
                    rows.append((doc_id, before + start, len(ids) // 4, zlib.crc32(ids), ids))
                    size += len(ids)
                    if size >= 8 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    listed = spark.createDataFrame(files, "file string, start long")
    if files:
        listed = listed.repartition(len(files))
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def stored(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write all documents and list what reading the files gives: doc_id, start, n_tokens, ids_crc32."""
    files = write(docs, path, end_id)
    return read(docs.sparkSession, files).drop("ids")
