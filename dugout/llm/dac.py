"""Token ids in files of directly addressable codes.

An id is split into chunks of eight bits. Level one holds the lowest chunk of every id and
a bitmap that tells which ids continue; level two holds the next chunk of those only, and
so on. A directory holds the number of set bits before every 512th one, so the place of an
id's next chunk is one directory entry and at most 64 bytes of bitmap away: any token is
read with a few small reads, and nothing around it is decoded.

A file is a row of segments of at most 2^20 tokens and of blocks of at most 2^14 documents,
a footer of their places, and a trailer. A document block holds the place of its first
token in the file, the documents' ids, which of them are null, and their lengths, coded
like the tokens. Documents are dealt to tasks by ranges of their ids and written in
ascending order; each closes with an end id. So the files alone tell every document: its
start over all files is the number of tokens that the trailers of earlier files state, and
the lengths before it in its own. The driver knows a row a file.

Defined cases: a null text is empty and has only the end id; rows with a null id come
first; rows that repeat an id follow each other in any order, over several files if they are
many; an empty table makes no files; further columns are ignored. A task holds one segment,
one document and one document block.
"""

from __future__ import annotations

import struct
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, rows_of, stored, work_path
from .files import attempt_name, opened
from .tokens import default_tokenizer, encoder

END_ID = 0
SEGMENT, BLOCK = 1 << 20, 1 << 14
STEP = 512
MAGIC = b"DACTOK02"
#: Tokens, place of the footer, number of segments, number of document blocks.
TRAILER = "<2Q2I"


def packed(ids: np.ndarray) -> bytes:
    """One segment: number of levels, the levels' places, then per level chunks, bitmap and directory."""
    parts, places, rest, at = [], [], ids.astype(np.uint64), 0
    while True:
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        before = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), STEP)) if len(more) else [])])[:-1].astype("<u4")
        places.append((len(rest), at, at + len(rest), at + len(rest) + len(bitmap)))
        for p in ((rest & np.uint64(255)).astype(np.uint8).tobytes(), bitmap.tobytes(), before.tobytes()):
            parts.append(p)
            at += len(p)
        rest = rest[more] >> np.uint64(8)
        if not len(rest):
            break
    return struct.pack("<I", len(places)) + b"".join(struct.pack("<4Q", *p) for p in places) + b"".join(parts)


class Segment:
    """Reads one segment through ``read(offset, size)``; holds only its levels' places."""

    def __init__(self, read):
        (levels,) = struct.unpack("<I", read(0, 4))
        places = read(4, 32 * levels)
        self.places = [struct.unpack_from("<4Q", places, 32 * i) for i in range(levels)]
        base = 4 + 32 * levels
        self.read = lambda at, n: read(base + at, n)

    def _rank(self, level: int, i: int) -> int:
        """Set bits of the level's bitmap before place i."""
        n, _, bitmap, directory = self.places[level]
        block = min(i, n - 1) // STEP
        (before,) = struct.unpack("<I", self.read(directory + 4 * block, 4))
        bits = np.unpackbits(np.frombuffer(self.read(bitmap + block * STEP // 8, (i - block * STEP + 7) // 8), np.uint8), bitorder="little")
        return before + int(bits[: i - block * STEP].sum())

    def token(self, i: int) -> int:
        """One id, from a few bytes of each of its levels."""
        value = 0
        for level, (_, chunks, bitmap, _) in enumerate(self.places):
            value |= self.read(chunks + i, 1)[0] << (8 * level)
            if not self.read(bitmap + i // 8, 1)[0] >> (i % 8) & 1:
                return value
            i = self._rank(level, i)
        raise ValueError("a chunk continues beyond the last level")

    def tokens(self, low: int, high: int) -> np.ndarray:
        """The ids of places low to high."""
        out, at = np.zeros(high - low, np.uint64), np.arange(high - low)
        for level, (_, chunks, bitmap, _) in enumerate(self.places):
            out[at] |= np.frombuffer(self.read(chunks + low, high - low), np.uint8).astype(np.uint64) << np.uint64(8 * level)
            byte = low // 8
            bits = np.unpackbits(np.frombuffer(self.read(bitmap + byte, (high + 7) // 8 - byte), np.uint8), bitorder="little")
            more = bits[low - 8 * byte : high - 8 * byte].astype(bool)
            at = at[more]
            if not len(at):
                return out.astype("<u4")
            low = self._rank(level, low)
            high = low + len(at)
        raise ValueError("a chunk continues beyond the last level")


class Writer:
    """Appends documents to one file, a segment and a document block at a time."""

    def __init__(self, sink):
        self.sink, self.at, self.total, self.places, self.held, self.size = sink, 0, 0, [], [], 0
        self.blocks, self.docs, self.first = [], [], 0
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        if len(self.docs) == BLOCK:
            self._close_block()
        while len(ids):
            part, ids = ids[: SEGMENT - self.size], ids[SEGMENT - self.size :]
            self.held.append(part)
            self.size += len(part)
            if self.size == SEGMENT:
                self._flush()

    def _flush(self) -> None:
        if self.size:
            data = packed(np.concatenate(self.held))
            self.places.append((self.at, len(data)))
            self._write(data)
            self.total += self.size
            self.held, self.size = [], 0

    def _close_block(self) -> None:
        if self.docs:
            ids, lengths = zip(*self.docs)
            known = np.packbits(np.array([i is not None for i in ids]), bitorder="little").tobytes()
            data = struct.pack("<QI", self.first, len(ids)) + np.array([i or 0 for i in ids], "<i8").tobytes() + known + packed(np.array(lengths, np.uint64))
            self.blocks.append((self.at, len(data)))
            self._write(data)
            self.first += sum(lengths)
            self.docs = []

    def close(self) -> None:
        self._flush()
        self._close_block()
        footer = self.at
        self._write(b"".join(struct.pack("<2Q", *p) for p in [*self.places, *self.blocks]))
        self._write(struct.pack(TRAILER, self.total, footer, len(self.places), len(self.blocks)) + MAGIC)
        self.sink.close()


class Reader:
    """Random access to one file."""

    def __init__(self, source, whole_segments: bool = False):
        self.source, self.whole = source, whole_segments
        tail = struct.calcsize(TRAILER) + len(MAGIC)
        end = self._read(source.size() - tail, tail)
        if end[-len(MAGIC) :] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.total, footer, n, m = struct.unpack(TRAILER, end[: -len(MAGIC)])
        places = [struct.unpack_from("<2Q", self._read(footer, 16 * (n + m)), 16 * i) for i in range(n + m)]
        self.places, self.blocks = places[:n], places[n:]
        self.recent: OrderedDict[int, Segment] = OrderedDict()

    def _read(self, at: int, n: int) -> bytes:
        return self.source.read_at(n, at)

    def segment(self, i: int) -> Segment:
        if i not in self.recent:
            at, size = self.places[i]
            if self.whole:
                data = memoryview(self._read(at, size))
                self.recent[i] = Segment(lambda o, n: data[o : o + n])
            else:
                self.recent[i] = Segment(lambda o, n: self._read(at + o, n))
            if len(self.recent) > 2:
                self.recent.popitem(last=False)
        return self.recent[i]

    def token(self, i: int) -> int:
        return self.segment(i // SEGMENT).token(i % SEGMENT)

    def tokens(self, low: int, n: int) -> np.ndarray:
        out = []
        while n:
            take = min(n, SEGMENT - low % SEGMENT)
            out.append(self.segment(low // SEGMENT).tokens(low % SEGMENT, low % SEGMENT + take))
            low, n = low + take, n - take
        return np.concatenate(out) if out else np.zeros(0, "<u4")

    def documents(self, block: int) -> Iterator[tuple[int | None, int, int]]:
        """(id, first token in the file, tokens) of the documents of a block, in order."""
        at, size = self.blocks[block]
        data = self._read(at, size)
        first, n = struct.unpack_from("<QI", data)
        ids, at = np.frombuffer(data, "<i8", n, 12), 12 + 8 * n
        known = np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, at), bitorder="little")[:n]
        at += (n + 7) // 8
        lengths = Segment(lambda o, k: data[at + o : at + o + k]).tokens(0, n)
        for i, some, length in zip(ids.tolist(), known.tolist(), lengths.tolist()):
            yield i if some else None, first, length
            first += length


def _written(root: str, path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, writer = encoder(path), None
        for doc_id, text in rows_of(batches):
            if writer is None:
                files, folder = opened(root)
                files.create_dir(folder)
                name = attempt_name("dac")
                writer = Writer(files.open_output_stream(f"{folder}/{name}"))
            writer.add(doc_id, np.append(enc.ids(text), enc.dtype.type(END_ID)))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name])], ["file_no", "file"])

    return write


def write(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> tuple[str, DataFrame]:
    """Writes the files; gives their folder and the files in order: file_no, file."""
    spark = docs.sparkSession
    root = folder or work_path(spark, "token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Rows of one id, or without one, may be many: they are dealt by what tells them apart.
    told = rows.withColumns({"hash": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["doc_id", "hash", "nth"]
    ordered = told.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return root, stored(mapped(ordered, _written(root, tokenizer or default_tokenizer()), "file_no int, file string"), "token-files-index")


def _trailers(root: str):
    def trailers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = opened(root)
        for batch in batches:
            total, blocks = [], []
            for name in batch.column(1).to_pylist():
                with files.open_input_file(f"{folder}/{name}") as source:
                    reader = Reader(source)
                    total.append(reader.total)
                    blocks.append(len(reader.blocks))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(total, pa.int64()), pa.array(blocks, pa.int32())], ["file_no", "file", "total", "blocks"])

    return trailers


def layout(root: str, files: DataFrame) -> list[tuple[str, int, int]]:
    """(file, tokens of all files before, document blocks) in order, from the files' trailers: a row a file."""
    found = mapped(files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))), _trailers(root), "file_no int, file string, total long, blocks int")
    out, at = [], 0
    for _, name, total, blocks in sorted(tuple(r) for r in found.collect()):
        out.append((name, at, blocks))
        at += total
    return out


def _read(root: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = opened(root)
        for name, begins, block in rows_of(batches):
            out = []
            with files.open_input_file(f"{folder}/{name}") as source:
                reader = Reader(source, whole_segments=True)
                for doc_id, first, n in reader.documents(block):
                    out.append((doc_id, begins + first, n, zlib.crc32(reader.tokens(first, n).tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read


def read(root: str, files: DataFrame) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    spark = files.sparkSession
    places = spark.createDataFrame(layout(root, files), "file string, begins long, blocks int")
    blocks = places.select("file", "begins", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    dealt = blocks.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
    return mapped(dealt, _read(root), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_at(root: str, files: DataFrame, position: int) -> int:
    """The id at one place of the whole sequence, read from its file alone."""
    at = [(name, begins) for name, begins, _ in layout(root, files) if begins <= position]
    folder, (name, begins) = opened(root), at[-1] if at else (None, 0)
    if name is None or position < 0:
        raise IndexError(position)
    with folder[0].open_input_file(f"{folder[1]}/{name}") as source:
        reader = Reader(source)
        if position - begins >= reader.total:
            raise IndexError(position)
        return reader.token(position - begins)


def round_trip(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files and reads them back: doc_id, start, n_tokens, ids_crc32."""
    return read(*write(docs, tokenizer, id_col, text_col))
