"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last 32 bytes cuts every text into chunks of some hundred bytes at
places that depend on the bytes around them only, so a passage that documents share yields
the same chunks in each of them.

Pass one counts chunk keys, eight bytes each and added up in the tasks first; those that
came twice make a filter, so its size follows the shared chunks and not all of them. In pass
two, texts without a possibly shared chunk are finished where they stand. From the others,
each possibly shared chunk goes out once a task as (key, bytes), is reduced to one row a
key, encoded once, and joined back to all places that named it. A document's pieces, ids of
shared chunks and its own runs of text between them, are then brought together in order,
the runs encoded and the joins repaired: tokens around a join are decoded and encoded anew
in a window that widens until the outermost tokens on both sides agree with those that were
there, or until the text's ends.

Defined cases: a null text is empty and has no tokens; a null id is kept; repeated rows are
encoded row by row; an empty table gives no rows; further columns are ignored. A task
holds one text and its ids, never a group of documents.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import mapped, rows_of, stored
from .tokens import Encoder, default_tokenizer, encoder

#: Least and most bytes of a chunk; a cut falls on one byte in 256 beyond the least.
LEAST, MOST = 64, 4096
#: Most slots of the filter over shared chunks (8 MiB when sent); beyond a million of them it lets more chunks through to the shuffle, a tenth at some fourteen million.
CHUNK_SLOTS = 1 << 26
#: Chunks a task remembers to have sent out already.
REMEMBERED = 100_000

PLACES = "row long, doc_id long, place int, key binary, run binary, chunk binary, n_tokens long, ids_sha256 string, decoded_sha256 string"
_SCHEMA = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int32()), ("key", pa.binary()), ("run", pa.binary()), ("chunk", pa.binary()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@functools.lru_cache(1)
def _gear() -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunks(data: bytes) -> list[bytes]:
    """Content-defined chunks of UTF-8; no cut falls inside a character."""
    if len(data) <= LEAST:
        return [data] if data else []
    b = np.frombuffer(data, np.uint8)
    h = _gear()[b]
    for step in (1, 2, 4, 8, 16):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    starts = (b & 0xC0) != 0x80
    marks = np.flatnonzero(((h[:-1] >> np.uint32(24)) == 0) & starts[1:]) + 1
    out, at, i = [], 0, 0
    while len(data) - at > LEAST:
        i = int(np.searchsorted(marks, at + LEAST))
        cut = int(marks[i]) if i < len(marks) else len(data)
        if cut - at > MOST:
            cut = at + MOST
            while not starts[cut]:
                cut -= 1
        out.append(data[at:cut])
        at = cut
    if at < len(data):
        out.append(data[at:])
    return out


def _key(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            keys = [_key(c)[:8] for t in batch.column(0).slice(at, 256).to_pylist() if t for c in chunks(t.encode())]
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(keys), np.int64))], ["k"])


def _digests(enc: Encoder, ids: np.ndarray) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(enc.decimals(ids)).hexdigest(), hashlib.sha256(enc.text_bytes(ids)).hexdigest()


def _places(path: str, sent):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, bits, squeeze = encoder(path), np.frombuffer(sent.value, np.uint8), zstandard.ZstdCompressor(3).compress
        row, told, out = TaskContext.get().partitionId() << 40, set(), []
        size = 0

        def local(doc_id, n: int, run: list[bytes]) -> int:
            if run:
                out.append((row, doc_id, n, None, squeeze(b"".join(run)), None, None, None, None))
            return n + bool(run)

        for doc_id, text in rows_of(batches):
            row += 1
            parts = chunks((text or "").encode())
            keys = [_key(c) for c in parts]
            shared = bloom.lookup(bits, np.frombuffer(b"".join(k[:8] for k in keys), np.int64)) if keys else np.zeros(0, bool)
            if not shared.any():
                out.append((row, doc_id, None, None, None, None, *_digests(enc, enc.ids(text))))
            else:
                n, run = 0, []
                for chunk, key, many in zip(parts, keys, shared.tolist()):
                    if not many:
                        run.append(chunk)
                        continue
                    n, run = local(doc_id, n, run), []
                    out.append((row, doc_id, n, key, None, None, None, None, None))
                    n += 1
                    if key not in told:
                        if len(told) >= REMEMBERED:
                            told.clear()
                        told.add(key)
                        out.append((None, None, None, key, None, chunk, None, None, None))
                local(doc_id, n, run)
            size += len(text or "")
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)

    return place


def _encoded(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, squeeze = encoder(path), zstandard.ZstdCompressor(1).compress
        for batch in batches:
            ids = [squeeze(enc.encoded(c.decode())) for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["shared", "shared_ids"])

    return encode


class Joiner:
    """Joins pieces' ids in a buffer that grows at its end."""

    def __init__(self, enc: Encoder):
        self.enc = enc
        self.sure = np.array([len(b) > 1 and b[0] == 32 and 33 <= b[1] <= 126 for b in enc.bytes_of])
        self.ids, self.n = np.zeros(1024, enc.dtype), 0

    def clear(self) -> None:
        self.n = 0

    def _put(self, at: int, *parts: np.ndarray) -> None:
        self.n = at
        for p in parts:
            if self.n + len(p) > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.n], np.zeros(self.n + 2 * len(p), self.ids.dtype)])
            self.ids[self.n : self.n + len(p)] = p
            self.n += len(p)

    def add(self, right: np.ndarray) -> None:
        """Appends ``right``; repairs the join unless the tokenizer must cut there anyway."""
        if not self.n or not len(right) or self.sure[right[0]]:
            self._put(self.n, right)
            return
        after, reach = np.flatnonzero(self.sure[right]), 1
        while True:
            low = max(0, self.n - 128 * reach)
            before = low + np.flatnonzero(self.sure[self.ids[low : self.n]])
            if low and len(before) <= reach:
                reach *= 2
                continue
            i, i2 = (int(before[-reach - 1]), int(before[-reach])) if len(before) > reach else (0, 0)
            j, j2 = (int(after[reach - 1]), int(after[reach])) if len(after) > reach else (len(right), len(right))
            window = np.concatenate([self.ids[i : self.n], right[:j2]])
            new = self.enc.ids(b"".join(map(self.enc.bytes_of.__getitem__, window.tolist())).decode())
            agree = np.array_equal(new[: i2 - i], self.ids[i:i2]) and np.array_equal(new[len(new) - (j2 - j) :], right[j:j2])
            if agree or (i == 0 and j2 == len(right)):
                self._put(i, new, right[j2:])
                return
            reach *= 2


def _assembled(path: str):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, unpack = encoder(path), zstandard.ZstdDecompressor().decompress
        joiner, current, out = Joiner(enc), None, []
        table = lambda: pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*out))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        for row, doc_id, own, data in rows_of(batches):
            if current is None or row != current[0]:
                if current:
                    out.append((current[1], *_digests(enc, joiner.ids[: joiner.n])))
                if len(out) >= 1000:
                    yield table()
                    out = []
                joiner.clear()
                current = row, doc_id
            joiner.add(enc.ids(unpack(data).decode()) if own else np.frombuffer(unpack(data), enc.dtype))
        if current:
            out.append((current[1], *_digests(enc, joiner.ids[: joiner.n])))
        if out:
            yield table()

    return assemble


def round_trip(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (decoded text in UTF-8)."""
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = mapped(rows.select("text"), _keys, "k long").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    shared = stored(counts.where("n > 1").select("k"), "bpe-shared")
    # 64 slots a key: one chunk in a thousand that is not shared is let through.
    sent = bloom.build(shared, bloom.slots_for(8 * shared.count(), CHUNK_SLOTS), repeats=False)
    placed = stored(mapped(rows, _places(path, sent), PLACES), "bpe-places")
    chunk = placed.where("chunk is not null").groupBy("key").agg(F.min("chunk").alias("chunk"))
    known = stored(mapped(chunk, _encoded(path), "shared binary, shared_ids binary"), "bpe-chunks")
    pieces = placed.where("place is not null").select("row", "doc_id", "place", "key", "run")
    fetched = pieces.where("key is not null").join(known, F.col("key") == F.col("shared")).select("row", "doc_id", "place", F.lit(False).alias("own"), F.col("shared_ids").alias("data"))
    whole = pieces.where("key is null").select("row", "doc_id", "place", F.lit(True).alias("own"), F.col("run").alias("data")).unionByName(fetched)
    ordered = whole.repartition("row").sortWithinPartitions("row", "place").select("row", "doc_id", "own", "data")
    finished = placed.where("n_tokens is not null").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    return finished.unionByName(mapped(ordered, _assembled(path), RESULT))
