"""Alignment of two tokenizers' tokens by a merge of their ends, divided along its merge path.

Every text is encoded by both tokenizers, and the byte offsets at which their tokens end
are two rising lists. Offsets in both lists cut the text into groups of tokens that hold
the same bytes. The lists of many texts, one behind the other, are merged as one: binary
searches along the diagonals of the merge path cut it into pieces of equal work, which need
nothing from one another. A piece gives the ends that both lists have inside it; an end
whose two sides fall into neighbouring pieces is found by the boundary test, and groups
that pieces cut are stitched by counting the ends before each token.

The last A and the last B token of a group end together: they are linked. (No token has
no bytes, so an end belongs to one token of each side.) Texts go through the tokenizers
once; their links are stored as compressed ids, in blocks of a bounded number of links.
Each block gives its distinct id pairs with counts, already aggregated, which are all that
the corpus-wide count shuffles. Pair totals and the highest of each B id are joined back to
the blocks' distinct pairs, and a block's documents meet them in one task.

Defined cases: a text that is null, empty, or whose tokens' bytes on either side are not
those of a space and the text (an unknown piece, say) has no tokens: zeros and the text
''; special tokens' strings are plain text; rows that repeat count each; a null id is
kept; an empty table gives no rows; further columns are ignored. A task holds one text and
its tokens, or one block.
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

from .common import mapped, rows_of, slices, stored
from .tokens import default_tokenizer, encoder

#: Steps of the merge in a piece; links in a block; bytes of texts aligned at a time.
PIECE, BLOCK_LINKS, STEP_BYTES = 1 << 14, 1 << 22, 1 << 18

ALIGNED = "block long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
_SCHEMA = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary())])
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
PAIRS = "block long, pair long, n long"


def default_pieces() -> str:
    """The public sentence-piece vocabulary of this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Both:
    """Encodes texts by both tokenizers and knows the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = encoder(a_path, True), SentencePieceProcessor(model_file=b_path)
        b = range(self.b.get_piece_size())
        piece = self.b.id_to_piece
        self.b_bytes = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in b]
        self.a_length = np.array([len(x) for x in self.a.bytes_of], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        #: Decimal ids followed by the separator: within a group, at the end of its A side, of its B side.
        self.a_size = len(self.a.bytes_of)
        numbers = [str(i).encode() for i in range(max(self.a_size, len(self.b_bytes)))]
        self.texts = [n + s for s in (b",", b"|") for n in numbers[: self.a_size]] + [n + s for s in (b",", b";") for n in numbers[: len(self.b_bytes)]]

    def encoded(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None where the text has no tokens."""
        if not text:
            return None
        whole = " " + text
        b = self.b.encode(text, num_threads=1)
        raw = whole.encode()
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a = self.a.ids(whole)
        if b"".join(map(self.a.bytes_of.__getitem__, a.tolist())) != raw:
            return None
        return a.astype(np.int64), np.array(b, np.int64)


@functools.lru_cache(1)
def both(a_path: str, b_path: str) -> Both:
    """One pair of encoders a Python worker."""
    return Both(a_path, b_path)


def cuts(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the diagonals of every ``piece`` steps cross the merge path of two rising lists; of equal values A's comes first."""
    diagonal = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        taken = np.zeros(len(diagonal), bool)
        taken[open_] = a[middle[open_]] <= b[diagonal[open_] - 1 - middle[open_]]
        low, high = np.where(open_ & taken, middle + 1, low), np.where(open_ & ~taken, middle, high)
    return low, diagonal - low


def shared_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in two strictly rising lists of the values that both have, piece by piece."""
    at_a, at_b = cuts(a, b, piece)
    found_a, found_b = [], []
    for k in range(len(at_a) - 1):
        (i, i2), (j, j2) = at_a[k : k + 2], at_b[k : k + 2]
        if k and i and j < len(b) and a[i - 1] == b[j]:  # A's side of this end is the last of the piece before
            found_a.append(np.array([i - 1]))
            found_b.append(np.array([j]))
            j += 1
        own = b[j:j2]
        if i < i2 and len(own):
            place = np.searchsorted(own, a[i:i2])
            hit = np.flatnonzero(own[np.minimum(place, len(own) - 1)] == a[i:i2])
            found_a.append(i + hit)
            found_b.append(j + place[hit])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (none, none)


class Aligned:
    """Groups and links of some texts' tokens, which lie one behind the other."""

    def __init__(self, of: Both, sides: list[tuple[np.ndarray, np.ndarray]], piece: int = PIECE):
        self.of = of
        self.n_a, self.n_b = (np.array([len(s[k]) for s in sides], np.int64) for k in range(2))
        a, b = (np.concatenate([s[k] for s in sides]) for k in range(2))
        end_a, end_b = np.cumsum(of.a_length[a]), np.cumsum(of.b_length[b])
        at_a, at_b = shared_ends(end_a, end_b, piece)
        self.link_a, self.link_b = a[at_a], b[at_b]
        #: Links up to the end of each text, and bytes of the text form of its groups.
        self.until = np.searchsorted(at_a, np.cumsum(self.n_a))
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[at_a], last_b[at_b] = True, True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        order = np.zeros(len(a) + len(b), np.int64)
        # Before a token of A stand the B tokens of earlier groups; before one of B the A tokens up to its own.
        before_b, before_a = np.concatenate([[0], at_b + 1]), at_a + 1
        order[np.arange(len(a)) + before_b[group_a]] = a + np.where(last_a, of.a_size, 0)
        order[np.arange(len(b)) + before_a[group_b]] = 2 * of.a_size + b + np.where(last_b, len(of.b_bytes), 0)
        self.order = order

    def rows(self) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """Per text: tokens of A and of B, groups, their SHA-256, and links as rows (A ids, B ids)."""
        low = at = 0
        for n_a, n_b, high in zip(self.n_a.tolist(), self.n_b.tolist(), self.until.tolist()):
            text = b"".join(map(self.of.texts.__getitem__, self.order[at : at + n_a + n_b].tolist()))[:-1]
            yield n_a, n_b, high - low, hashlib.sha256(text).hexdigest(), np.stack([self.link_a[low:high], self.link_b[low:high]])
            low, at = high, at + n_a + n_b


def _squeezed(links: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(1).compress(links.astype("<u4" if links.size and links.max() >= 1 << 16 else "<u2").tobytes())


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    """Keys of a document's links: A id and B id in one number."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(packed)
    a, b = np.frombuffer(raw, "<u2" if len(raw) == 4 * n else "<u4").reshape(2, n).astype(np.int64)
    return a << 32 | b


def _align(a_path: str, b_path: str, block_links: int):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, block, size = both(a_path, b_path), TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in slices(batch, 1, STEP_BYTES):
                sides = [of.encoded(t) for t in part.column(1).to_pylist()]
                kept = [s for s in sides if s]
                made = Aligned(of, kept).rows() if kept else iter(())
                rows = []
                for doc_id, side in zip(part.column(0).to_pylist(), sides):
                    n_a, n_b, n, digest, links = next(made) if side else (0, 0, 0, "", None)
                    if size and size + n > block_links:
                        block, size = block + 1, 0
                    size += n
                    rows.append((block, doc_id, n_a, n_b, n, digest, _squeezed(links) if n else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    return align


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of each block with their counts; a block that tasks share comes in parts."""
    held: list[np.ndarray] = []
    current = None

    def out() -> pa.RecordBatch:
        pair, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), current if current is not None else 0)), pa.array(pair), pa.array(n)], ["block", "pair", "n"])

    for block, n, links in rows_of(batches):
        if block != current:
            yield out()
            held, current = [], block
        if n:
            held.append(_unpacked(links, n))
    yield out()


def _summed(key, docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Links that are their B id's best, and counts of links, for the documents of a block."""
    order = np.argsort(pairs["pair"].to_numpy(), kind="stable")
    pair, count, best = (pairs[c].to_numpy()[order] for c in ("pair", "count", "best"))
    n_best, total = np.zeros((2, docs.num_rows), np.int64)
    for i, (n, links) in enumerate(zip(docs["n_groups"].to_pylist(), docs["links"].to_pylist())):
        if n:
            at = np.searchsorted(pair, _unpacked(links, n))
            n_best[i], total[i] = best[at].sum(), count[at].sum()
    columns = {c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups")}
    return pa.table(columns | {"n_links": docs["n_groups"], "n_best": pa.array(n_best), "count_sum": pa.array(total), "groups_sha256": docs["groups_sha256"]})


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """Stored rows (block, doc_id, n_a, n_b, n_groups, groups_sha256, links): links are zstd-compressed A ids, then B ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(mapped(rows, _align(a_path or default_tokenizer(), b_path or default_pieces(), block_links), ALIGNED), "aligned")


def pair_counts(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows of ``aligned``: distinct pairs of each block, and (pair, a_id, b_id, count, best) corpus-wide."""
    pairs = stored(mapped(found.where("n_groups > 0").select("block", "n_groups", "links"), _paired, PAIRS), "aligned-pairs")
    counts = stored(pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b_id", F.col("pair").bitwiseAND(0xFFFFFFFF)), "aligned-counts")
    most = counts.groupBy(F.col("b_id").alias("of_b")).agg(F.max("count").alias("most"))
    marked = counts.join(most, F.col("b_id") == F.col("of_b")).select("pair", F.shiftright("pair", 32).alias("a_id"), "b_id", "count", (F.col("count") == F.col("most")).alias("best"))
    return pairs.select("block", "pair").distinct(), marked


def judged(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = aligned(docs, a_path, b_path, id_col, text_col, block_links)
    pairs, marked = pair_counts(found)
    known = pairs.join(marked, "pair").select("block", "pair", "count", F.col("best").cast("long").alias("best"))
    linked = found.where("n_groups > 0")
    sums = linked.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_summed, RESULT)
    zero = [F.lit(0).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    return sums.unionByName(found.where("n_groups = 0").select("doc_id", "n_a", "n_b", "n_groups", *zero, "groups_sha256"))
