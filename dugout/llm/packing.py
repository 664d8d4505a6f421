"""Hierarchical packing of documents into sequences of several lengths.

Each task packs its own documents, so nothing is shuffled and a hot source does not
matter. Documents are encoded and closed with an end id. A document longer than the
longest window fills whole windows; what remains of it is routed to the smallest tier that
holds it. Each tier is packed from its longest member on: a window opens with one member,
its gap is filled with the longest members of shorter tiers that fit, and what is left of
the gap takes a cut of the next longer one. So every window of every tier is full. What
remains at the end of a task is laid out in sequences whose lengths are powers of two,
which need no padding either.

Step groups: the sequences of a block are dealt to groups of about ``step_tokens`` tokens,
dearest first, each to the group with the least cost so far that still has room; cost is
the sum of squared piece lengths, as attention within pieces has.

Defined cases: a null text is empty and has only the end id; a null id is kept; repeated
rows are documents of their own; an empty table gives no pieces; further columns are
ignored. A task holds one block of documents (``block_tokens``) and the longest document.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, rows_of
from .tokens import default_tokenizer, encoder

TIERS = (128, 256, 512, 1024)
END_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"

#: (length, serial number, document's place, start in the document): the serial number makes ties definite.
Item = tuple[int, int, int, int]


class Pool:
    """Members of the tiers that wait, by length."""

    def __init__(self) -> None:
        self.items: list[Item] = []
        self.serial = 0

    def add(self, length: int, doc: int, start: int) -> None:
        insort(self.items, (length, self.serial, doc, start))
        self.serial += 1

    def longest(self, most: int) -> Item | None:
        """The longest member of at most ``most`` tokens."""
        at = bisect_right(self.items, (most + 1, -1))
        return self.items.pop(at - 1) if at else None

    def cut(self, gap: int) -> Item | None:
        """``gap`` tokens of the shortest member that is longer; the rest goes back to its tier."""
        at = bisect_right(self.items, (gap + 1, -1))
        if at == len(self.items):
            return None
        length, serial, doc, start = self.items.pop(at)
        self.add(length - gap, doc, start + gap)
        return gap, serial, doc, start


def tier_of(length: int, tiers: tuple[int, ...] = TIERS) -> int:
    return next(t for t in tiers if length <= t)


def windows(pool: Pool, last: bool, tiers: tuple[int, ...] = TIERS) -> Iterator[tuple[int, list[Item]]]:
    """Full windows (tier, members) of the pool; the rest stays there, unless ``last``."""
    while pool.items:
        first = pool.items.pop()
        window = tier_of(first[0], tiers)
        held, gap = [first], window - first[0]
        while gap:
            found = pool.longest(gap) or pool.cut(gap)
            if not found:
                break
            held.append(found)
            gap -= found[0]
        if not gap:
            yield window, held
        elif last:
            yield from powers_of_two(held)
        else:
            for length, _, doc, start in held:
                pool.add(length, doc, start)
            return


def powers_of_two(held: list[Item]) -> Iterator[tuple[int, list[Item]]]:
    """The members one after another, cut into sequences whose lengths are the powers of two of the sum."""
    rest, total = held[::-1], sum(x[0] for x in held)
    while total:
        size = gap = 1 << (total.bit_length() - 1)
        out = []
        while gap:
            length, serial, doc, start = rest.pop()
            take = min(gap, length)
            out.append((take, serial, doc, start))
            if take < length:
                rest.append((length - take, serial, doc, start + take))
            gap -= take
        yield size, out
        total -= size


def step_groups(costs: list[tuple[int, int]], step_tokens: int) -> list[int]:
    """Group of each sequence given as (tokens, cost)."""
    n = max(1, -(-sum(t for t, _ in costs) // step_tokens))
    open_groups = [(0, g, 0) for g in range(n)]  # cost, group, tokens
    heapq.heapify(open_groups)
    out = [0] * len(costs)
    for i in sorted(range(len(costs)), key=lambda i: (-costs[i][1], i)):
        passed = []
        cost, g, tokens = heapq.heappop(open_groups)
        while tokens + costs[i][0] > step_tokens and open_groups:
            passed.append((cost, g, tokens))
            cost, g, tokens = heapq.heappop(open_groups)
        if tokens and tokens + costs[i][0] > step_tokens:  # none has room: a new group
            passed.append((cost, g, tokens))
            cost, g, tokens, n = 0, n, 0, n + 1
        out[i] = g
        if tokens + costs[i][0] < step_tokens:
            passed.append((cost + costs[i][1], g, tokens + costs[i][0]))
        for x in passed:
            heapq.heappush(open_groups, x)
        if not open_groups:
            open_groups, n = [(0, n, 0)], n + 1
    return out


def _packer(path: str, tiers: tuple[int, ...], block_tokens: int, step_tokens: int):
    schema = pa.schema([(n, pa.int32() if n == "tier" else pa.int64()) for n in (c.split()[0] for c in PIECES.split(", "))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoder(path), TaskContext.get().partitionId() << 40
        pool, docs, held = Pool(), [], 0
        next_sequence = next_group = base

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal docs, held, next_sequence, next_group, pool
            made = list(windows(pool, last, tiers))
            groups = step_groups([(size, sum(x[0] ** 2 for x in members)) for size, members in made], step_tokens)
            out = []
            for (size, members), group in zip(made, groups):
                offset = 0
                for length, _, doc, start in members:
                    doc_id, ids = docs[doc]
                    crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
                    out.append((doc_id, start, length, crc, len(ids), next_sequence, offset, size, next_group + group))
                    offset += length
                next_sequence += 1
            next_group += max(groups, default=-1) + 1
            waiting, kept = Pool(), {}
            for length, _, doc, start in pool.items:
                waiting.add(length, kept.setdefault(doc, len(kept)), start)
            docs, pool, held = [docs[d] for d in kept], waiting, 0
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema) if out else None

        for doc_id, text in rows_of(batches):
            ids = np.append(enc.ids(text), enc.dtype.type(END_ID))
            docs.append((doc_id, ids))
            whole = len(ids) // tiers[-1] * tiers[-1]
            for start in range(0, whole, tiers[-1]):
                pool.add(tiers[-1], len(docs) - 1, start)
            if whole < len(ids):
                pool.add(len(ids) - whole, len(docs) - 1, whole)
            held += len(ids)
            if held >= block_tokens and (out := flush(False)):
                yield out
        if out := flush(True):
            yield out

    return pack


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    block_tokens: int = 1 << 20,
    step_tokens: int = 1 << 15,
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier (the sequence's length), step_group.

    ``tiers`` are rising powers of two. Sequence ids are unique over the table; they follow
    the input's partitions.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers must be rising powers of two")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(rows, _packer(tokenizer or default_tokenizer(), tiers, block_tokens, step_tokens), PIECES)
