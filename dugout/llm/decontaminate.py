"""Benchmark decontamination by generalised suffix automata of the test items.

Items are cut into words. Each item has a window length: ``window`` words, or for shorter
items the share ``coverage`` of their words, at least one. Runs of that many of its words
are its windows; a document word inside any occurrence of a window is hit.

Items are dealt over automata of a bounded number of words (long items in segments that
overlap by a window less one, so no window is cut), each built by a task and written to
the shared work folder. A document's words stream through every automaton, which keeps the
longest suffix of what was read that stands in some item: where it reaches the window
length the last ``window`` words are hit, and the state at that depth names the items. Of
shorter items, states know the windows that end in them. A filter of word pairs finds the
runs that can hold a window at all; elsewhere the longest match has one word and the
automaton is not entered. Documents are read once and never shuffled; a task holds some
documents and one automaton, whatever the number of items.

Defined cases: a null or empty text has no words and no hits; an item without words has no
window; a null item id marks words but names no item; items and documents that repeat are
judged row by row, an item id is listed once a document; empty tables give no rows or no
hits; a null document id is kept; further columns are ignored by ``matches`` and kept by ``cleaned``.
"""

from __future__ import annotations

import functools
import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, rows_of, slices, stored, work_path
from .files import attempt_name, opened
from .words import joined, places

#: Words of one automaton, and of a segment of an item.
AUTOMATON_WORDS, SEGMENT_WORDS = 1 << 17, 1 << 15
#: Document words looked up at a time, and bytes of texts that meet all automata in turn.
STEP_WORDS, STEP_BYTES = 1 << 16, 1 << 24

SEGMENTS = "item string, least int, words binary, n long"
FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<first:long,end:long>>"
_SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64())])


class Automaton:
    """Generalised suffix automaton over word numbers, with the windows of its items."""

    def __init__(self, window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[str | None] = []
        self.own: list[tuple[np.ndarray, int]] = []

    def add(self, item: str | None, words: list[bytes], least: int) -> None:
        """One item, or a segment of one, whose windows have ``least`` words."""
        ids = [self.number.setdefault(w, len(self.number)) for w in words]
        last = 0
        for c in ids:
            last = self._extended(last, c)
        self.items.append(item)
        self.own.append((np.array(ids), least))

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int) -> int:
        """The state of the longest string of ``p`` followed by ``c``, parted from longer ones."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        part = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = part
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = part
            p = self.link[p]
        return part

    def _extended(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c)
        return new

    def finish(self) -> Automaton:
        """Windows at their states, and the filter of word pairs."""
        n = len(self.next)
        #: State of the last ``window`` words; nearest state up the links in which a shorter window ends.
        self.deep, self.near = [-1] * n, [-1] * n
        self.at: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        order = sorted(range(1, n), key=self.length.__getitem__)
        for v in order:
            if self.length[v] >= self.window:
                up = self.link[v]
                self.deep[v] = v if self.length[up] < self.window else self.deep[up]
        for i, (ids, least) in enumerate(self.own):
            v = 0
            for k, c in enumerate(ids.tolist(), 1):
                v = self.next[v][c]
                if k < least:
                    continue
                if least == self.window:
                    self.at.setdefault(self.deep[v], set()).add(i)
                else:
                    u = v
                    while self.length[self.link[u]] >= least:
                        u = self.link[u]
                    if (least, i) not in (ends := self.short.setdefault(u, [])):
                        ends.append((least, i))
        for v in order:
            self.near[v] = v if v in self.short else self.near[self.link[v]]
        self.shortest = min((least for _, least in self.own), default=self.window)
        pairs = [np.unique(ids[:-1] * len(self.number) + ids[1:]) for ids, _ in self.own if len(ids) > 1]
        self.pairs = np.zeros(1 << max(10, (16 * sum(map(len, pairs))).bit_length()), bool)
        for p in pairs:
            self.pairs[self._slot(p)] = True
        del self.own
        return self

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        mixed = pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - len(self.pairs).bit_length())).astype(np.int64)

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Runs (first, end) of word numbers that may hold a window; -1 is a word of no item."""
        known = ids >= 0
        if self.shortest > 1:
            flags = known[:-1] & known[1:]
            at = np.flatnonzero(flags)
            flags[at] = self.pairs[self._slot(ids[at] * len(self.number) + ids[at + 1])]
        else:
            flags = known
        edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
        first, end = edges[::2], edges[1::2] + (self.shortest > 1)
        long = end - first >= self.shortest
        return list(zip(first[long].tolist(), end[long].tolist()))

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(first, end, state, words) of each place where a window ends; words is 0 for a full window."""
        moves, link, length, deep, near, window = self.next, self.link, self.length, self.deep, self.near, self.window
        for first, end in self.runs(ids):
            v = matched = 0
            for i, c in enumerate(ids[first:end].tolist(), first + 1):
                while c not in moves[v] and v:
                    v = link[v]
                    matched = length[v]
                if c in moves[v]:
                    v = moves[v][c]
                    matched += 1
                    if matched >= window and deep[v] in self.at:
                        yield i - window, i, deep[v], 0
                    u = near[v]
                    while u > 0:
                        for words in {k for k, _ in self.short[u] if k <= matched}:
                            yield i - words, i, u, words
                        u = near[link[u]]

    def named(self, state: int, words: int) -> list[int]:
        """Items whose window ends in a state."""
        return [i for k, i in self.short[state] if k == words] if words else list(self.at[state])


def _segments(window: int, coverage: float):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for item, text in rows_of(batches, 64):
            words = joined(text).split()
            least = min(window, max(1, int(np.ceil(coverage * len(words)))))
            rows = [words[at : at + SEGMENT_WORDS] for at in range(0, max(1, len(words) - window + 1), SEGMENT_WORDS - window + 1)] if words else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(rows), pa.string()), pa.array([least] * len(rows), pa.int32()), pa.array([b" ".join(r) for r in rows], pa.binary()), pa.array([len(r) for r in rows], pa.int64())],
                ["item", "least", "words", "n"],
            )

    return cut


def _built(root: str, window: int):
    def build(group: pa.Table) -> pa.Table:
        made = Automaton(window)
        for item, words, least in zip(*(group[c].to_pylist() for c in ("item", "words", "least"))):
            made.add(item, words.split(b" "), least)
        fs, path = opened(root)
        fs.create_dir(path)
        name = attempt_name("automaton", group["shard"][0].as_py())
        with fs.open_output_stream(f"{path}/{name}") as out:
            out.write(pickle.dumps(made.finish()))
        return pa.table({"name": [name]})

    return build


def automata(items: DataFrame, window: int = 10, coverage: float = 1.0, id_col: str = "item_id", text_col: str = "text", words_each: int = AUTOMATON_WORDS) -> tuple[str, list[str]]:
    """Folder and names of the items' automata, each of about ``words_each`` words."""
    spark = items.sparkSession
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    cut = stored(mapped(rows, _segments(window, coverage), SEGMENTS).distinct(), "leak-items")
    total = cut.agg(F.sum("n")).first()[0] or 0
    root = work_path(spark, "leak-automata")
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(-(-total // words_each) or 1)).cast("int"))
    index = stored(dealt.groupBy("shard").applyInArrow(_built(root, window), "name string"), "leak-index")
    return root, sorted(r["name"] for r in index.collect())


@functools.lru_cache(1)
def _loaded(root: str, name: str) -> Automaton:
    fs, path = opened(root)
    with fs.open_input_stream(f"{path}/{name}") as source:
        return pickle.loads(source.read())


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order; those that touch are one."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((first, end))
    return out


class Scanner:
    """found(texts): for each text its number of words, disjoint hit spans of words, and item ids."""

    def __init__(self, root: str, names: list[str]):
        self.root, self.names = root, names

    def found(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        words = [joined(t) for t in texts]
        counts = [w.count(b" ") + 1 if w else 0 for w in words]
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        for name in self.names:
            made = _loaded(self.root, name)
            low = 0
            while low < len(texts):
                high, n = low, 0
                while high < len(texts) and (high == low or n + counts[high] < STEP_WORDS):
                    n += counts[high] + 1
                    high += 1
                self._scan(made, low, high, words, counts, spans, items)
                low = high
        return [(n, _merged(s), sorted(i)) for n, s, i in zip(counts, spans, items)]

    @staticmethod
    def _scan(made: Automaton, low: int, high: int, words, counts, spans, items) -> None:
        """Texts low to high at once, with a word of no item between them."""
        number = made.number.get
        listed = itertools.chain.from_iterable(itertools.chain(w.split(), (b"",)) for w in words[low:high])
        ids = np.fromiter((number(w, -1) for w in listed), np.int64, sum(counts[low:high]) + high - low)
        starts = np.concatenate([[0], np.cumsum(np.array(counts[low:high]) + 1)])
        seen: list[set[tuple[int, int]]] = [set() for _ in range(low, high)]
        for first, end, state, length in made.occurrences(ids):
            d = int(np.searchsorted(starts, first, "right")) - 1
            own, at = spans[low + d], int(starts[d])
            if own and own[-1][0] <= first - at <= own[-1][1]:
                own[-1] = own[-1][0], max(own[-1][1], end - at)
            else:
                own.append((first - at, end - at))
            seen[d].add((state, length))
        for d, states in enumerate(seen):
            items[low + d].update(i for s in states for k in made.named(*s) if (i := made.items[k]) is not None)


def _matched(root: str, names: list[str]):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(root, names)
        for batch in batches:
            for part in slices(batch, 1, STEP_BYTES):
                out = scanner.found(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([n for n, _, _ in out], pa.int64()),
                        pa.array([sum(e - f for f, e in s) for _, s, _ in out], pa.int64()),
                        pa.array([i for _, _, i in out], pa.list_(pa.string())),
                        pa.array([[{"first": f, "end": e} for f, e in s] for _, s, _ in out], pa.list_(_SPAN)),
                    ],
                    ["doc_id", "n_words", "n_hit", "items", "spans"],
                )

    return match


def matches(docs: DataFrame, items: DataFrame, window: int = 10, coverage: float = 1.0, id_col: str = "doc_id", text_col: str = "text", words_each: int = AUTOMATON_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, items (ids sorted as strings), spans (disjoint, of word numbers)."""
    root, names = automata(items, window, coverage, words_each=words_each)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(rows, _matched(root, names), FOUND)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the bytes from the first to the last word of each span."""
    raw = text.encode()
    first, end = places(raw)
    kept, at = [], 0
    for f, e in spans:
        kept.append(raw[at : first[f]])
        at = int(end[e - 1])
    return b"".join([*kept, raw[at:]]).decode()


def _cleaned(root: str, names: list[str], column: int, most: float):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(root, names)
        for batch in batches:
            for part in slices(batch, column, STEP_BYTES):
                texts = part.column(column).to_pylist()
                found = scanner.found(texts)
                stays = [sum(e - f for f, e in s) <= most * n for n, s, _ in found]
                new = [without_spans(t, s) if s and k else t for t, (_, s, _), k in zip(texts, found, stays)]
                columns = [*part.columns[:column], pa.array(new, part.schema.field(column).type), *part.columns[column + 1 :]]
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema).filter(pa.array(stays, pa.bool_()))

    return clean


def cleaned(docs: DataFrame, items: DataFrame, window: int = 10, coverage: float = 1.0, most_hit: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with all columns: hit spans cut out of texts, rows with more than the share ``most_hit`` of words hit dropped."""
    root, names = automata(items, window, coverage)
    return mapped(docs, _cleaned(root, names, docs.columns.index(text_col), most_hit), docs.schema)


def judged(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Digest of ``matches``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return matches(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
