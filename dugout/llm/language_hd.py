"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram of letters (word edges count as
one) binds the first letter's vector rotated twice, the second's rotated once and the
third's by multiplication. A text bundles, that is adds, the vectors of its trigrams; a
language's prototype bundles the directions of its training texts. The nearest prototype
by cosine names the language.

Bundling a block of texts is one product of their trigram counts with the trigrams'
vectors. Prototypes are sums over all training texts, added in the tasks and then in a few
partial sums a language, in whole numbers, so their value does not depend on the order.

Defined cases: a null text and one without letters are ``und`` with score 0, as is every
text when there is nothing to learn from; ties go to the language that sorts first; very
long texts are read in slices whose edges overlap; a row with a null id is neither learned
from nor held out; a row with a null language is not learned from. ``kept_rows`` keeps all
columns, whatever their names.

``kept_rows`` rejects texts whose cosine is below half of what all but one in a hundred
labelled texts of their length reach with their own language, that is below what any clean
text is likely to have. All labelled rows count; one that was learned from is held against
its language without itself. Lengths are powers of two of the characters other than white
space, so few letters among many symbols are held against texts of full length; lengths with
fewer than 100 labelled rows take in the next longer ones, then the next shorter ones. With
nothing to learn from, texts with a letter stay.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, rows_of, slices

DIMENSIONS = 1024
#: Letters a to z, and hashed places for all others; 0 is anything but a letter.
ALPHABET = 128
UNKNOWN = "und"
#: Steps of a direction's components when training texts are added.
UNIT = 1 << 20
#: Characters of one slice of a text, texts of one product, trigram vectors that a worker keeps.
SLICE, BLOCK, MOST_TRIGRAMS = 1 << 18, 64, 20_000
#: Trigrams of one product, and bytes of texts that ``kept_rows`` holds as Python objects.
COLUMNS, STEP_BYTES = 1024, 1 << 22
#: Length classes, steps of a score, labelled rows that a threshold rests on, share of them below, part of their score.
CLASSES, STEPS, ENOUGH, BELOW, PART = 32, 1000, 100, 0.01, 0.5


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    return np.random.default_rng(20_003).choice(np.array([-1, 1], np.int8), (ALPHABET, DIMENSIONS))


@functools.lru_cache(1)
def _codes() -> np.ndarray:
    """Code point -> letter code; upper case needs no place, as texts are lower-cased before."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = c - 96 if 97 <= c <= 122 else 27 + (c * 2_654_435_761 >> 7) % (ALPHABET - 27)
    return out


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Numbers of the trigrams around every letter, slice by slice."""
    text = (text or "").lower()
    for at in range(0, len(text), SLICE):
        part = text[max(0, at - 1) : at + SLICE + 1]
        code = _codes()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        if at == 0:
            code = np.concatenate([[0], code])
        if at + SLICE >= len(text):
            code = np.concatenate([code, [0]])
        middle = np.flatnonzero(code[1:-1]) + 1
        yield (code[middle - 1] * ALPHABET + code[middle]) * ALPHABET + code[middle + 1]


class Bundler:
    """Vectors of texts. Keeps the vectors of trigrams met so far; starts anew beyond MOST_TRIGRAMS."""

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.place = np.full(ALPHABET**3, -1, np.int32)
        self.vectors = np.zeros((0, DIMENSIONS), np.int8)
        self.known = 0

    def _learn(self, new: np.ndarray) -> None:
        letters = _letters()
        one, two, three = new // ALPHABET**2, new // ALPHABET % ALPHABET, new % ALPHABET
        bound = np.roll(letters, 2, axis=1)[one] * np.roll(letters, 1, axis=1)[two] * letters[three]
        if self.known + len(new) > len(self.vectors):
            grown = np.zeros((self.known + len(new) + 2048, DIMENSIONS), np.int8)
            grown[: self.known] = self.vectors[: self.known]
            self.vectors = grown
        self.vectors[self.known : self.known + len(new)] = bound
        self.place[new] = np.arange(self.known, self.known + len(new), dtype=np.int32)
        self.known += len(new)

    def bundle(self, texts: list[str | None]) -> np.ndarray:
        """One row a text; zero where it has no letter."""
        if self.known > MOST_TRIGRAMS:
            self.reset()
        out = np.zeros((len(texts), DIMENSIONS), np.float64)
        pending, rows, size = [], [], 0
        for i, text in enumerate(texts):
            for found in trigrams(text):
                pending.append(found)
                rows.append(np.full(len(found), i))
                size += len(found)
                if size > SLICE:
                    self._add(out, np.concatenate(pending), np.concatenate(rows))
                    pending, rows, size = [], [], 0
        if size:
            self._add(out, np.concatenate(pending), np.concatenate(rows))
        return out

    def _add(self, out: np.ndarray, found: np.ndarray, rows: np.ndarray) -> None:
        if len(new := np.unique(found[self.place[found] < 0])):
            self._learn(new)
        used = np.zeros(self.known, bool)
        used[at := self.place[found]] = True
        columns = np.flatnonzero(used)
        local = np.zeros(self.known, np.int64)
        local[columns] = np.arange(len(columns))
        low = rows[0]
        n = int(rows[-1] - low + 1)
        counts = np.bincount((rows - low) * len(columns) + local[at], minlength=n * len(columns)).reshape(n, len(columns))
        for at in range(0, len(columns), COLUMNS):
            part = slice(at, at + COLUMNS)
            out[low : low + n] += counts[:, part].astype(np.float32) @ self.vectors[columns[part]].astype(np.float32)


@functools.lru_cache(1)
def _bundler() -> Bundler:
    return Bundler()


def directions(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, part, sums): what this task adds to each language's prototype."""
    total: dict[str, np.ndarray] = {}

    def add(langs: list[str], texts: list[str]) -> None:
        whole = np.rint(directions(_bundler().bundle(texts)) * UNIT).astype(np.int64)
        for lang in set(langs):
            total[lang] = total.get(lang, 0) + whole[[x == lang for x in langs]].sum(axis=0)

    held: list[tuple] = []
    for row in rows_of(batches):
        held.append(row)
        if len(held) == BLOCK:
            add(*map(list, zip(*held)))
            held = []
    if held:
        add(*map(list, zip(*held)))
    if total:
        part = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([part] * len(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["lang", "part", "sums"])


def _added(group: pa.Table) -> pa.Table:
    out = np.zeros(DIMENSIONS, np.int64)
    for x in group["sums"].to_pylist():
        out += np.frombuffer(x, np.int64)
    return pa.table({"lang": group["lang"].slice(0, 1), "part": group["part"].slice(0, 1), "sums": pa.array([out.tobytes()], pa.binary())})


def _learned(labelled: DataFrame, lang_col: str, text_col: str) -> tuple[list[str], np.ndarray]:
    """Languages in order and the sums of their texts' directions. Small: a vector a language."""
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    schema = "lang string, part int, sums binary"
    parts = mapped(rows, _sums, schema).groupBy("lang", "part").applyInArrow(_added, schema).groupBy("lang").applyInArrow(_added, schema)
    found = sorted((r["lang"], r["sums"]) for r in parts.select("lang", "sums").toLocalIterator())
    return [x for x, _ in found], np.array([np.frombuffer(bytes(s), np.int64) for _, s in found], np.float64).reshape(-1, DIMENSIONS) / UNIT


def prototypes(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order and their directions, from all rows with a language."""
    langs, sums = _learned(labelled, lang_col, text_col)
    return langs, directions(sums)


def length_class(text: str | None) -> int:
    return min(CLASSES - 1, sum(map(len, (text or "").split())).bit_length())


def _own_scores(langs: list[str], sums: np.ndarray):
    """(size, step, n): how many labelled texts of a length have a score with their own language."""
    place, length = {x: i for i, x in enumerate(langs)}, np.sqrt((sums**2).sum(axis=1))
    profiles = directions(sums)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, STEPS + 1), np.int64)

        def add(rows: list[tuple]) -> None:
            vectors = directions(_bundler().bundle([r[1] for r in rows]))
            for (lang, text, learned), vector in zip(rows, vectors):
                if lang not in place or not vector.any():
                    continue
                own = float(vector @ profiles[i := place[lang]])
                if learned:  # the cosine with the sum of the others
                    rest = length[i] ** 2 - 2 * own * length[i] + 1
                    if rest < 1e-6:
                        continue
                    own = (own * length[i] - 1) / np.sqrt(rest)
                total[length_class(text), int(min(1.0, max(0.0, own)) * STEPS)] += 1

        held: list[tuple] = []
        for row in rows_of(batches, BLOCK):
            held.append(row)
            if len(held) == BLOCK:
                add(held)
                held = []
        if held:
            add(held)
        sizes, steps = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(steps, pa.int32()), pa.array(total[sizes, steps], pa.int64())], ["size", "step", "n"])

    return count


def thresholds(counts: np.ndarray) -> np.ndarray:
    """Least score a length class, from counts of (class, step of the score)."""
    out = np.zeros(len(counts))
    for k in range(len(counts)):
        pool = np.zeros(counts.shape[1], np.int64)
        for other in [*range(k, len(counts)), *range(k - 1, -1, -1)]:
            pool = pool + counts[other]
            if pool.sum() >= ENOUGH:
                break
        if n := int(pool.sum()):
            out[k] = PART * int(np.searchsorted(pool.cumsum(), int(BELOW * n) + 1)) / STEPS
    return out


def _thresholds(docs: DataFrame, langs: list[str], sums: np.ndarray, learned: Column, text_col: str, lang_col: str) -> np.ndarray:
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    counts = np.zeros((CLASSES, STEPS + 1), np.int64)
    if langs:
        for r in mapped(rows, _own_scores(langs, sums), "size int, step int, n long").groupBy("size", "step").agg(F.sum("n").alias("n")).toLocalIterator():
            counts[r["size"], r["step"]] = r["n"]
    return thresholds(counts)


def _judge(langs: list[str], profiles: np.ndarray):
    def judge(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        best, score = [], []
        for at in range(0, len(texts), BLOCK):
            vectors = _bundler().bundle(texts[at : at + BLOCK])
            close = directions(vectors) @ profiles.T if langs else np.zeros((len(vectors), 1))
            lettered = (vectors != 0).any(axis=1) & bool(langs)
            best += [langs[i] if some else UNKNOWN for i, some in zip(close.argmax(axis=1), lettered)]
            score += [min(1.0, max(0.0, float(s))) if some else 0.0 for s, some in zip(close.max(axis=1), lettered)]
        return best, np.array(score)

    return judge


def _predicted(langs: list[str], profiles: np.ndarray):
    judge = _judge(langs, profiles)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lang, score = judge(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return predict


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def predictions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 2) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score. Learns from the rows of the other folds."""
    langs, profiles = prototypes(docs.where(fold(id_col) != held_out), lang_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold(id_col) == held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return mapped(rows, _predicted(langs, profiles), "doc_id long, held_out boolean, lang_pred string, score double")


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 2, least_score: float | None = None) -> DataFrame:
    """Rows whose language can be told, with a cosine of ``least_score`` or more, or one that labelled rows of their length have; all columns stay."""
    learned = fold(id_col) != held_out
    langs, sums = _learned(docs.where(learned), lang_col, text_col)
    if langs:
        least = _thresholds(docs, langs, sums, learned, text_col, lang_col) if least_score is None else np.full(CLASSES, least_score)
    judge, column = _judge(langs, directions(sums)), docs.columns.index(text_col)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, STEP_BYTES, 1024):
                texts = part.column(column).to_pylist()
                if langs:
                    lang, score = judge(texts)
                    kept = (np.array(lang, object) != UNKNOWN) & (score >= least[[length_class(t) for t in texts]])
                else:
                    kept = np.array([any(len(t) > 0 for t in trigrams(text)) for text in texts], bool)
                yield part.filter(pa.array(kept))

    return mapped(docs, told, docs.schema)
