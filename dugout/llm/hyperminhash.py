"""Near-duplicate groups by HyperMinHash sketches, confirmed on whole shingle sets.

Every document becomes the set of its word shingles (64-bit hashes). Documents with equal
sets form a class; one sketch a class is enough. A sketch has buckets; a bucket keeps, of
its smallest hash, the number of leading zeros and ten mantissa bits in sixteen bits. An
empty bucket borrows from a filled one, chosen by fixed random ranks so that equal sets
borrow equally.

Bands of six registers name buckets of classes that may be close. With 48 bands a pair at
the threshold of 0.8 is missed with a probability of 5e-7, a closer one far less often.
Band keys are counted as eight bytes each; only repeated ones go on. The member of a bucket
that meets most others in all its buckets is its centre, most often the text that was
copied. First every member is tested with its centres: by the Jaccard estimate of the
sketches, less the share of registers that agree by chance, then by the exact value on the
shingle sets of the whole texts. That connects most groups. Where members of a centre are
then still in several components, all pairs between components, the centre's included, are
compared exactly, in blocks of a bounded number of members, as products of 0/1 matrices; a
block gives a spanning forest of its links, never its pairs. A large group of near copies
costs rows in proportion to its members.

A pair of centre and member is given up when its estimate falls short by six standard
deviations, taken for the registers that the smaller set really fills (sets of up to some
ten shingles are never given up): 1e-9 of the pairs at exactly the threshold by the normal
tail. Of those, a pair whose group is unsettled is compared all the same.

Defined cases: a null text or one without words has no shingles and is linked with nothing;
with fewer words than a shingle has, the whole sequence is the one shingle; rows that
repeat an id are judged one by one; a row with a null id takes part: its group has the
smallest id of its members, and in a group without any id all rows stay. Further columns are ignored by ``groups`` and kept by
``kept_rows``.
"""

from __future__ import annotations

import functools
import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import mapped, rows_of, stored
from .components import components, joined

ROWS, BANDS = 6, 48
BUCKETS = ROWS * BANDS
#: Bits of the leading-zero count's place and of the mantissa.
MANTISSA = 10
#: Members of a block on its two sides, and columns of a matrix at a time.
LEFT, RIGHT, COLUMNS = 1024, 512, 4096
#: Standard deviations by which an estimate may fall short before a pair is given up, and
#: the variance of borrowed registers against independent ones.
SLACK, BORROWED = 6.0, 1.25

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words_each: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(words_each, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mixed(out * _M1 + h[i : len(h) - width + 1 + i])
    return np.unique(out)


def set_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


@functools.lru_cache(1)
def _ranks() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 62, (BUCKETS, BUCKETS))


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a sorted non-empty set: BUCKETS registers of 16 bits."""
    high = (found >> np.uint64(32)) * np.uint64(BUCKETS)
    bucket = (high >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # the smallest hash of each bucket, as the set is sorted
    rest = ((high[first] & np.uint64(0xFFFFFFFF)) << np.uint64(16)) | ((found[first] & np.uint64(0xFFFFFFFF)) >> np.uint64(16))
    m, e = np.frexp(rest.astype(np.float64))  # 48 bits: exact
    zeros = np.where(rest > 0, 48 - e, 48)
    mantissa = np.where(rest > 0, (2 * m - 1) * (1 << MANTISSA), 0).astype(np.int64)
    out = np.zeros(BUCKETS, np.uint16)
    filled = bucket[first]
    out[filled] = (zeros << MANTISSA) | mantissa
    if len(filled) < BUCKETS:
        empty = np.setdiff1d(np.arange(BUCKETS), filled, assume_unique=True)
        out[empty] = out[filled[_ranks()[np.ix_(filled, empty)].argmin(axis=0)]]
    return out


def chance_agreement() -> float:
    """Share of registers in which two unrelated sets of like size agree: same zeros and mantissa."""
    z = np.arange(1, 49, dtype=np.float64)
    return float((2.0 ** (-2 * z)).sum() / (1 << MANTISSA))


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, corrected for chance agreement."""
    c = chance_agreement()
    return ((a == b).mean(axis=1) - c) / (1 - c)


def _sketched(words_each: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, keys, regs = [], [], []
                for text in part.column(1).to_pylist():
                    found = shingles(text, words_each)
                    n.append(len(found))
                    keys.append(set_key(found) if len(found) else None)
                    regs.append(registers(found).astype("<u2").tobytes() if len(found) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "text_hash", "n_shingles", "set_key", "regs"])

    return sketch


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, BUCKETS)


def _band_keys(regs: pa.Array) -> np.ndarray:
    """A key for each band of each sketch."""
    rows = _stack(regs).reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(_mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _M1), rows.shape[:2])
    for i in range(ROWS):
        key = _mixed(key * _M1 + rows[:, :, i])
    return key.reshape(-1).view(np.int64)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band key, class) for every band of every sketch."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            rows = pa.array(np.repeat(np.arange(part.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(_band_keys(part.column(1))), part.column(0).take(rows)], ["band", "class"])


def least_estimate(n: Column, percent: int) -> Column:
    """The estimate below which a pair is given up; ``n`` is the size of the smaller set."""
    t = percent / 100
    filled = BUCKETS * (1 - F.pow(F.lit(1 - 1 / BUCKETS), n.cast("double"))) / BORROWED
    return F.lit(t) - SLACK * F.sqrt(t * (1 - t) / filled)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(estimate(_stack(batch.column(3)), _stack(batch.column(4))))], ["a", "b", "least", "estimate"])


def _packed(words_each: int, sent):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(3).compress
        for batch in batches:
            batch = batch.filter(pa.array(bloom.found(sent, batch.column(1))))
            for at in range(0, batch.num_rows, 256):
                texts = [t for t in batch.column(0).slice(at, 256).to_pylist() if t]
                keys = [set_key(shingles(t, words_each)) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([squeeze(t.encode()) for t in texts], pa.binary())], ["set_key", "packed"])

    return pack


def _confirmed(words_each: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        recent: OrderedDict[bytes, np.ndarray] = OrderedDict()  # centres come again and again

        def of(key: bytes, packed: bytes) -> np.ndarray:
            if key not in recent:
                recent[key] = shingles(unpack(packed).decode(), words_each)
                if len(recent) > 64:
                    recent.popitem(last=False)
            recent.move_to_end(key)
            return recent[key]

        for batch in batches:
            links = []
            for a, b, pa_, pb in rows_of(iter([batch]), 64):
                x, y = of(a, pa_), of(b, pb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((a, b))
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return confirm


def _forest(n: int, parent_of: np.ndarray, links: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those links that connect components not connected yet; ``parent_of`` numbers the components so far."""
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, p in enumerate(parent_of.tolist()):
        parent[top(i)] = top(p)
    for a, b in links:
        if (x := top(a)) != (y := top(b)):
            parent[x] = y
            yield a, b


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of two lists of sets, as products of their 0/1 matrices."""
    at = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    _, column, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    often = (times > 1)[column]  # what only one set has is in no intersection
    place = np.cumsum(times > 1) - 1
    at, column = at[often], place[column[often]]
    order = np.argsort(column, kind="stable")
    at, column = at[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        block = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        block[at[a:b], column[a:b] - low] = 1
        out += block[: len(left)] @ block[len(left) :].T
    return out.astype(np.int64)


def _compared(words_each: int, percent: int):
    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        rows = [*zip(*(left[c].to_pylist() for c in ("set_key", "component", "packed"))), *zip(*(right[c].to_pylist() for c in ("set_key", "component", "packed")))]
        found: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            sets = [shingles(unpack(p).decode(), words_each) for _, _, p in rows]
            n = left.num_rows
            both = common(sets[:n], sets[n:])
            size = np.array([len(x) for x in sets])
            close = np.argwhere(100 * both >= percent * (size[:n, None] + size[None, n:] - both))
            first: dict[bytes, int] = {}
            part_of = np.array([first.setdefault(c, i) for i, (_, c, _) in enumerate(rows)])
            found = list(_forest(len(rows), part_of, ((int(i), n + int(j)) for i, j in close)))
        return pa.table({"a": pa.array([rows[i][0] for i, _ in found], pa.binary()), "b": pa.array([rows[j][0] for _, j in found], pa.binary())})

    return compare


class _Tester:
    """Tests pairs of classes: estimate, then exact value. Holds only what takes part."""

    def __init__(self, docs: DataFrame, involved: DataFrame, words_each: int, percent: int):
        self.words_each, self.percent, self.involved = words_each, percent, involved
        ids = involved.select(F.xxhash64("rep", "text_hash").alias("k"))
        sent = bloom.build(ids, bloom.slots_for(involved.count()), repeats=False)
        texts = docs.select("text", F.xxhash64("doc_id", F.xxhash64("text")).alias("k"))
        packed = mapped(texts, _packed(words_each, sent), "set_key binary, packed binary")
        # One row a class, whatever else the filter let through and however often a row repeats.
        self.texts = stored(packed.groupBy("set_key").agg(F.min("packed").alias("packed")), "near-texts")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Links (a, b) of set keys among pairs (centre, class)."""
        side = lambda c, key: self.involved.select(F.col("class").alias(c), F.col("set_key").alias(key), F.col("n").alias(f"n{key}"), F.col("regs").alias(f"r{key}"))
        wide = pairs.join(side("centre", "a"), "centre").join(side("class", "b"), "class")
        # Sets of too different sizes cannot be close.
        sized = wide.where(100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb"))
        tested = sized.select("a", "b", least_estimate(F.least("na", "nb"), self.percent).alias("least"), "ra", "rb")
        close = stored(mapped(tested, _estimated, "a binary, b binary, least double, estimate double").where("estimate >= least"), "near-close")
        return self._exact(close)

    def _exact(self, close: DataFrame) -> DataFrame:
        one = self.texts.select(F.col("set_key").alias("a"), F.col("packed").alias("pa"))
        two = self.texts.select(F.col("set_key").alias("b"), F.col("packed").alias("pb"))
        full = close.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "pa", "pb")
        return stored(mapped(full, _confirmed(self.words_each, self.percent), "a binary, b binary").distinct(), "near-links")

    def blocks(self, members: DataFrame) -> DataFrame:
        """Links that connect components of a group: its smaller components against all members, block by block."""
        part = lambda salt, n: F.pmod(F.xxhash64("set_key", F.lit(salt)), F.col(n)).cast("int")
        all_parts = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
        cut = members.withColumns({"lefts": F.ceil(F.col("total") / LEFT), "rights": F.ceil(F.col("minor") / RIGHT)})
        wide = cut.join(self.texts, "set_key")
        key, columns = ["centre", "i", "j"], ["centre", "i", "j", "set_key", "component", "packed"]
        left = wide.withColumn("i", part(1, "lefts")).withColumn("j", all_parts("rights")).select(columns)
        right = wide.where("component <> main").withColumn("j", part(2, "rights")).withColumn("i", all_parts("lefts")).select(columns).toDF(*columns)
        found = left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(_compared(self.words_each, self.percent), "a binary, b binary")
        return stored(found.distinct(), "near-links")


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of groups (centre, set_key), centres too, that hold several components, with what is needed to cut a group into blocks."""
    known = stored(members.join(labels, members["set_key"] == labels["v"], "left").select("centre", "set_key", F.coalesce("component", "set_key").alias("component")), "near-known")
    share = known.groupBy("centre", "component").agg(F.count(F.lit(1)).alias("members"))
    whole = share.groupBy("centre").agg(F.max(F.struct("members", "component")).alias("m"), F.sum("members").alias("total"), F.count(F.lit(1)).alias("parts"))
    # A group of a centre and one other has been tested whole.
    whole = stored(whole.where("parts > 1 and total > 2").select("centre", F.col("m.component").alias("main"), "total", (F.col("total") - F.col("m.members")).alias("minor")), "near-unsettled")
    return known.join(whole, "centre")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words_each: int, percent: int) -> DataFrame:
    """Rows of ``groups`` with a hash of the text, which tells rows of one id apart."""
    if percent < 80:
        raise ValueError("the bands are laid out for 80 per cent and more")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    base = stored(mapped(hashed, _sketched(words_each), "doc_id long, text_hash long, n_shingles long, set_key binary, regs binary"), "near-sets")
    of_class = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n_shingles", "regs")).alias("m")
    classes = base.where("set_key is not null").groupBy("set_key").agg(of_class)
    classes = classes.select("set_key", F.xxhash64("set_key").alias("class"), F.col("m.doc_id").alias("rep"), F.col("m.text_hash").alias("text_hash"), F.col("m.n_shingles").alias("n"), F.col("m.regs").alias("regs"))
    classes = stored(classes, "near-classes")
    bands = stored(mapped(classes.select("class", "regs"), _banded, "band long, class long"), "near-bands")
    sizes = stored(bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-sizes")
    held = stored(bands.join(sizes, "band"), "near-held")
    # Who meets many others in its buckets is close to many: a copied text rather than one of its copies.
    ranks = stored(held.groupBy("class").agg(F.sum("size").alias("rank")), "near-ranks")
    buckets = stored(held.select("band", "class").join(ranks, "class"), "near-buckets")
    firsts = stored(buckets.groupBy("band").agg(F.max(F.struct("rank", "class")).alias("m")).select("band", F.col("m.class").alias("centre")), "near-firsts")
    involved = stored(classes.join(ranks, "class", "left_semi"), "near-involved")
    tester = _Tester(docs, involved, words_each, percent)

    # All that meet under one centre, whatever the band, are one group.
    pairs = stored(buckets.join(firsts, "band").select("centre", "class").distinct(), "near-members")
    labels = components(tester.links(pairs.where("centre <> class")))
    members = pairs.join(involved.select("class", "set_key"), "class").select("centre", "set_key")
    labels = joined(labels, tester.blocks(_unsettled(members, labels)))

    named = classes.select("set_key", "rep").join(labels, classes["set_key"] == labels["v"], "left").select("set_key", "rep", F.coalesce("component", "set_key").alias("component"))
    smallest = labels.join(classes.select("set_key", "rep"), labels["v"] == classes["set_key"]).groupBy(F.col("component").alias("top")).agg(F.min("rep").alias("least"))
    linked = stored(named.join(stored(smallest, "near-smallest"), F.col("component") == F.col("top"), "left").select(F.col("set_key").alias("class_key"), F.coalesce("least", "rep").alias("component_id")), "near-named")
    own = F.col("component_id").eqNullSafe(F.col("doc_id"))
    in_classes = base.where("set_key is not null").select("doc_id", "text_hash", "n_shingles", "set_key").join(linked, F.col("set_key") == F.col("class_key")).select("doc_id", "text_hash", "n_shingles", "component_id", own.alias("kept"))
    bare = base.where("set_key is null").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return in_classes.unionByName(bare)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Links have 100 * intersection >= percent * union.

    ``percent`` below 80 needs more bands than this module's.
    """
    return _grouped(docs, id_col, text_col, words_each, percent).drop("text_hash")


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns."""
    found = stored(_grouped(docs, id_col, text_col, words_each, percent), "near-decisions")
    key = [F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))]
    return bloom.without(docs, key, found.where("not kept").select("doc_id", "text_hash").distinct())