"""Approximate nearest neighbours by cosine with a hierarchical k-means tree.

The tree is fitted on a sample of at most ``most_sampled`` vectors (smallest hash of the
id), so it is small and every task has it. Every vector goes down to one leaf. A query
visits leaves best bin first: a priority queue holds open nodes by the cosine of their
centre, the best is opened, its children join the queue. How many leaves a query visits is
calibrated: at most ``most_calibrating`` queries are answered by brute force over all
vectors in blocks, and visits widen until their leaves hold ``recall`` of the true answers.

Equal vectors have equal scores and ties go to smaller ids, so of each distinct vector the
k + 1 smallest ids (one may be the query's own) are all that an answer can contain; the
tree holds distinct vectors with those ids, and one vector held by a third of all rows is
one entry. Leaves are split into chunks, and the queries that visit a leaf into blocks, so
that a task holds some thousand vectors and queries whatever a leaf attracts.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have not
the most frequent length take no part, nor do rows with a null id; rows that repeat id and
vector count once; an id with several vectors is several candidates, and as a query it is
answered for each; with no other vector there is no answer. Further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, ship, stored

BRANCHES = 8
#: Vectors of a chunk and queries of a block.
CHUNK, BLOCK = 4096, 1024


@dataclass
class Tree:
    """Nodes with unit centres; node 0 is the root, a node without children is a leaf."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)

    @classmethod
    def fit(cls, vectors: np.ndarray, leaf_rows: int, seed: int = 5) -> Tree:
        """Splits nodes of more than ``leaf_rows`` sample rows into up to BRANCHES clusters each."""
        tree, rng = cls(), np.random.default_rng(seed)
        tree._node(unit(vectors.mean(axis=0, keepdims=True))[0] if len(vectors) else np.zeros(1))
        todo = [(0, vectors)]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= leaf_rows:
                continue
            centres, of = clusters(rows, BRANCHES, rng)
            if len(centres) < 2:
                continue
            for i, centre in enumerate(centres):
                tree.children[node].append(child := tree._node(centre))
                todo.append((child, rows[of == i]))
        return tree

    def _node(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        return len(self.centres) - 1

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector, always going to the nearest child."""
        at = np.zeros(len(vectors), np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            at[rows] = node
            if self.children[node] and len(rows):
                kids = np.array(self.children[node])
                best = kids[(vectors[rows] @ np.array([self.centres[k] for k in kids]).T).argmax(axis=1)]
                todo += [(int(k), rows[best == k]) for k in kids]
        return at

    def best_first(self, vector: np.ndarray) -> Iterator[int]:
        """Leaves in the order in which a best-bin-first search opens them."""
        queue = [(-1.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield node
            for child in self.children[node]:
                heapq.heappush(queue, (-float(self.centres[child] @ vector), child))


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def clusters(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; clusters that stay empty are left out."""
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        of = (rows @ centres.T).argmax(axis=1)
        centres = unit(np.array([rows[of == i].sum(axis=0) for i in range(len(centres)) if (of == i).any()]))
    of = (rows @ centres.T).argmax(axis=1)
    used = np.unique(of)
    return centres[used], np.searchsorted(used, of)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def cosine(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows, each summed alike wherever it stands."""
    return (rows * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((rows * rows).sum(axis=1)))


def best(q: np.ndarray, own: int, rows: np.ndarray, ids: list[list[int]], scores: np.ndarray, k: int) -> list[tuple[float, int, int]]:
    """(score, id, row) of the k nearest of ``rows``; ``scores`` are quick cosines, the result has exact ones."""
    if not len(scores):
        return []
    least = np.partition(scores, -(k + 1))[-(k + 1)] if len(scores) > k + 1 else -2.0
    near = np.flatnonzero(scores >= least - 1e-9)
    exact = cosine(q, rows[near])
    found = [(-s, i, int(r)) for s, r in zip(exact.tolist(), near) for i in ids[r] if i != own]
    return [(-s, i, r) for s, i, r in heapq.nsmallest(k, found)]


def _usable(column: str):
    whole = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(column).isNotNull() & F.coalesce(whole, F.lit(False)) & F.exists(column, lambda x: x != 0)


def _placed(tree):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.value.leaves(unit(_matrix(batch.column(0))))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf, pa.int32())], ["vec", "ids", "leaf"])

    return place


def _truth(queries, k: int):
    """Of every batch, the nearest of each calibrating query with their leaves."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = queries.value
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                rows, own, leaf = _matrix(part.column(0)), part.column(1).to_pylist(), part.column(2).to_pylist()
                quick = unit(vectors) @ unit(rows).T
                for q, (i, v) in enumerate(zip(ids, vectors)):
                    out += [(q, s, n, leaf[r]) for s, n, r in best(v, i, rows, own, quick[q], k)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.float64(), pa.int64(), pa.int32()))], ["q", "score", "vec_id", "leaf"])

    return find


def _visits(tree, leaves: int):
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for i, v in enumerate(unit(_matrix(part.column(1)))):
                    out += [(i, leaf) for _, leaf in zip(range(leaves), tree.value.best_first(v))]
                rows, leaf = zip(*out)
                taken = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(leaf, pa.int32())], ["query_id", "query_vec", "leaf"])

    return visit


def _searched(k: int):
    def search(key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if vectors.num_rows and queries.num_rows:
            rows, ids = _matrix(vectors["vec"].combine_chunks()), vectors["ids"].to_pylist()
            asked, own = _matrix(queries["query_vec"].combine_chunks()), queries["query_id"].to_pylist()
            lengths = unit(rows).T
            for at in range(0, len(asked), 64):
                quick = unit(asked[at : at + 64]) @ lengths
                for q, scores in enumerate(quick, at):
                    out += [(q, s, i) for s, i, _ in best(asked[q], own[q], rows, ids, scores, k)]
        at, score, found = zip(*out) if out else ((), (), ())
        taken = queries.select(["query_id", "query_key"]).take(pa.array(at, pa.int64()))
        return pa.table({"query_id": taken["query_id"], "query_key": taken["query_key"], "score": pa.array(score, pa.float64()), "vec_id": pa.array(found, pa.int64())})

    return search


def _blocks(counts: dict[int, int], size: int):
    """Number of parts of a leaf with that many rows, as a column on ``leaf``."""
    wide = [(leaf, -(-n // size)) for leaf, n in counts.items() if n > size]
    if not wide:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for pair in wide for x in pair])
    return F.coalesce(table[F.col("leaf")], F.lit(1))


def most_in_leaf(rows: int, sampled: int, leaf_rows: int, least_leaves: int) -> int:
    """Sample rows of a leaf, never fewer than 32 to a split."""
    return max(32, min(leaf_rows, rows // least_leaves) * sampled // max(rows, 1))


def neighbours(
    vectors: DataFrame,
    queries=None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 5,
    recall: float = 0.98,
    most_sampled: int = 20_000,
    most_calibrating: int = 200,
    leaf_rows: int = 1000,
    least_leaves: int = 8,
) -> DataFrame:
    """Per query: query_id, rank, vec_id, score of the nearest found. ``queries`` is a condition on ``vec_id``, by default all rows.

    Leaves hold about ``leaf_rows`` vectors, or fewer where that gives a small table less
    than ``least_leaves``; in large ones the sample bounds their number.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).where(F.col("vec_id").isNotNull() & _usable("vec"))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    result = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("vec") == length["n"]).distinct()
    first_ids = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    distinct = stored(first_ids.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-vectors")
    n = distinct.count()

    sample = distinct.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(most_sampled).select("vec").collect()
    unit_sample = unit(np.array([r["vec"] for r in sample], np.float64).reshape(len(sample), -1))
    tree = spark.sparkContext.broadcast(Tree.fit(unit_sample, most_in_leaf(n, len(sample), leaf_rows, least_leaves)))
    index = stored(mapped(distinct, _placed(tree), "vec array<float>, ids array<long>, leaf int".replace("float", rows.schema["vec"].dataType.elementType.simpleString())), "ann-index")

    asked = rows.where(F.lit(True) if queries is None else queries).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query_vec"))
    chosen = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(most_calibrating).collect()
    if not chosen:
        return spark.createDataFrame([], result)
    own, points = [r["query_id"] for r in chosen], np.array([r["query_vec"] for r in chosen], np.float64)
    truth = mapped(index, _truth(spark.sparkContext.broadcast((own, points)), k), "q int, score double, vec_id long, leaf int")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    true = truth.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("q", "leaf").collect()
    ranks = [{leaf: r for r, leaf in enumerate(tree.value.best_first(v))} for v in unit(points)]
    reach = sorted(ranks[t["q"]][t["leaf"]] for t in true)
    leaves = 1 + (reach[min(len(reach) - 1, int(np.ceil(recall * len(reach))))] if reach else 0)

    visits = stored(mapped(asked, _visits(tree, leaves), "query_id long, query_vec array<float>, leaf int".replace("float", rows.schema["vec"].dataType.elementType.simpleString())), "ann-visits")
    held = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # at most a row a leaf
    calls = {r["leaf"]: r["count"] for r in visits.groupBy("leaf").count().collect()}
    chunks, blocks = _blocks(held, CHUNK), _blocks(calls, BLOCK)
    left = index.withColumn("chunk", F.pmod(F.xxhash64("ids"), chunks).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    right = visits.withColumn("query_key", F.xxhash64("query_vec")).withColumn("block", F.pmod(F.xxhash64("query_id", "query_key"), blocks).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), (chunks - 1).cast("int"))))
    key = ["leaf", "chunk", "block"]
    found = left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(_searched(k), "query_id long, query_key long, score double, vec_id long")
    nearest = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
