"""Exact top-k search by inner product: a ball tree per shard, branch and bound with a shared k-th score.

Components become whole numbers ``floor(256 * x)``. Vectors are dealt to shards by the hash of their id, each shard becomes one row
with its vectors and a ball tree over them; queries are packed in blocks. Every block meets every shard: first one
shard each, whose k-th scores are then carried along as the bound for all others, raised within each shard as better
candidates are found. A node is left out for the queries whose k-th score exceeds the greatest inner product
that its ball allows (centre times query plus radius times the query's length); children are visited in the order
of that bound. A query's candidates of all shards are cut to its k best at the end, ties to the smaller id.

Vectors that are null or hold null or non-finite components take no part; shorter ones are filled with zeros. A query's own
row, that is one of the same id, is no candidate. Rows without an id take no part. Repeated candidate rows count
each, of equal ones k at most, as no more can be returned; a repeated query id is searched once, with
the least of its vectors. Fewer than k candidates give all there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.llm.base import stored

K = 5
SHARD_ROWS = 16_384
BLOCK_ROWS = 4_096
LEAF = 256
#: What the bounds may be off by rounding, as a part of their size.
SLACK = 1e-9
LOW = -(2**63)


@dataclass
class Ball:
    """A node: rows ``start`` to ``end`` of the tree's order, with centre and radius."""

    start: int
    end: int
    centre: np.ndarray
    radius: float
    children: tuple[Ball, Ball] | None = None


def build(vectors: np.ndarray, leaf: int = LEAF) -> tuple[Ball, np.ndarray]:
    """The root and the order of rows: a node is divided at the median along the line between two far rows."""
    order = np.arange(len(vectors))

    def node(start: int, end: int) -> Ball:
        own = vectors[order[start:end]]
        centre = own.mean(axis=0)
        away = ((own - centre) ** 2).sum(axis=1)
        ball = Ball(start, end, centre, float(np.sqrt(away.max())) * (1 + SLACK))
        if end - start > leaf and away.max() > 0:
            one = own[away.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            middle = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(own @ (other - one), middle)]
            ball.children = (node(start, start + middle), node(start + middle, end))
        return ball

    return node(0, len(vectors)), order


class Best:
    """The k best so far of each query: scores falling, ids rising among equals."""

    def __init__(self, ids: np.ndarray, k: int, bound: np.ndarray):
        self.own, self.k, self.bound = ids, k, bound.copy()
        self.scores = np.full((len(ids), k), LOW, np.int64)
        self.ids = np.full((len(ids), k), 2**63 - 1, np.int64)

    def offer(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: a row for each query in ``at``, a column for each of ``ids``."""
        scores = np.where((ids[None, :] == self.own[at][:, None]) | (scores < self.bound[at][:, None]), LOW, scores)
        some = (scores > LOW).any(axis=1)
        at, scores = at[some], scores[some]
        if not len(at):
            return
        all_scores = np.concatenate([self.scores[at], scores], axis=1)
        all_ids = np.concatenate([self.ids[at], np.broadcast_to(ids, scores.shape)], axis=1)
        first = np.lexsort((all_ids, ~all_scores), axis=1)[:, : self.k]
        self.scores[at] = np.take_along_axis(all_scores, first, axis=1)
        self.ids[at] = np.take_along_axis(all_ids, first, axis=1)
        self.bound[at] = np.maximum(self.bound[at], self.scores[at, -1])


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    width = queries.shape[1]
    if np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, width) < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


def search(root: Ball, order: np.ndarray, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    length = np.sqrt((queries**2).sum(axis=1)) * (1 + SLACK)

    def limit(ball: Ball, at: np.ndarray) -> np.ndarray:
        bound = queries[at] @ ball.centre + length[at] * ball.radius
        return bound + np.abs(bound) * SLACK + 1

    def visit(ball: Ball, at: np.ndarray, bound: np.ndarray) -> None:
        at = at[bound >= best.bound[at]]
        if not len(at):
            return
        if ball.children is None:
            rows = order[ball.start : ball.end]
            best.offer(at, ids[rows], products(queries[at], vectors[rows]))
            return
        left, right = (limit(child, at) for child in ball.children)
        for chosen, turns in ((left >= right, (0, 1)), (left < right, (1, 0))):
            for turn in turns:
                visit(ball.children[turn], at[chosen], (left, right)[turn][chosen])

    everyone = np.arange(len(queries))
    visit(root, everyone, limit(root, everyone))


def usable(column: str) -> Column:
    """Whether an array of numbers has no null, NaN or infinity in it."""
    wide = F.col(column).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.col(column).isNotNull() & ~F.exists(wide, bad)


def _packed(rows: DataFrame, group: str, names: tuple[str, str, str]) -> DataFrame:
    """One row per group: ids, and vectors one after the other, filled to the longest."""
    named = rows.select(group, F.struct("id", "v").alias("_row"))
    lists = named.groupBy(group).agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    number, ids, values = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                packed = batch.column(1)[at].values
                own = packed.field("id").to_numpy().astype(np.int64)
                lists_ = packed.field("v")
                sizes = lists_.value_lengths().to_numpy()
                flat = np.floor(256 * lists_.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
                matrix = np.zeros((len(own), max(1, int(sizes.max(initial=1)))))
                row = np.repeat(np.arange(len(own)), sizes)
                matrix[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
                columns = [batch.column(0)[at : at + 1], pa.array([own.tobytes()]), pa.array([matrix.tobytes()])]
                yield pa.RecordBatch.from_arrays(columns, [number, ids, values])

    return lists.mapInArrow(run, f"{number} long, {ids} binary, {values} binary")


def _unpacked(ids: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(values, np.float64).reshape(len(own), -1)


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """``block, query_id, vec_id, score`` of pairs of a shard and a block with the bounds of its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                shard, ids, values, block, query_ids, queries, bounds = (batch.column(n)[at].as_py() for n in range(7))
                if shard != last:
                    ids, vectors = _unpacked(ids, values)
                    last, tree = shard, (*build(vectors), vectors, ids)
                root, order, vectors, ids = tree
                own, asked = _unpacked(query_ids, queries)
                width = max(asked.shape[1], vectors.shape[1])
                if width > vectors.shape[1]:
                    vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
                    root, order = build(vectors)
                asked = np.pad(asked, ((0, 0), (0, width - asked.shape[1])))
                bound = np.frombuffer(bounds, np.int64) if bounds else np.full(len(own), LOW)
                best = Best(own, k, bound)
                search(root, order, vectors, ids, asked, best)
                found = best.scores > LOW
                row = np.nonzero(found)[0]
                columns = [np.full(len(row), block), own[row], best.ids[found], best.scores[found]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "query_id", "vec_id", "score"])

    ordered = pairs.select("shard", "ids", "vectors", "block", "query_ids", "queries", "bounds")
    return ordered.mapInArrow(run, "block long, query_id long, vec_id long, score long")


def _bounds(blocks: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Blocks with the k-th score of each of their queries so far, in the order of their ids."""
    kth = found.groupBy("block", "query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(LOW)).alias("kth")
    )
    lists = kth.groupBy("block").agg(F.collect_list(F.struct("query_id", "kth")).alias("_kth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for ids, kth in zip(batch.column("query_ids").to_pylist(), batch.column("_kth").to_pylist()):
                of = {x["query_id"]: x["kth"] for x in kth or []}
                bounds.append(np.array([of.get(i, LOW) for i in np.frombuffer(ids, np.int64).tolist()], np.int64).tobytes())
            columns = [*(batch.column(c) for c in ("block", "query_ids", "queries")), pa.array(bounds, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "query_ids", "queries", "bounds"])

    joined = blocks.hint("merge").join(lists, "block", "left").select("block", "query_ids", "queries", "_kth")
    return joined.mapInArrow(run, "block long, query_ids binary, queries binary, bounds binary")


def top_k(
    vectors: DataFrame, queries: Column, k: int = K, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``vec_id, embedding``; ``queries`` says which rows are queries."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v"), queries.alias("asked")
    )
    # Of equal rows k at most can be among the k best, so the others go before any shard gets them.
    single = rows.groupBy("id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("_n"), F.bool_or("asked").alias("asked"))
    good = stored(single.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n"), "vectors")
    counted = good.agg(F.count(F.lit(1)), F.count(F.when(F.col("asked"), 1))).first()
    n_shards, n_blocks = max(1, -(-counted[0] // shard_rows)), max(1, -(-counted[1] // block_rows))

    def group(n: int) -> Column:
        return F.pmod(F.xxhash64("id", "v"), F.lit(n)).alias("_group")

    shards = stored(_packed(good.select(group(n_shards), "id", "v"), "_group", ("shard", "ids", "vectors")), "shards")
    asked = good.where("asked").groupBy("id").agg(F.min("v").alias("v"))
    blocks = stored(_packed(asked.select(group(n_blocks), "id", "v"), "_group", ("block", "query_ids", "queries")), "blocks")
    first = F.pmod(F.col("block"), F.lit(n_shards)).alias("shard")
    start = blocks.select("*", first, F.lit(None).cast("binary").alias("bounds"))
    # Rows are packed vectors, and blocks come once per shard, which no estimate counts: neither side passes the driver.
    found = stored(_searched(shards.join(start.hint("merge"), "shard"), k), "found")
    if n_shards > 1:
        others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long")), lambda s: s != first)
        rest = _bounds(blocks, found, k).withColumn("shard", F.explode(others))
        found = found.unionByName(_searched(shards.join(rest.hint("merge"), "shard").sortWithinPartitions("shard"), k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
