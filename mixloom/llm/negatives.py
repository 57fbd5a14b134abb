"""Hard-negative mining by Fagin's threshold algorithm.

Components become whole numbers ``floor(256 * x)``. Rows are dealt to shards, each one row with its vectors; anchors are packed in blocks, and
every block meets every shard. A shard keeps, for each dimension, its rows sorted by that component. An anchor reads these lists in step,
from the end that its component's sign favours (a component of zero favours none and its list isn't read), scores each row that it meets for the
first time with the whole vectors, and sums its own components times those last read in each list: the threshold, which no
unread row's score can exceed. A search ends once the threshold lies strictly below the k-th score of each of its windows, or below
the least score that a window admits, or when no row is left unread.

Positives come first: an anchor's window admits rows of its own label with any score, and the best of all shards are its positives.
Each positive gives a window of scores for the second search, which admits rows of other labels; all windows of an anchor share its
reading of the lists. Ties go to the smaller ``vec_id``.

Rows with a null id, label or vector, or any null or non-finite component, take no part. Shorter vectors are filled with zeros;
components are held to +-2^24, so that scores stay exact. Other rows with the anchor's id are no candidates of it, repeated
candidates count each; a repeated anchor id is searched once, with the least of its (label, vector). Without rows, anchors or positives
nothing is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.llm.base import stored
from mixloom.llm.nearest import usable

POSITIVES = 5
NEGATIVES = 10
SHARD_ROWS = 8_192
BLOCK_ROWS = 2_048
#: How far the lists are read before the threshold is first compared; each further reading is twice as long.
STEP = 16
HELD = 2**24
LOW = -(2**63)


@dataclass
class Shard:
    """Rows in the order of their ids, and for each dimension the rows by rising component."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    order: np.ndarray
    sorted: np.ndarray


def shard(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Shard:
    by_id = np.argsort(ids, kind="stable")
    ids, labels, vectors = ids[by_id], labels[by_id], vectors[by_id]
    order = np.argsort(vectors, axis=0, kind="stable").T
    return Shard(ids, labels, vectors, np.ascontiguousarray(order.astype(np.int32)), np.take_along_axis(vectors.T, order, axis=1))


class Best:
    """The k best so far of each window: scores falling, places in the order of ids rising among equals."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in low]

    def offer(self, rows: np.ndarray, scores: np.ndarray) -> None:
        for n, (low, high) in enumerate(zip(self.low, self.high)):
            fits = (scores >= low) & (scores <= high)
            if fits.any():
                own, points = np.concatenate([self.found[n][0], rows[fits]]), np.concatenate([self.found[n][1], scores[fits]])
                first = np.lexsort((own, -points))[: self.k]
                self.found[n] = own[first], points[first]

    def bar(self) -> int:
        """The threshold must fall strictly below this: the least over windows of the k-th score, or of the least one admitted."""
        kth = [points[-1] if len(points) == self.k else low for (_, points), low in zip(self.found, self.low)]
        return int(min(kth))


def search(at: Shard, anchor: np.ndarray, allowed: np.ndarray, best: Best, step: int = STEP) -> int:
    """Offers rows of the shard that are ``allowed`` until no other can be among the best. Returns the rows scored."""
    rows = len(at.ids)
    falling, rising = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    seen = np.zeros(rows, bool)
    depth, scored = 0, 0
    while depth < rows:
        to = min(rows, depth + step)
        met = np.zeros(rows, bool)
        if len(falling) or len(rising):
            met[at.order[falling, rows - to : rows - depth].ravel()] = True
            met[at.order[rising, depth:to].ravel()] = True
            threshold = int(anchor[falling] @ at.sorted[falling, rows - to]) + int(anchor[rising] @ at.sorted[rising, to - 1])
        else:
            met[depth:to] = True
            threshold = 0
        new = np.flatnonzero(met & ~seen)
        seen[new] = True
        scored += len(new)
        new = new[allowed[new]]
        best.offer(new, (at.vectors[new] @ anchor).astype(np.int64))
        if threshold < best.bar() or scored == rows:
            break
        depth, step = to, 2 * step
    return scored


def whole(flat: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(256 * flat.astype(np.float64)), -HELD, HELD).astype(np.int32)


def _packed(rows: DataFrame, name: str) -> DataFrame:
    """One row per group: ids, labels and vectors, filled to the longest, in bytes."""
    lists = rows.groupBy("_group").agg(F.sort_array(F.collect_list(F.struct("id", "label", "v"))).alias("rows"))
    schema = f"{name} long, ids binary, labels binary, width int, vectors binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                own = batch.column(1)[at].values
                lists_ = own.field("v")
                sizes = lists_.value_lengths().to_numpy()
                flat = whole(lists_.flatten().to_numpy(zero_copy_only=False))
                matrix = np.zeros((len(own), max(1, int(sizes.max(initial=1)))), np.int32)
                row = np.repeat(np.arange(len(own)), sizes)
                matrix[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
                parts = [own.field(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label")]
                columns = [batch.column(0)[at : at + 1], pa.array([parts[0]]), pa.array([parts[1]])]
                columns += [pa.array([matrix.shape[1]], pa.int32()), pa.array([matrix.tobytes()])]
                yield pa.RecordBatch.from_arrays(columns, [name, "ids", "labels", "width", "vectors"])

    return stored(lists.mapInArrow(run, schema), name)


def _unpacked(ids: bytes, labels: bytes, width: int, vectors: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), np.frombuffer(vectors, np.int32).reshape(-1, width)


def _searched(shards: DataFrame, blocks: DataFrame, n_shards: int, k: int, same_label: bool) -> DataFrame:
    """``anchor_id, window, vec_id, score``: of each shard, the k best of each window.

    ``windows`` of a block are lists of the anchor's id and the window's number, least and greatest score; where they are null, each
    anchor has one that admits every score.
    """
    schema = "anchor_id long, window int, vec_id long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                values = [batch.column(n)[at].as_py() for n in range(8)]
                ids, labels, vectors = _unpacked(*values[:4])
                anchor_ids, anchor_labels, anchors = _unpacked(*values[4:])
                width = max(vectors.shape[1], anchors.shape[1])
                kind = np.float64 if float(np.abs(vectors).max(initial=0)) * np.abs(anchors).max(initial=0) * width < 2.0**53 else np.int64
                vectors, anchors = (np.pad(m, ((0, 0), (0, width - m.shape[1]))).astype(kind) for m in (vectors, anchors))
                of = shard(ids, labels, vectors)
                if batch.column(8)[at].is_valid:
                    windows = batch.column(8)[at].values
                    asked, number, low, high = (windows.field(n).to_numpy() for n in range(4))
                else:
                    asked, number = anchor_ids, np.zeros(len(anchor_ids), np.int32)
                    low, high = np.full(len(asked), LOW), np.full(len(asked), -(LOW + 1))
                out: list[list] = [[], [], [], []]
                by_anchor = np.argsort(asked, kind="stable")
                for own in np.split(by_anchor, np.flatnonzero(np.diff(asked[by_anchor])) + 1):
                    anchor = int(asked[own[0]])
                    n = int(np.searchsorted(anchor_ids, anchor))
                    allowed = ((of.labels == anchor_labels[n]) == same_label) & (of.ids != anchor)
                    best = Best(low[own], high[own], k)
                    search(of, anchors[n], allowed, best)
                    for w, (rows, scores) in zip(number[own].tolist(), best.found):
                        out[0] += [anchor] * len(rows)
                        out[1] += [w] * len(rows)
                        out[2] += of.ids[rows].tolist()
                        out[3] += scores.tolist()
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                columns = [pa.array(c, kind) for c, kind in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "window", "vec_id", "score"])

    names = ("ids", "labels", "width", "vectors")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard")
    asked = blocks.select(every, *[F.col(c).alias(f"_{c}") for c in names], "windows")
    # Rows are packed vectors, and blocks come once per shard, which no estimate counts: neither side passes the driver.
    pairs = shards.join(asked.hint("merge"), "shard").select(*names, *[f"_{c}" for c in names], "windows")
    return pairs.mapInArrow(run, schema)


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = 30,
    most: int = 90,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vec_id, label, embedding``.

    ``anchors`` says which rows are anchors. Negatives score from ``least`` to ``most`` per cent of their positive; positives
    that score below zero have none.
    """
    if not 0 <= least <= most:
        raise ValueError("negatives score from least to most per cent, neither below zero")
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding")).select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("asked"),
    )
    counted = good.agg(F.count(F.lit(1)), F.count(F.when(F.col("asked"), 1))).first()
    n_shards, n_blocks = max(1, -(-counted[0] // shard_rows)), max(1, -(-counted[1] // block_rows))
    # Rows are dealt by their place in the input, so that repeated ones do not meet in one shard.
    number = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(n_shards))
    shards = _packed(good.select(number.alias("_group"), "id", "label", "v"), "shard")
    one_each = good.where("asked").groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    dealt = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).alias("_group")
    blocks = _packed(one_each.select(dealt, "id", "row.label", "row.v"), "block")

    window = "array<struct<anchor_id:long,number:int,low:long,high:long>>"
    near = _searched(shards, blocks.withColumn("windows", F.lit(None).cast(window)), n_shards, positives, True)
    chosen = stored(_best(near, ["anchor_id"], positives).select("anchor_id", "rank", "vec_id", "score"), "positives")

    # Whole scores with least * positive <= 100 * score <= most * positive; below zero there are none.
    asked = F.expr(
        f"struct(anchor_id, rank AS number, ({least} * score + 99) div 100 AS low, ({most} * score) div 100 AS high)"
    )
    block = F.pmod(F.xxhash64("anchor_id"), F.lit(n_blocks)).alias("block")
    admitted = chosen.where("score >= 0").groupBy(block).agg(F.collect_list(asked).cast(window).alias("windows"))
    far = _searched(shards, blocks.join(admitted.hint("merge"), "block"), n_shards, negatives, False)
    ranked = _best(far, ["anchor_id", "window"], negatives).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    named = chosen.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score", "rank": "window"})
    return ranked.join(named, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

