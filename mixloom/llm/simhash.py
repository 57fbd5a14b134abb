"""SimHash near-duplicates: fingerprints, links at a few differing bits, components.

Fingerprints that are equal are one. Every pair within the distance shares all bits of some three out of seven
blocks of bits if at most four bits differ, so buckets by three blocks hold every link, at every size. In a bucket
a pivot table has the Hamming distances of its fingerprints to many reference fingerprints. By the triangle
inequality a pair whose distances to one reference differ by more than the limit is no link, so pairs are discarded
by their greatest coordinate difference and only survivors are verified. A bucket gives links that connect what is
connected in it, not all its pairs: a fingerprint within the limit of another is attached to it, and groups made so
are compared only as long as nothing connects them.

A null or empty text, or one of white space, has fingerprint zero, linked like any other. A text with fewer words
than a shingle is one shingle. Repeated rows share a component; null ids are ignored where the smallest is sought.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.llm.base import stored, one_of_each, unused
from mixloom.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCKS = 7
REFERENCES = 16
#: Buckets of so few fingerprints are compared in one go with all others of their batch.
SMALL = 8


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    from xxhash import xxh64_digest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, last = (ends - lengths).tolist(), ends.tolist()
    last = last[shingle - 1 :] or last[-1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(last), 65_536):
        spans = zip(starts[at : at + 65_536], last[at : at + 65_536])
        hashes = np.frombuffer(b"".join([xxh64_digest(joined[i:j], SEED) for i, j in spans]), np.uint8)
        counts += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(last))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, fp``; the key is a hash of the text, null for a null one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py() or b"", shingle) for t in batch.column("text")]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(fps, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])

    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("text_key"),
        F.col("text").cast("binary").alias("text"),
    )
    return plain.mapInArrow(run, "doc_id long, text_key long, fp long")


def references(n: int = REFERENCES) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**64, n, dtype=np.uint64)


def pivot_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def _survive(table: np.ndarray, i, j, limit: int) -> np.ndarray:
    return np.abs(table[i] - table[j]).max(axis=-1) <= limit


def small_links(fps: np.ndarray, bucket: np.ndarray, refs: np.ndarray, limit: int) -> list[np.ndarray]:
    """All links within buckets of up to ``SMALL`` fingerprints; ``bucket`` is ascending."""
    table, out = pivot_table(fps, refs), []
    for step in range(1, SMALL):
        i = np.flatnonzero(bucket[:-step] == bucket[step:]) if step < len(fps) else np.empty(0, np.int64)
        i = i[_survive(table, i, i + step, limit)]
        i = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= limit]
        out.append(np.stack([fps[i], fps[i + step]], axis=1))
    return out


def large_links(fps: np.ndarray, refs: np.ndarray, limit: int) -> list[np.ndarray]:
    """Links that connect what is connected in one bucket."""
    table, out = pivot_table(fps, refs), []
    owner, free, heads = np.full(len(fps), -1), np.arange(len(fps)), []
    while len(free):
        head = free[0]
        near = free[_survive(table, free, head, limit)]
        near = near[np.bitwise_count(fps[near] ^ fps[head]) <= limit]
        owner[near] = len(heads)
        heads.append(head)
        rest = near[near != head]
        out.append(np.stack([np.full(len(rest), fps[head]), fps[rest]], axis=1))
        free = free[owner[free] < 0]
    order = np.argsort(owner, kind="stable")
    members = np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)
    label, head_fps = np.arange(len(heads)), fps[np.array(heads, np.int64)]
    for p in range(len(heads)):
        apart = np.bitwise_count(head_fps ^ head_fps[p]) <= 3 * limit
        for q in np.flatnonzero(apart & (label != label[p])):
            if label[q] == label[p]:
                continue
            found = _cross_link(fps, table, members[p], members[q], limit)
            if found is not None:
                out.append(fps[np.array([found])])
                label[label == label[q]] = label[p]
    return out


def _cross_link(fps, table, left, right, limit):
    for i in left:
        j = right[_survive(table, right, i, limit)]
        j = j[np.bitwise_count(fps[j] ^ fps[i]) <= limit]
        if len(j):
            return i, j[0]
    return None


def _bucket_links(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = references()
        held = [np.empty(0, np.int64)] * 3

        def links(combo, key, fp) -> pa.RecordBatch | None:
            new = np.flatnonzero((combo[1:] != combo[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], new]).astype(np.int64)
            sizes = np.diff(np.concatenate([starts, [len(fp)]]))
            fps, bucket = fp.view(np.uint64), np.repeat(np.arange(len(starts)), sizes)
            in_small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
            out = small_links(fps[in_small], bucket[in_small], refs, limit) if in_small.any() else []
            for k in np.flatnonzero(sizes > SMALL):
                out += large_links(fps[starts[k] : starts[k] + sizes[k]], refs, limit)
            pairs = np.concatenate(out) if out else np.empty((0, 2), np.uint64)
            pairs = np.unique(np.sort(pairs.view(np.int64), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            mine = [np.concatenate([h, batch.column(n).to_numpy(zero_copy_only=False)]) for n, h in enumerate(held)]
            last = (mine[0] == mine[0][-1:]) & (mine[1] == mine[1][-1:]) if len(mine[0]) else np.empty(0, bool)
            cut = int(len(last) - last[::-1].argmin()) if len(last) and not last.all() else 0
            held = [m[cut:] for m in mine]
            if cut:
                yield links(*[m[:cut] for m in mine])
        if len(held[0]):
            yield links(*held)

    return run


def _bucket_keys(blocks: int, equal: int) -> Column:
    """The fingerprint's bits in each choice of so many blocks."""
    edges = [round(64 * n / blocks) for n in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    keys = []
    for n, chosen in enumerate(combinations(masks, equal)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).alias("combo"), F.col("fp").bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def links(fps: DataFrame, limit: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that connect all those within so many bits of each other.

    With d differing bits, at least ``blocks - d`` blocks are equal; the buckets are all choices of so many.
    """
    if blocks <= limit:
        raise ValueError("there must be more blocks than differing bits")
    keyed = fps.select("fp", F.inline(_bucket_keys(blocks, blocks - limit))).select("combo", "key", "fp")
    dealt = keyed.repartition("combo", "key").sortWithinPartitions("combo", "key", "fp")
    return dealt.mapInArrow(_bucket_links(limit), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, limit: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_key, fp, fingerprint, component_id, first_key`` for every row of ``doc_id, text``.

    ``component_id`` is the smallest id reachable over links, ``first_key`` the least text key of that id.
    """
    read = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(read.groupBy("fp").agg(F.min(F.struct("doc_id", "text_key")).alias("none_first"),
                                          F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))).alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), limit))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "none_first").alias("least"))
    # Rows without an id come after all others.
    order = F.struct(F.col("least.doc_id").isNull().alias("none"), F.col("least").alias("least"))
    firsts = rooted.groupBy("root").agg(F.min(order).alias("first"))
    labels = rooted.join(firsts.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root")).select(
        F.col("fp").alias("_fp"),
        F.col("first.least.doc_id").alias("component_id"),
        F.col("first.least.text_key").alias("first_key"),
    )
    found = read.join(labels, F.col("fp") == F.col("_fp"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", "text_key", "fp", hexed.alias("fingerprint"), "component_id", "first_key")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, limit: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one of each component: the one with the smallest id, then text key."""
    found = stored(near_duplicates(docs, shingle, limit), "near-duplicates")
    one, two = unused(docs, "_id", "_key")
    firsts = found.select(F.col("component_id").alias(one), F.col("first_key").alias(two)).distinct()
    own = [F.col("doc_id").cast("long"), F.when(F.col("text").isNotNull(), F.xxhash64("text"))]
    kept = docs.join(firsts, own[0].eqNullSafe(F.col(one)) & own[1].eqNullSafe(F.col(two)), "left_semi")
    repeated = found.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key")
    return one_of_each(kept, own, repeated)
