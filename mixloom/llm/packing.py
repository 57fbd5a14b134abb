"""Packing of whole corpora into sequences of fixed capacity by best-two-fit.

Documents are encoded, each followed by the end id, and only longer ones than ``capacity`` are cut: into full pieces, after a first
one that may be shorter. Sequences are filled one after the other: greedily, with the longest piece left that fits; then
the smallest piece of the sequence is replaced by the two unpacked ones that fit the gap without it most tightly, if they fill
more of it. Pieces of one length are alike in this, so the packing is planned on the number of pieces of each length, at most
``capacity`` rows whatever the corpus; a sequence's pattern is repeated as often as the pieces left would have every step
chosen alike. The plan gives, for each length, ranges of ranks; a piece's rank among those of its length is its place in
the task that encoded it, kept with its ids, after those of the tasks before. So no group is sorted or gathered, however
common its length.

A null text is empty: its document is the end id alone. Rows with equal or null ids, and repeated rows, are documents each. Of an empty
table no sequences come. Other columns than ``doc_id`` and ``text`` are not read. Very long texts are pieces like others.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.base import in_slices, stored
from mixloom.llm.tokens import worker_encoder

CAPACITY = 2048
END = 0
#: Bytes of text that are encoded at a time.
SLICE = 1 << 23
PLAN = "length int, from_rank long, to_rank long, copies long, place int, first_sequence long"


def best_two(lengths: np.ndarray, left: np.ndarray, room: int, least: int) -> tuple[int, int] | None:
    """The two of ``lengths`` (ascending, ``left`` of each) that fill most of ``room``, and more than ``least``; the longest first of equals."""
    partner = np.searchsorted(lengths, np.minimum(room - lengths, lengths), side="right") - 1
    own = np.arange(len(lengths))
    partner -= (partner == own) & (left < 2)
    total = np.where(partner >= 0, lengths + lengths[partner], 0)
    if not len(total) or total.max() <= least:
        return None
    one = len(total) - 1 - int(total[::-1].argmax())
    return int(lengths[one]), int(lengths[partner[one]])


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of ``PLAN``: which ranks of a length go to which sequences.

    The piece of rank ``r`` is in sequence ``first_sequence + (r - from_rank) // copies``, at
    ``place + (r - from_rank) % copies * length``.
    """
    left = {n: int(c) for n, c in counts.items() if c}
    lengths = sorted(left)
    if lengths and (lengths[0] < 1 or lengths[-1] > capacity):
        raise ValueError("pieces have from one to capacity tokens")
    used = dict.fromkeys(lengths, 0)
    rows, sequence = [], 0
    while lengths:
        gap, greedy = capacity, {}
        at = len(lengths)
        while at:
            at = bisect_right(lengths, gap, 0, at)
            if at:
                length = lengths[at - 1]
                greedy[length] = min(left[length], gap // length)
                gap -= greedy[length] * length
                at -= 1
        own, needed = dict(greedy), dict(greedy)
        smallest = min(greedy)
        if gap:
            rest = np.array([left[n] - greedy.get(n, 0) + (n == smallest) for n in lengths])
            some = rest > 0
            pair = best_two(np.array(lengths)[some], rest[some], gap + smallest, smallest)
            if pair:
                own[smallest] -= 1
                for n in pair:
                    own[n] = own.get(n, 0) + 1
                    needed[n] = needed.get(n, 0) + 1
        times = min((left[n] - needed[n]) // k + 1 if left[n] >= needed[n] else 1 for n, k in own.items() if k)
        place = 0
        for n, k in sorted(own.items(), reverse=True):
            if k:
                rows.append((n, used[n], used[n] + k * times, k, place, sequence))
                place += n * k
                used[n] += k * times
                left[n] -= k * times
        sequence += times
        lengths = [n for n in lengths if left[n]]
    return rows


def pieces(docs: DataFrame, definition: str, capacity: int = CAPACITY, kind: str = "bytes", end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids``, and where each was made: ``part``, and ``rank`` among the part's pieces of its length.

    ``ids`` are zstandard frames, see ``unpack_ids``: they are moved twice.
    """
    width = id_width(definition, end)
    schema = "doc_id long, piece int, start long, length int, part int, rank long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        compress = zstandard.ZstdCompressor(level=3).compress
        encoder, part, made = worker_encoder(definition, kind), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in in_slices(batches, 1, SLICE):
            flat, counts = encoder.encode_column(batch.column(1))
            flat = np.insert(flat, np.cumsum(counts), np.uint32(end)).astype(f"<u{width}")
            counts = counts + 1
            n = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            first = counts - (n - 1) * capacity
            length = np.where(piece == 0, first[doc], capacity)
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            order = np.argsort(length, kind="stable")
            alike = np.bincount(length, minlength=capacity + 1)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - (np.cumsum(alike) - alike)[length[order]] + made[length[order]]
            made += alike
            bounds = np.concatenate([[0], np.cumsum(length)]).tolist()
            ids = pa.array([compress(flat[a:b].data) for a, b in zip(bounds, bounds[1:])], pa.binary())
            columns = [
                batch.column(0).take(pa.array(doc)),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int32()),
                pa.array(np.full(len(length), part), pa.int32()),
                pa.array(rank),
                ids,
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "part", "rank", "ids"])

    plain = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    return plain.mapInArrow(run, schema)


def id_width(definition: str, end: int = END) -> int:
    """Bytes of an id: two where all ids fit into them, else four."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True) - 1, end) < 1 << 16 else 4


def unpack_ids(frame: bytes, width: int) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), f"<u{width}")


def pack(docs: DataFrame, definition: str, capacity: int = CAPACITY, kind: str = "bytes", end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset`` of every piece of ``doc_id, text``.

    Reaches the driver: the number of pieces of each length. The ranges of ranks are first joined to the pieces'
    numbers by part and length, which leaves the few ranges that a part's pieces of a length lie in.
    """
    made = stored(pieces(docs, definition, capacity, kind, end), "pieces")
    by_part = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    by_part = stored(by_part, "piece-counts")
    counts = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    rows = plan({r.length: r.n for r in counts}, capacity)
    ranges = docs.sparkSession.createDataFrame(rows, PLAN)
    before = "coalesce(sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    bases = by_part.select("length", "part", "n", F.expr(before).alias("base"))
    overlap = (F.col("from_rank") < F.col("base") + F.col("n")) & (F.col("to_rank") > F.col("base"))
    near = bases.join(ranges.withColumnRenamed("length", "of_length"), (F.col("length") == F.col("of_length")) & overlap).select(
        F.col("length").alias("of_length"),
        F.col("part").alias("of_part"),
        (F.col("from_rank") - F.col("base")).alias("from"),
        (F.col("to_rank") - F.col("base")).alias("to"),
        "copies",
        "place",
        "first_sequence",
    )
    inside = (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to"))
    same = (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part")) & inside
    step = F.col("rank") - F.col("from")
    return made.join(near, same).select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids",
        (F.col("first_sequence") + F.expr("(rank - from) div copies")).alias("sequence_id"),
        (F.col("place") + step % F.col("copies") * F.col("length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame, width: int, most: int = 1000) -> DataFrame:
    """``sequence_id, ids``, little-endian unsigned, and the ``pieces`` in it (doc_id, piece, start, length, offset, ids_crc32).

    One row per sequence: its pieces, whose number is bounded by the capacity, are brought together. Their checksums, of
    ids of four bytes, are taken from the built sequence at their offsets.
    """
    place = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    own = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(place)).alias("own"))
    names = ["offset", "doc_id", "piece", "start", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        for batch in (b.slice(at, most) for b in batches for at in range(0, b.num_rows, most)):
            lists = batch.column(1)
            rows, counts = lists.flatten(), lists.value_lengths().to_numpy()
            frames, bounds = rows.field("ids"), np.concatenate([[0], np.cumsum(counts)])
            ids, crcs = [], []
            offset, length = rows.field("offset").to_numpy(), rows.field("length").to_numpy()
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                built = b"".join([decompress(frames[n].as_buffer()) for n in range(a, b)])
                wide = np.frombuffer(built, f"<u{width}").astype("<u4")
                crcs += [zlib.crc32(wide[at : at + n]) for at, n in zip(offset[a:b].tolist(), length[a:b].tolist())]
                ids.append(built)
            inner = [*(rows.field(name) for name in names), pa.array(crcs, pa.int64())]
            pieces = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(inner, [*names, "ids_crc32"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pieces], ["sequence_id", "ids", "pieces"])

    kind = "array<struct<offset:long,doc_id:long,piece:int,start:long,length:long,ids_crc32:long>>"
    return own.mapInArrow(run, f"sequence_id long, ids binary, pieces {kind}")


def digest_pieces(built: DataFrame) -> DataFrame:
    """One row per piece of built sequences."""
    rows = built.select("sequence_id", F.inline("pieces"))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
