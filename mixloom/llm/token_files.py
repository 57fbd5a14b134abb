"""Token ids in binary files: fixed-size blocks, bit-plane shuffled, each plane compressed with zstandard.

Documents are range-partitioned and sorted by id, encoded, each followed by the end id, and their ids are cut into blocks
of ``BLOCK`` (a partition's last may be shorter). A block's ids are transposed into bit planes, as many as its
greatest id has bits, and each plane is a zstandard frame. Blocks are written as rows of Parquet under
``<path>/blocks``, so that any store Spark writes to will do and a lost task leaves nothing behind, with the documents that reach
into them; the index under ``<path>/index`` has the first id's global place of every block.

Ids ascend over partitions and within them; rows without one come first, rows with equal ids are ordered by a hash of the text, then by the text, and spread over partitions.
A null text is empty, so it has the end id alone. Without documents there are no blocks.

Block: ``MXBP``, version 1, number of planes (a byte each), number of ids, length of each plane (4 bytes each,
little-endian), then the planes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mixloom.llm.base import in_slices
from mixloom.llm.tokens import worker_encoder

BLOCK = 1 << 16
END = 2
MAGIC = b"MXBP"
LEVEL = 3


def pack(ids: np.ndarray) -> bytes:
    import zstandard

    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    frames = [compress(np.packbits(((ids >> np.uint32(p)) & np.uint32(1)).astype(np.uint8)).tobytes()) for p in range(planes)]
    head = MAGIC + struct.pack("<BBI", 1, planes, len(ids)) + struct.pack(f"<{planes}I", *map(len, frames))
    return head + b"".join(frames)


def unpack(block: bytes) -> np.ndarray:
    import zstandard

    if block[:4] != MAGIC or block[4] != 1:
        raise ValueError("not a block of token ids")
    _, planes, n = struct.unpack_from("<BBI", block, 4)
    lengths = struct.unpack_from(f"<{planes}I", block, 10)
    at, ids = 10 + 4 * planes, np.zeros(n, np.uint32)
    decompress = zstandard.ZstdDecompressor().decompress
    for p, length in enumerate(lengths):
        bits = np.unpackbits(np.frombuffer(decompress(block[at : at + length]), np.uint8), count=n)
        ids |= bits.astype(np.uint32) << np.uint32(p)
        at += length
    return ids


DOC = "struct<doc_id:bigint,number:bigint,start:bigint,n:bigint>"
BLOCKS = f"part int, block int, first long, n_ids int, docs array<{DOC}>, payload binary"


def write(docs: DataFrame, path: str, definition: str, kind: str = "words", end: int = END, block: int = BLOCK) -> None:
    """Writes ``doc_id, text``; ``definition`` is the tokenizer's JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_encoder(definition, kind)
        part, number, held, count, first, total, open_ = TaskContext.get().partitionId(), 0, [], 0, 0, 0, []
        doc = pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "number", "start", "n")]))

        def cut(ids: np.ndarray, at: int) -> pa.RecordBatch:
            inside = [d for d in open_ if d["start"] < at + len(ids)]
            columns = [[part], [at // block], [at], [len(ids)], [inside], [pack(ids)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), doc, pa.binary())
            names = ["part", "block", "first", "n_ids", "docs", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in in_slices(batches, 1, 1 << 23):
            flat, lengths = encoder.encode_column(batch.column(1))
            held.append(np.insert(flat, np.cumsum(lengths), np.uint32(end)).astype(np.uint32))
            for doc_id, n in zip(batch.column(0).to_pylist(), (lengths + 1).tolist()):
                open_.append({"doc_id": doc_id, "number": number, "start": total, "n": n})
                number, total, count = number + 1, total + n, count + n
            if count >= block:
                ids = np.concatenate(held)
                for k in range(0, count - count % block, block):
                    yield cut(ids[k : k + block], first)
                    first += block
                    open_ = [d for d in open_ if d["start"] + d["n"] > first]
                held, count = [ids[count - count % block :]], count % block
        if count:
            yield cut(np.concatenate(held), first)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = plain.withColumn("_h", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")
    ordered.mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")
    blocks = docs.sparkSession.read.schema(BLOCKS).parquet(f"{path}/blocks").select("part", "block", "first", "n_ids", "docs")
    # One row per partition: those before it in the order of their first document hold the ids before its own.
    lead = F.min(F.struct(F.col("block"), F.col("docs")[0]["doc_id"].alias("id")))["id"].alias("lead")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"), lead)
    before = Window.orderBy(F.asc_nulls_first("lead"), "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    places = blocks.join(bases, "part").select("part", "block", (F.col("base") + F.col("first")).alias("first_id"), "n_ids")
    places.write.parquet(f"{path}/index")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with the global place of their first id; ``unpack`` gives a payload's ids."""
    index = spark.read.schema("part int, block int, first_id long, n_ids int").parquet(f"{path}/index")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return blocks.join(index.select("part", "block", "first_id"), ["part", "block"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    A document within one block is summed up where that is read; only pieces of others are brought together.
    """
    kind = "part int, number long, doc_id long, start long, n long, block int, crc long, piece binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, block, first, docs, payload in zip(*[batch.column(c).to_pylist() for c in ("part", "block", "first", "docs", "payload")]):
                ids = unpack(payload).astype("<u4")
                for d in docs:
                    at, to = d["start"] - first, d["start"] + d["n"] - first
                    data = ids[max(0, at) : to].tobytes()
                    whole = at >= 0 and to <= len(ids)
                    crc, piece = (zlib.crc32(data), None) if whole else (None, data)
                    rows.append((part, d["number"], d["doc_id"], d["start"], d["n"], block, crc, piece))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            names = ["part", "number", "doc_id", "start", "n", "block", "crc", "piece"]
            columns = list(zip(*rows)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    index = spark.read.schema("part int, block int, first_id long, n_ids int").parquet(f"{path}/index")
    found = blocks.mapInArrow(run, kind)
    # Both kinds of rows come from one reading: the key of a whole document is its own.
    piece = F.when(F.col("piece").isNotNull(), F.struct("block", "piece"))
    joined = found.groupBy("part", "number", "doc_id", "start", "n").agg(
        F.max("crc").alias("crc"), F.sort_array(F.collect_list(piece)).alias("pieces")
    )
    data = F.aggregate("pieces", F.lit(b""), lambda all_, p: F.concat(all_, p["piece"]))
    bases = index.where("block = 0").select("part", F.col("first_id").alias("base"))
    return joined.join(bases, "part").select(
        "doc_id",
        (F.col("base") + F.col("start")).alias("start"),
        F.col("n").alias("n_tokens"),
        F.coalesce("crc", F.crc32(data)).alias("ids_crc32"),
    )
