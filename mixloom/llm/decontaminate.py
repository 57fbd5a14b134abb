"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of ASCII letters and digits and of all that is not ASCII. Shingles of ``min_match`` words that
a document shares with a benchmark item are its seeds. A filter of fixed size, made of the benchmark's seeds, finds
documents that may have some, so only those are joined to the seeds; what it lets through by chance finds no partner.
Then, for each text and item whose seeds could cover enough, running Karp-Rabin matching marks
the longest common passage again and again, without overlaps, down to ``min_match`` words, in whatever order the passages
stand. A text is contaminated by an item if tiles cover at least ``coverage`` of the item's words.

Tiles are looked for where the seeds are, which loses none: each tile consists of seeds. Equal texts are tiled once.
A null or empty text, and an item with fewer than ``min_match`` words, match nothing. Items with the same id count apart
if their texts differ. Repeated rows of documents are reported once per id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.base import in_slices, stored, unused
from mixloom.llm.words import shingle_hashes, words_of

MIN_MATCH = 5
COVERAGE = 0.5
FILTER_BITS = 22
PRIME = (1 << 61) - 1
RADIX = 1_000_003


def greedy_tiles(item: list[str], text: list[str | None], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles as (start in the item, start in the text, words), longest first. None matches nothing."""
    numbers = {w: n for n, w in enumerate(dict.fromkeys(item), 1)}
    a = [numbers[w] for w in item]
    b = [numbers.get(w, 0) for w in text]
    free_a, free_b = [True] * len(a), [x > 0 for x in b]
    tiles: list[tuple[int, int, int]] = []
    length = max(min_match, min(len(a), len(b)))
    while min(len(a), len(b)) >= min_match:
        found = _matches(a, b, free_a, free_b, length)
        if found and found[0][0] > 2 * length:
            length = found[0][0]
            continue
        for size, i, j in found:
            if all(free_a[i : i + size]) and all(free_b[j : j + size]):
                free_a[i : i + size] = free_b[j : j + size] = [False] * size
                tiles.append((i, j, size))
        if length == min_match:
            # What a longer tile cut short may still hold tiles of the least length.
            if not any(all(free_a[i : i + length]) and all(free_b[j : j + length]) for _, i, j in _matches(a, b, free_a, free_b, length)):
                return tiles
        else:
            length = max(min_match, length // 2)
    return tiles


def _rolling(x: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """Start and hash of each run of so many free words."""
    top, value, run = pow(RADIX, length - 1, PRIME), 0, 0
    for k, word in enumerate(x):
        if not free[k]:
            value = run = 0
            continue
        if run >= length:
            value -= x[k - length] * top
        value = (value * RADIX + word) % PRIME
        run += 1
        if run >= length:
            yield k - length + 1, value


def _matches(a, b, free_a, free_b, length: int) -> list[tuple[int, int, int]]:
    """Greatest matches (words, start in a, start in b) of at least so many words, longest first."""
    places: dict[int, list[int]] = {}
    for i, value in _rolling(a, free_a, length):
        places.setdefault(value, []).append(i)
    found = set()
    for j, value in _rolling(b, free_b, length):
        for i in places.get(value, ()):
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue  # part of the match that begins earlier
            size = 0
            while i + size < len(a) and j + size < len(b) and free_a[i + size] and free_b[j + size]:
                if a[i + size] != b[j + size]:
                    break
                size += 1
            if size >= length:
                found.add((size, i, j))
    return sorted(found, key=lambda m: (-m[0], m[1], m[2]))


def _lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def _key(text: str | None) -> str:
    return hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).hexdigest()


def seeds_of(benchmark: DataFrame, min_match: int = MIN_MATCH) -> DataFrame:
    """``hash, item_id, item_key, n_words, words``: a row for each different seed of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                data = _lowered(text)
                starts, ends, hashes = words_of(data)
                key = _key(text)
                rows += [(h, item, key, len(starts)) for h in np.unique(shingle_hashes(hashes, min_match)).view(np.int64).tolist()]
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["hash", "item_id", "item_key", "n_words"]
            )

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(run, "hash long, item_id long, item_key string, n_words int")


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return hashes >> np.uint64(64 - bits), (hashes >> np.uint64(8)) & np.uint64((1 << bits) - 1)


def seed_filter(seeds: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """A Bloom filter of ``2 ** bits`` bits, whatever the size of the benchmark: at most that many positions arrive here."""
    first = F.shiftrightunsigned("hash", 64 - bits)
    second = F.shiftrightunsigned("hash", 8).bitwiseAND(F.lit((1 << bits) - 1))
    at = seeds.select(F.explode(F.array(first.cast("int"), second.cast("int"))).alias("at")).distinct()
    bitmap = np.zeros(1 << bits, bool)
    bitmap[[row[0] for row in at.collect()]] = True
    return np.packbits(bitmap).tobytes()


def _candidates(docs: DataFrame, bitmap: bytes, bits: int, min_match: int) -> DataFrame:
    """Rows that hold seeds, with the seeds and the words around them; a line break parts stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bitmap, np.uint8)

        def held(at: np.ndarray) -> np.ndarray:
            return (table[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0

        def rows(ids: list, texts: list[str | None]) -> Iterator[tuple]:
            lowered = [_lowered(t) for t in texts]
            starts, ends, hashes = words_of(b"\n".join(lowered))
            shingles = shingle_hashes(hashes, min_match)
            stops = np.cumsum([len(x) + 1 for x in lowered])
            doc = np.searchsorted(stops, starts, side="right")
            count = len(shingles)
            first, second = _positions(shingles, bits)
            hit = np.flatnonzero((doc[:count] == doc[min_match - 1 :][:count]) & held(first) & held(second))
            for d, own in zip(*_grouped(doc[hit], hit)):
                base = int(stops[d] - len(lowered[d]) - 1)
                stretches = []
                for part in np.split(own, np.flatnonzero(np.diff(own) >= min_match) + 1):
                    k = range(int(part[0]), int(part[-1]) + min_match)
                    stretches.append(" ".join(lowered[d][starts[w] - base : ends[w] - base].decode("utf-8", "replace") for w in k))
                yield ids[d], _key(texts[d]), np.unique(shingles[own]).view(np.int64).tolist(), "\n".join(stretches)

        for batch in in_slices(batches, 1):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(ids):
                to, size = at, 0
                while to < len(ids) and (to == at or size < 1 << 20):
                    size += len(texts[to] or "")
                    to += 1
                found = list(rows(ids[at:to], texts[at:to]))
                at = to
                if found:
                    kinds = (pa.int64(), pa.string(), pa.list_(pa.int64()), pa.string())
                    columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "seeds", "stretches"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, text_key string, seeds array<long>, stretches string")


def _grouped(keys: np.ndarray, values: np.ndarray):
    if not len(keys):
        return [], []
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.concatenate([[0], cuts])].tolist(), np.split(values, cuts)


def _tiled(pairs: DataFrame, min_match: int) -> DataFrame:
    """``text_key, item_id, item_words, covered, tiles`` of rows with ``stretches`` and the item's text."""
    kind = "struct<item_start:int,text_start:int,words:int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = pa.struct([("item_start", pa.int32()), ("text_start", pa.int32()), ("words", pa.int32())])
        for batch in batches:
            out = []
            for key, item, text, stretches in zip(*[batch.column(n).to_pylist() for n in range(4)]):
                data = _lowered(text)
                starts, ends, _ = words_of(data)
                words = [data[i:j].decode("utf-8", "replace") for i, j in zip(starts, ends)]
                around = [w for line in stretches.split("\n") for w in [*line.split(" "), None]]
                tiles = greedy_tiles(words, around, min_match)
                named = [dict(item_start=i, text_start=j, words=n) for i, j, n in tiles]
                out.append((key, item, len(words), sum(n for _, _, n in tiles), named))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.list_(tile))
            names = ["text_key", "item_id", "item_words", "covered", "tiles"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return pairs.mapInArrow(run, f"text_key string, item_id long, item_words int, covered int, tiles array<{kind}>")


def contaminated_texts(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE
) -> tuple[DataFrame, DataFrame]:
    """Contaminated texts by key, with the item and its tiles; and the rows that may hold seeds, by key."""
    seeds = stored(seeds_of(benchmark, min_match), "seeds")
    bitmap = seed_filter(seeds)
    rows = stored(_candidates(docs, bitmap, FILTER_BITS, min_match), "candidates")
    texts = rows.groupBy("text_key").agg(F.first("seeds").alias("seeds"), F.first("stretches").alias("stretches"))
    texts = stored(texts, "candidate-texts")
    shared = texts.select("text_key", F.explode("seeds").alias("hash")).join(seeds, "hash")
    counted = shared.groupBy("text_key", "item_id", "item_key").agg(
        F.count(F.lit(1)).alias("_seeds"), F.first("n_words").alias("n_words")
    )
    # A seed covers no more than its own words.
    enough = counted.where(F.col("_seeds") * min_match >= F.col("n_words") * F.lit(coverage))
    items = benchmark.select(
        F.col("item_id").cast("long").alias("_item"),
        F.col("text").cast("string").alias("item_text"),
    ).distinct()
    items = items.withColumn("_key", F.sha2(F.coalesce("item_text", F.lit("")), 256))
    pairs = enough.join(texts.select("text_key", "stretches"), "text_key").join(
        items, (F.col("item_key") == F.col("_key")) & F.col("item_id").eqNullSafe(F.col("_item"))
    )
    tiled = _tiled(pairs.select("text_key", "item_id", "item_text", "stretches"), min_match)
    share = F.col("covered") / F.col("item_words")
    return tiled.withColumn("coverage", share).where(F.col("coverage") >= coverage), rows


def contaminated(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE
) -> DataFrame:
    """``doc_id, item_id, item_words, covered, coverage, tiles``: a row for each contaminated document and item."""
    found, rows = contaminated_texts(docs, benchmark, min_match, coverage)
    ids = rows.select("doc_id", "text_key").distinct()
    best = F.max(F.struct("coverage", "covered", "item_words", "tiles")).alias("best")
    per_id = ids.join(found, "text_key").groupBy("doc_id", "item_id").agg(best)
    fields = [F.col(f"best.{c}").alias(c) for c in ("item_words", "covered", "coverage", "tiles")]
    return per_id.select("doc_id", "item_id", *fields)


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE
) -> DataFrame:
    """The rows of ``docs`` whose text no item contaminates."""
    found, _ = contaminated_texts(docs, benchmark, min_match, coverage)
    (key,) = unused(docs, "_text_key")
    texts = found.select(F.col("text_key").alias(key)).distinct()
    return docs.join(texts, F.sha2(F.coalesce("text", F.lit("")), 256) == F.col(key), "left_anti")
