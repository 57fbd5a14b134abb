"""Mixing sources to target weights.

Each source's words stand in one sequence, documents in the order of a hash cell and id, cut into blocks of fixed length (the
last may be short). Source counts per output shard are drawn from a multinomial distribution over what each source has
still to give, never more than that, so all shards together hold each source's target. The k-th slot of a source maps
to a block through a pseudorandom permutation of the source's block numbers, a new one for each pass over them (the short
block ends a pass), and slots are joined to blocks by source and number. The last slot of a source is cut where the
target is met, so a source is short of its target by less than a word.

Sources are ordered by code point, null last, and weigh 3, 1, 2, repeating. The mix has 150 % of all words; a target ends
at twice its source's words, what is over is shared among the others by weight. One row per source and its
counts per shard pass the driver, as the mix's configuration does.

A word is a run of other characters than ASCII white space. Null and empty texts have none and are never taken. All
randomness comes from ``SEED``. Repeated rows have places of their own; rows without an id come first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.base import count_words, in_slices, running_positions, stored, one_of_each, unused
from mixloom.llm.words import mixed

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 512
SHARDS = 64
SEED = 20_240_607
#: Slots that one row of the plan stands for at most; such rows are what tasks are made of.
RUN = 1 << 14
#: Slots that a task makes, about.
TASK = 1 << 18


def targets(sizes: list[int], share: float = SHARE, most: float = MOST, weights=WEIGHTS) -> list[float]:
    """Words to take from each source, in the order of the sources."""
    weight = [weights[n % len(weights)] for n in range(len(sizes))]
    out, left, open_ = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if unit * weight[n] > most * sizes[n]}
        if not over:
            for n in open_:
                out[n] = unit * weight[n]
            break
        for n in over:
            out[n] = float(most * sizes[n])
            left -= out[n]
        open_ -= over
    return out


def draw_counts(slots: list[int], shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Slots of each source in each shard: multinomial draws by what is left, which together use all slots."""
    rng, left = np.random.default_rng(seed), np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for shard in range(shards):
        want = int(-(-left.sum() // (shards - shard)))
        while want:
            drawn = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[shard] += drawn
            left -= drawn
            want -= int(drawn.sum())
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Where ``index`` goes in the permutation of 0 to n - 1 that ``key`` names: a Feistel network over the next power
    of four, walked until it is below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], low[todo], key[todo].astype(np.uint64)
        left, right = x >> h, x & m
        with np.errstate(over="ignore"):
            for turn in range(4):
                f = mixed(right + (k << np.uint64(3)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 8 + turn))
                left, right = right, (left ^ f) & m
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def source_table(sized: DataFrame) -> list[tuple[str | None, int, float]]:
    """Source, words and target, in order."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(((r["source"], r["size"]) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))
    return [(s, n, t) for (s, n), t in zip(rows, targets([n for _, n in rows]))]


def slots(spark, sources: list[tuple[str | None, int, float]], block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``shard, rank, slot, block, pass, words``: the mix; ``rank`` numbers the sources from 0."""
    words = [round(t) for _, _, t in sources]
    whole = [(w // n, w % n) if n else (0, 0) for w, (_, n, _) in zip(words, sources)]
    blocks = [-(-n // block) for _, n, _ in sources]
    number = [q * b + -(-r // block) for (q, r), b in zip(whole, blocks)]
    counts = draw_counts(number, shards, seed)
    first = np.cumsum(counts, axis=0) - counts
    plan = [
        (shard, rank, int(first[shard, rank]), int(counts[shard, rank]), blocks[rank], sources[rank][1], words[rank])
        for shard in range(shards)
        for rank in range(len(sources))
        if counts[shard, rank]
    ]
    kind = "shard int, rank int, first long, n long, blocks long, size long, target long"
    runs = spark.createDataFrame(plan, kind).withColumn(
        "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long")))
    )
    runs = runs.withColumns({"first": F.col("first") + F.col("at"), "n": F.least(F.col("n") - F.col("at"), F.lit(RUN))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, rank, start, n, n_blocks, size, target in zip(*[batch.column(k).to_pylist() for k in range(7)]):
                slot = np.arange(start, start + n)
                turn, k = slot // n_blocks, slot % n_blocks
                full = size // block
                key = turn * len(sources) + rank
                inside = k < full
                at = np.full(n, full)
                at[inside] = permuted(k[inside], np.full(inside.sum(), full), key[inside], seed)
                length = np.where(inside, block, size % block)
                length = np.minimum(length, target - turn * size - k * block)
                same = [pa.array(np.full(n, v, np.int32)) for v in (shard, rank)]
                rest = [pa.array(v.astype(np.int64)) for v in (slot, at, turn, length)]
                yield pa.RecordBatch.from_arrays([*same, *rest], ["shard", "rank", "slot", "block", "pass", "words"])

    # The rows are few and small, so their number of tasks follows from the slots that they stand for.
    tasks = max(1, -(-int(counts.sum()) // TASK))
    dealt = runs.repartition(tasks, "shard", "rank", "at").select("shard", "rank", "first", "n", "blocks", "size", "target")
    return dealt.mapInArrow(run, "shard int, rank int, slot long, block long, pass long, words long")


def _placed(sized: DataFrame, sources: list[tuple[str | None, int, float]]) -> DataFrame:
    """Adds ``rank``, ``source_size``, ``target`` and ``start``, the place of the first word in its source."""
    of = [
        F.struct(F.lit(n).alias("rank"), F.lit(s).cast("string").alias("_source"), F.lit(z).alias("source_size"), F.lit(t).alias("target"))
        for n, (s, z, t) in enumerate(sources)
    ]
    table = sized.sparkSession.range(1).select(F.inline(F.array(*of)))
    ranked = sized.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return running_positions(ranked, "rank", ["doc_id", "key"], F.col("size"), "start")


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """A row for each block that a document reaches into: ``block, from_word, n, offset``."""
    last = F.col("start") + F.col("size") - 1
    reached = F.sequence(F.floor(F.col("start") / block), F.floor(last / block))
    pieces = placed.where("size > 0").withColumn("block", F.explode(reached))
    begin = F.greatest("start", F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return pieces.withColumns(
        {"from_word": begin - F.col("start"), "n": end - begin, "offset": begin - F.col("block") * block}
    )


def _identity() -> Column:
    """Rows with one value have equal id, source and text."""
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":")]
    source = F.col("source").cast("string")
    parts += [F.coalesce(F.length(source).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(source, F.lit(""))]
    return F.sha2(F.concat(*parts, F.coalesce("text", F.lit(""))), 256)


def _sized(docs: DataFrame) -> DataFrame:
    return stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            count_words().alias("size"),
            _identity().alias("key"),
        ),
        "sized",
    )


def _taken(placed: DataFrame, sources, block: int, shards: int, seed: int) -> DataFrame:
    """Pieces with the slots that hold them: ``shard, slot, pass`` and the words ``n`` that are taken of each."""
    mix = slots(placed.sparkSession, sources, block, shards, seed)
    mix = mix.withColumnsRenamed({"rank": "_rank", "block": "_block"})
    same = (F.col("rank") == F.col("_rank")) & (F.col("block") == F.col("_block"))
    # Nothing tells Spark how many slots a run stands for, so its estimate must not decide on a broadcast.
    held = _pieces(placed, block).join(mix.hint("merge"), same).drop("_rank", "_block")
    n = F.greatest(F.lit(0), F.least(F.col("n"), F.col("words") - F.col("offset")))
    return held.withColumn("n", n).where("n > 0")


def mix(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix itself: ``shard, source, slot, block, pass, place, doc_id, from_word, n``.

    Slots of a shard are read in the order of ``place``, a hash of source and slot, pieces of a slot by ``offset``.
    """
    sized = _sized(docs)
    sources = source_table(sized)
    held = _taken(_placed(sized, sources), sources, block, shards, seed)
    place = F.xxhash64(F.lit(seed), "rank", "slot").alias("place")
    return held.select("shard", "source", "slot", "block", "pass", place, "offset", "doc_id", "from_word", "n")


def mixed_words(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``doc_id, text, source``."""
    sized = _sized(docs)
    sources = source_table(sized)
    if not sources:
        return sized.selectExpr("doc_id", "size", "size AS source_size", "double(0) AS target", "size AS taken")
    placed = stored(_placed(sized, sources), "placed")
    held = _taken(placed, sources, block, shards, seed).groupBy("rank", "start").agg(F.sum("n").alias("taken"))
    held = held.select(F.col("rank").alias("_rank"), F.col("start").alias("_start"), "taken")
    # Documents without words share their place with the next one.
    same = (F.col("rank") == F.col("_rank")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
    found = placed.join(held, same, "left")
    taken = F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    return found.select("doc_id", "size", "source_size", "target", taken)


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The words of the spans, with the white space between them as it was."""
    words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return " ".join(text[words[a][0] : words[a + n - 1][1]] for a, n in spans)


def mixed_documents(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix has them, in the same columns: a row for each pass that takes words of a document.

    Its text has the words that the pass takes, all of it unchanged where that is the whole document; a long
    column ``n_chars`` is counted anew. Rows with equal id, text and source count once: one of them is taken.
    """
    sized = _sized(docs).groupBy("key", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    sized = stored(sized, "different")
    sources = source_table(sized)
    if not sources:
        return docs
    held = _taken(stored(_placed(sized, sources), "placed"), sources, block, shards, seed)
    spans = held.groupBy("key", "pass", "size").agg(
        F.sort_array(F.collect_list(F.struct(F.col("from_word").alias("at"), F.col("n")))).alias("spans")
    )
    once = one_of_each(docs, [_identity()], sized.where("copies > 1").select("key"))
    mine, key, take = unused(docs, "_mine", "_key", "_take")
    spans = spans.select(F.col("key").alias(key), F.struct("size", "spans").alias(take))
    once = once.withColumn(mine, _identity()).join(spans, F.col(mine) == F.col(key)).drop(mine, key)
    names = docs.columns
    field = names.index("text")
    length = names.index("n_chars") if dict(docs.dtypes).get("n_chars") == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, field):
            columns = list(batch.columns)
            texts = []
            for text, take in zip(columns[field].to_pylist(), columns.pop().to_pylist()):
                taken = [(s["at"], s["n"]) for s in take["spans"]]
                texts.append(text if sum(n for _, n in taken) == take["size"] else _cut(text, _merged(taken)))
            if length is not None:
                whole = [old if new == was else len(new) for old, new, was in zip(columns[length].to_pylist(), texts, columns[field].to_pylist())]
                columns[length] = pa.array(whole, pa.int64())
            columns[field] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return once.mapInArrow(run, docs.schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for at, n in spans:
        if out and sum(out[-1]) == at:
            out[-1] = (out[-1][0], out[-1][1] + n)
        else:
            out.append((at, n))
    return out
