"""Trie of conversation prefixes by ROLLUP over columns of turn ids.

Turns get ids (md5 of role and text), and their places in the conversation by (turn, role, turn id), nulls first. A conversation is
cut into blocks of ``WIDTH`` turns, one row each: its turn ids as columns, and as its key the node where the block before
ended. ``GROUP BY block, node, ROLLUP(t1, ..., t8)`` with ``grouping_id`` then aggregates all prefixes of all blocks together, and a
long conversation merely has more rows. A node where a block ends is named by the exclusive or of two 64-bit hashes of (place,
turn id) over all its turns, which is a running sum, so blocks need not wait for each other.

A node's smallest member and its depth name it in the result: of a conversation's nodes, the deepest ones, from
some depth on, are those whose smallest member it is. What these hold, summed over the conversation, therefore counts once
for each node above, and a second ROLLUP of the same rows sums it there; the nodes of one smallest member are summed along it.

A conversation with many turns is spread: rows are range-partitioned by conversation and place, counted by
partition, and running sums go by stretches of ``STRETCH`` blocks or nodes. A node with many children or members is counted in partial
sums, and joins on one are left to AQE's skew join. The ids of members that end at one node are made text in slices of up to ``SLICE``,
so the one task that must read such a text in order reads slices and holds one.

Rows without a ``conv_id`` take no part; null roles and texts are empty. Turns with equal numbers are ordered by role and turn id;
repeated rows are turns each. Other columns are not read. A table without conversations gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.llm.base import stored

WIDTH = 8
STRETCH = 4096
SLICE = 65_536


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, turn_id, chars, n_turns``: places from 1, in the order of the turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("_turn"),
        role.alias("_role"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("turn_id"),
        F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["conv_id", "_turn", "_role", "turn_id", "_row"]
    sorted_ = named.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    kept = stored(sorted_.select("conv_id", "turn_id", "chars", F.spark_partition_id().alias("part"), row.alias("row")), "turns")
    # A conversation's rows follow each other in a partition.
    sizes = kept.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    whole = Window.partitionBy("conv_id").orderBy("part")
    before = F.coalesce(F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = F.sum("n").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = sizes.select("conv_id", "part", (before - F.col("first") + 1).alias("shift"), every.alias("n_turns"))
    placed = kept.join(starts, ["conv_id", "part"])
    return stored(placed.select("conv_id", (F.col("row") + F.col("shift")).alias("place"), "turn_id", "chars", "n_turns"), "places")


def whole(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are, in the form of ``rebuilt``."""
    return placed, placed.where("place = 1").select("conv_id", "n_turns")


def rebuilt(placed: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``heads`` turns of another, ``base``, and go on with their own after as many.

    Both are expressions of ``conv_id``; ``heads`` is at most ``most``. Returns turns like those given, and every
    conversation's ``conv_id, n_turns``.
    """
    every = placed.where("place = 1").select("conv_id", "n_turns", base.cast("long").alias("base"), heads.alias("heads"))
    first = F.sort_array(F.collect_list(F.struct("place", "turn_id", "chars")))
    begun = placed.where(F.col("place") <= most).groupBy(F.col("conv_id").alias("base")).agg(first.alias("first"))
    none = F.array().cast(begun.schema["first"].dataType)
    head = F.slice(F.coalesce("first", none), 1, F.col("heads")).alias("first")
    joined = every.join(begun, "base", "left").select("conv_id", "heads", "n_turns", head)
    rest = F.greatest(F.col("n_turns") - F.col("heads"), F.lit(0))
    joined = stored(joined.withColumn("n_turns", F.size("first") + rest), "heads")
    head_turns = joined.select("conv_id", "n_turns", F.inline("first"))
    shifts = joined.select("conv_id", "n_turns", "heads", F.size("first").alias("_m"))
    own = placed.drop("n_turns").join(shifts, "conv_id").where("place > heads")
    moved = own.select("conv_id", (F.col("place") - F.col("heads") + F.col("_m")).alias("place"), "turn_id", "chars", "n_turns")
    return moved.unionByName(head_turns), joined.select("conv_id", "n_turns")


def _stretches(df: DataFrame, unit: str) -> DataFrame:
    """Rows dealt by conversation and stretch of ``STRETCH`` units."""
    return df.withColumn("stretch", F.expr(f"{unit} div {STRETCH}")).repartition("conv_id", "stretch")


def _of_long_ones(df: DataFrame) -> DataFrame | None:
    """The rows of conversations of more than one stretch, if there are any."""
    long = df.where("stretch > 0").select("conv_id").distinct()
    return None if long.isEmpty() else df.join(long, "conv_id", "left_semi")


def blocks(conversation_turns: DataFrame, conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each ``width`` turns, and one for a conversation without turns.

    ``conv_id, block, last, n, t1.., h1.., g1.., c1.., node_h, node_g``: ``last`` is whether the conversation ends in it, n its turns, h and
    g name the node after each turn, c are the code points, ``node_`` the node before the block.
    """
    place = F.col("place").cast("long")
    cells = conversation_turns.select(
        "conv_id",
        F.expr(f"cast((place - 1) div {width} as long)").alias("block"),
        ((place - 1) % width).cast("int").alias("at"),
        "turn_id",
        "chars",
        F.xxhash64(F.lit(1), place, "turn_id").alias("h"),
        F.xxhash64(F.lit(2), place, "turn_id").alias("g"),
        F.expr(f"(n_turns - 1) div {width}").alias("end"),
    )
    at = lambda n, c: F.max(F.when(F.col("at") == n, F.col(c)))
    wide = _stretches(cells, "block").groupBy("conv_id", "stretch", "block").agg(
        F.count(F.lit(1)).alias("n"),
        (F.max("end") == F.col("block")).alias("last"),
        F.bit_xor("h").alias("all_h"),
        F.bit_xor("g").alias("all_g"),
        *[at(n, c).alias(f"{new}{n + 1}") for n in range(width) for c, new in (("turn_id", "t"), ("h", "h"), ("g", "g"), ("chars", "c"))],
    )
    inside = Window.partitionBy("conv_id", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    run = {f"node_{c}": F.coalesce(F.bit_xor(f"all_{c}").over(inside), F.lit(0)) for c in "hg"}
    keyed = stored(wide.withColumns(run), "turn-blocks")
    long = _of_long_ones(keyed)
    if long is not None:
        totals = long.groupBy("conv_id", "stretch").agg(*[F.bit_xor(f"all_{c}").alias(f"_{c}") for c in "hg"])
        before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        bases = totals.select("conv_id", "stretch", *[F.coalesce(F.bit_xor(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in "hg"])
        keyed = keyed.join(bases, ["conv_id", "stretch"], "left")
        keyed = keyed.withColumns({f"node_{c}": F.col(f"node_{c}").bitwiseXOR(F.coalesce(f"_{c}", F.lit(0))) for c in "hg"})
    names = {f"{c}{n}": _xor([F.col(f"node_{c}"), *[F.col(f"{c}{k}") for k in range(1, n + 1)]]) for c in "hg" for n in range(1, width + 1)}
    kept = ["conv_id", "block", "last", "n", *[f"{c}{n}" for c in "thgc" for n in range(1, width + 1)], "node_h", "node_g"]
    after = keyed.withColumns(names).select(kept)
    kinds = dict(after.dtypes)
    of_empty = {"conv_id": F.col("conv_id"), "last": F.lit(True), **{c: F.lit(0) for c in ("block", "n", "node_h", "node_g")}}
    rows = conversations.where("n_turns = 0").select(*[of_empty.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in kept])
    return stored(after.unionByName(rows), "prefix-blocks")


def _xor(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out.bitwiseXOR(c)
    return out


def _rolled(rows: DataFrame, width: int, measures: dict[str, str]) -> DataFrame:
    """``depth, h, g, parent_h, parent_g, chars`` and the measures of every node, by one ROLLUP over all blocks.

    Of a group of depth n in its block all rows agree in the first n turns, so the greatest name after the n-th turn is the node's.
    """
    columns = ", ".join(f"t{n}" for n in range(1, width + 1))
    names = [f"max({c}{n}) AS {c}{n}" for c in "hgc" for n in range(1, width + 1)]
    names += [f"{expression} AS {name}" for name, expression in measures.items()]
    grouped = rows.sparkSession.sql(
        f"SELECT block, node_h, node_g, {columns}, {width} - bit_count(grouping_id()) AS level, "
        f"{', '.join(names)} FROM {{rows}} GROUP BY block, node_h, node_g, ROLLUP({columns})",
        rows=rows,
    )
    # A level whose own turn is missing repeats the one above; level 0 of a later block is the node that ended the one before.
    own = " OR ".join([f"(level = 0 AND block = 0)", *[f"(level = {n} AND t{n} IS NOT NULL)" for n in range(1, width + 1)]])
    level = F.col("level").cast("int")

    def node(c: str, up: int) -> Column:
        """Of the node ``up`` levels above."""
        after = [F.col(f"node_{c}"), *[F.col(f"{c}{n}") for n in range(1, width + 1)]]
        return F.try_element_at(F.array(*after), F.nullif(F.greatest(level + 1 - up, F.lit(0)), F.lit(0)))

    return grouped.where(own).select(
        (F.col("block") * width + F.col("level")).cast("long").alias("depth"),
        *[node(c, 0).alias(c) for c in "hg"],
        *[node(c, 1).alias(f"parent_{c}") for c in "hg"],
        F.coalesce(F.try_element_at(F.array(*[F.col(f"c{n}") for n in range(1, width + 1)]), F.nullif(level, F.lit(0))), F.lit(0)).alias("chars"),
        *measures,
    )


def _suffix_sums(nodes: DataFrame, amounts: list[str]) -> DataFrame:
    """Adds ``below_`` and ``all_`` of each amount: sums along a conversation's nodes from each on, and over all; ``first``: their least depth."""
    part = Window.partitionBy("conv_id", "stretch")
    inside = part.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    added = {f"below_{a}": F.sum(a).over(inside) for a in amounts} | {f"all_{a}": F.sum(a).over(part) for a in amounts}
    summed = stored(_stretches(nodes, "depth").withColumns(added | {"first": F.min("depth").over(part)}), "prefix-sums")
    long = _of_long_ones(summed)
    if long is None:
        return summed.drop("stretch")
    totals = long.groupBy("conv_id", "stretch").agg(*[F.sum(a).alias(f"_{a}") for a in amounts], F.min("depth").alias("_first"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv_id")
    bases = totals.select(
        "conv_id",
        "stretch",
        *[F.coalesce(F.sum(f"_{a}").over(after), F.lit(0)).alias(f"_after_{a}") for a in amounts],
        *[F.sum(f"_{a}").over(every).alias(f"_all_{a}") for a in amounts],
        F.min("_first").over(every).alias("_first"),
    )
    joined = summed.join(bases, ["conv_id", "stretch"], "left")
    moved = {f"below_{a}": F.col(f"below_{a}") + F.coalesce(f"_after_{a}", F.lit(0)) for a in amounts}
    moved |= {f"all_{a}": F.coalesce(f"_all_{a}", f"all_{a}") for a in amounts} | {"first": F.coalesce("_first", "first")}
    return joined.withColumns(moved).select(nodes.columns + [*moved])


def _ends(ended: DataFrame, node: list[str]) -> DataFrame:
    """``ends_sha256`` of the conversations that end at each node, in the order of their ids."""
    ordered = ended.repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id").select(*node, "conv_id")
    keys = ", ".join(f"{c} long" for c in node)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of one node that follow each other, as text, at most ``SLICE`` at a time."""
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            columns = [c.to_numpy() for c in batch.columns]
            change = np.any([np.diff(c) != 0 for c in columns[:-1]], axis=0)
            bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            ids = columns[-1].astype(str)
            texts = [",".join(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
            order = pa.array(np.arange(number, number + len(texts)))
            number += len(texts)
            first = pa.array(bounds[:-1])
            yield pa.RecordBatch.from_arrays([*(c.take(first) for c in batch.columns[:-1]), order, pa.array(texts)], [*node, "number", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        kinds = [pa.int64()] * len(node) + [pa.string()]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*node, "ends_sha256"])

        for batch in batches:
            done: list[tuple] = []
            for *own, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if own == last:
                    digest.update(b",")
                else:
                    if last is not None:
                        done.append((*last, digest.hexdigest()))
                    last, digest = own, hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield made(done)
        if last is not None:
            yield made([(*last, digest.hexdigest())])

    texts = ordered.mapInArrow(joined, f"{keys}, number long, ids string")
    return texts.repartition(*node).sortWithinPartitions(*node, "number").mapInArrow(digested, f"{keys}, ends_sha256 string")


def trie(conversation_turns: DataFrame, conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``conversation_turns`` has ``conv_id, place, turn_id, chars, n_turns``, with places from 1 without gaps, and ``conversations``
    every ``conv_id`` once, with its ``n_turns``. ``saved_tokens`` counts code points that all but one member of each node below share.
    """
    rows = blocks(conversation_turns, conversations, width)
    node = ["depth", "h", "g"]
    found = stored(_rolled(rows, width, {"n_convs": "count(*)", "conv_id": "min(conv_id)"}), "prefix-nodes")
    children = found.where("parent_h IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_h").alias("h"), F.col("parent_g").alias("g"))
    counted = found.join(children.agg(F.count(F.lit(1)).alias("n_children")), node, "left").fillna(0, ["n_children"])
    weighed = counted.withColumns(
        {"saved": (F.col("n_convs") - 1) * F.col("chars"), "leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")}
    )
    weighed = _suffix_sums(weighed, ["saved", "leaves"])

    # What the nodes of each smallest member hold, once for every node above: the second ROLLUP.
    held = weighed.where("depth = first").select("conv_id", F.col("all_saved").alias("held_saved"), F.col("all_leaves").alias("held_leaves"))
    with_held = rows.join(held, "conv_id", "left")
    sums = _rolled(with_held, width, {f"sum_{a}": f"sum(coalesce(held_{a}, 0))" for a in ("saved", "leaves")})
    below = weighed.join(sums.select(*node, "sum_saved", "sum_leaves"), node)
    for a in ("saved", "leaves"):
        below = below.withColumn(a, F.col(f"below_{a}") + F.col(f"sum_{a}") - F.col(f"all_{a}"))

    # A parent has the same smallest member but at a conversation's first own node.
    branches = weighed.where("depth = first AND depth > 0").select(*node, "parent_h", "parent_g")
    parents = found.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("h").alias("parent_h"),
        F.col("g").alias("parent_g"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    of_first = branches.join(parents, ["depth", "parent_h", "parent_g"])
    named = below.join(of_first.select(*node, "parent_conv_id"), node, "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))

    last = rows.where("last")
    after = lambda c: F.array(F.col(f"node_{c}"), *[F.col(f"{c}{n}") for n in range(1, width + 1)])
    pick = lambda c: F.element_at(after(c), F.col("n").cast("int") + 1).alias(c)
    ended = last.select((F.col("block") * width + F.col("n")).cast("long").alias("depth"), pick("h"), pick("g"), "conv_id")
    nothing = F.lit(hashlib.sha256().hexdigest())
    result = named.join(_ends(ended, node), node, "left")
    return result.select(
        "conv_id",
        "depth",
        parent.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
