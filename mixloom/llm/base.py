"""Helpers that the operators share: reliable tables, positions in a global order, column lists."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a new temporary one, for tests, only where that is unset on one machine.

    On a cluster an unset folder is an error: executors don't share local storage.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        own = spark.sparkContext.getCheckpointDir()
        if own is None:
            if spark.sparkContext.master.partition("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            own = tempfile.mkdtemp(prefix="mixloom-")
            spark.sparkContext.setCheckpointDir(own)
        folder = own
    return folder.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder: later reads survive lost executors and recompute nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of ``df`` has, in any letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def one_of_each(df: DataFrame, keys: list[Column], repeated: DataFrame) -> DataFrame:
    """``df`` with one row for each of the keys in ``repeated``, that several rows have; all other rows are kept as they are.

    Of rows with one key the one with the least hash stays. They are reduced before they are shuffled, and nothing is where
    no key is repeated.
    """
    if repeated.isEmpty():
        return df
    own = unused(df, *[f"_own{n}" for n in range(len(keys))], *[f"_of{n}" for n in range(len(keys))], "_row")
    own, of, row = own[: len(keys)], own[len(keys) : -1], own[-1]
    keyed, many = df.withColumns(dict(zip(own, keys))), repeated.toDF(*of)
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(own, of)]
    columns = [F.col(f"`{c}`") for c in df.columns]
    order = F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])
    again = keyed.join(many, same, "left_semi").groupBy(*own).agg(F.min_by(F.struct(*columns), order).alias(row))
    return keyed.join(many, same, "left_anti").select(*columns).unionByName(again.select(f"{row}.*"))


def in_slices(batches: Iterator[pa.RecordBatch], field: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices of some ``most`` bytes of the text in column ``field``, at least one row each.

    An Arrow batch may hold 10,000 long texts; of these only a slice at a time becomes Python strings.
    """
    for batch in batches:
        at, size = 0, 0
        for n, text in enumerate(batch.column(field)):
            size += text.as_buffer().size if text.is_valid else 0
            if size >= most:
                yield batch.slice(at, n + 1 - at)
                at, size = n + 1, 0
        if at < batch.num_rows:
            yield batch.slice(at)


def text_bytes(column: str = "text") -> Column:
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")


def count_words(column: str = "text") -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def running_positions(
    df: DataFrame, group: str, order: list[str], amount: Column, into: str, cells: int = 256
) -> DataFrame:
    """Adds ``into``: the sum of ``amount`` over the rows of the same group, which is never null, before this one.

    Groups are ordered by a hash cell of ``order`` first and by ``order`` within a cell, so that a group
    with a third of all rows is summed in many tasks. Only one total per group and cell is gathered; where
    those totals are too many to broadcast, their join uses the partitions that the sums within cells made.
    Rows that are equal in all of ``order`` change nothing if they change places.
    """
    cell = F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int")
    celled = df.withColumns({"_cell": cell, "_amount": amount.cast("long")})
    totals = celled.groupBy(group, "_cell").agg(F.sum("_amount").alias("_total"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")
    starts = totals.select(F.col(group).alias("_group"), F.col("_cell").alias("_in"), start)
    within = Window.partitionBy(group, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = celled.withColumn("_within", F.coalesce(F.sum("_amount").over(within), F.lit(0)))
    same = (F.col(group) == F.col("_group")) & (F.col("_cell") == F.col("_in"))
    placed = summed.join(starts, same).withColumn(into, F.col("_start") + F.col("_within"))
    return placed.drop("_cell", "_amount", "_within", "_start", "_in", "_group")
