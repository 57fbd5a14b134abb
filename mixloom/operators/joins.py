"""Join shapes shared by the operators.

Joins carry no hint but one: Spark broadcasts a side only when its own size estimate, or under AQE the measured
size, is below ``spark.sql.autoBroadcastJoinThreshold``; beyond it the join is a shuffle. That estimate is the
size of compressed files and counts one element per list, so sides that grow with the catalogue or hold lists are merged, or
hashed after the shuffle where their rows are short.
"""

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 4
# Rows that a task sorts in some 300 MB, as candidates are.
ROWS_PER_TASK = 2_000_000
_SALT = "_salt"


def lookup(dataset: DataFrame, side: DataFrame, key: str, how: str = "inner", salts: int = SALTS, large: bool = False, hashed: bool = False, by: str | None = None) -> DataFrame:
    """Attach the columns of ``side``, which has one row per ``key``, to a much larger dataset.

    Such keys are skewed: one track, artist or user may hold a third of the dataset. Rows of a key are
    dealt to ``salts`` groups by a hash of the rest of the row (a repeated task deals them alike;
    maps cannot be hashed), and ``side`` is repeated once per group. The salted key also gives each
    side a shuffle of its own even when ``side`` is already grouped by ``key``, and AQE's skew join,
    which cuts a large group further, needs exactly that. A ``large`` side, which grows with
    the catalogue or has long lists in its rows, is never broadcast, however small Spark takes it to be.
    A ``hashed`` one is not either: each task holds its part of the side, which needs short rows, and
    the dataset is not sorted, which takes its tasks' memory and is spilled where a task has many rows.
    With ``by``, a column of which a key's rows have many values, as those of a track have users, rows are dealt by a hash of it
    alone: rows that lie together and are equal in it get one salt, and pack better.
    """
    rest = [c for c, kind in dataset.dtypes if c.lower() != key.lower() and "map<" not in kind]
    strategy = "shuffle_hash" if hashed else "merge" if large else None
    if salts <= 1 or not rest:
        return dataset.join(side.hint(strategy) if strategy else side, key, how)
    dealt = dataset.withColumn(_SALT, F.pmod(F.xxhash64(*([by] if by in rest else rest)), F.lit(salts)).cast("int"))
    # Unpivoted, the repeats count in Spark's estimate of the side's size; exploded, they would not.
    copies = {f"{_SALT}{i}": F.lit(i) for i in range(salts)}
    repeated = side.withColumns(copies).unpivot(side.columns, list(copies), "_copy", _SALT).drop("_copy")
    if strategy:
        repeated = repeated.hint(strategy)
    return dealt.join(repeated, [key, _SALT], how).drop(_SALT)


def in_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys`` to as many tasks as it takes for each to sort ``ROWS_PER_TASK``.

    A join or window over ``keys`` then needs no shuffle of its own. Where the session's partitions are enough, ``df`` stays as it
    is: Spark's own shuffle does the same, and AQE may merge its partitions.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    return df if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(tasks, *keys)


def distinct_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The key set of a side table.

    Repeated keys collapse before the shuffle, and that shuffle serves the join that follows.
    """
    return df.select(*on).dropDuplicates()


def without(dataset: DataFrame, keys: DataFrame, on: Sequence[str], few: bool = False) -> DataFrame:
    """Rows whose key is not in ``keys``. A null key is in no set, so such rows stay.

    ``few`` keys, next to the dataset, are hashed by task, so that the dataset is not sorted.
    """
    side = distinct_keys(keys, on)
    return dataset.join(side.hint("shuffle_hash") if few else side, list(on), "left_anti")


def without_at(dataset: DataFrame, keys: DataFrame, on: Sequence[str], owner: str, rows: int = 0) -> DataFrame:
    """``without``, with both sides dealt by ``owner``, one of the columns ``on``, alone; see ``without_each``."""
    return without_each(dataset, [(keys, on)], owner, rows)


def without_each(dataset: DataFrame, sets: Sequence[tuple[DataFrame, Sequence[str]]], owner: str, rows: int = 0) -> DataFrame:
    """``without`` for each of the sets of keys and their columns, with the dataset and all keys dealt by ``owner`` once.

    Joins would be dealt by the whole key, once for each kind; this way windows and groups per owner that follow need no shuffle of
    their own either. The dataset has to have few enough rows per owner for one task, as candidates of users have, which were one row
    before; the keys of an owner are read in order of the key and may be many. With ``rows``, about how many the dataset has, tasks
    are as many as it takes to sort them.
    """
    kinds = {f.name.lower(): f.dataType for f in dataset.schema}
    dealt = dataset.withColumn("_kind", F.lit(None).cast("int"))
    for kind, (keys, on) in enumerate(sets):
        named = keys.where(reduce(and_, (F.col(c).isNotNull() for c in on)))
        same = [F.col(c) if keys.schema[c].dataType == kinds[c.lower()] else F.col(c).try_cast(kinds[c.lower()]).alias(c) for c in on]
        dealt = dealt.unionByName(named.select(*same, F.lit(kind).alias("_kind")), allowMissingColumns=True)
    dealt, columns = in_tasks(dealt.repartition(owner), rows, owner), dataset.columns
    for kind, (_, on) in enumerate(sets):
        dealt = dealt.transform(without_marked(on, kind))
        columns = [*on, *(c for c in columns if c not in on)]
    return dealt.where("_kind IS NULL").select(*columns)


def without_marked(on: Sequence[str], mark: str | int) -> Callable[[DataFrame], DataFrame]:
    """``without`` in one table: rows whose key is that of a row whose ``_kind`` is ``mark``, and these rows, go; others stay.

    A null key is in no set. Rows dealt by some of the columns ``on`` are not shuffled.
    """

    def apply(df: DataFrame) -> DataFrame:
        found = F.max(F.col("_kind") == mark).over(Window.partitionBy(*on))
        named = reduce(and_, (F.col(c).isNotNull() for c in on))
        marked = df.withColumn("_out", named & F.coalesce(found, F.lit(False)))
        return marked.where(~F.col("_out")).drop("_out")

    return apply
