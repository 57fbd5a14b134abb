"""Lists to rows and back to shorter lists. All of these are narrow: no shuffle."""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.functions import day_slice_start, updated_millis
from mixloom.functions.time import AsOf

Operator = Callable[[DataFrame], DataFrame]


def explode_positions(column: str, alias: str | Mapping[str, str] = "col") -> Operator:
    """One row per element of an array, or entry of a map, with its 0-based ``pos``.

    ``alias`` names the element; as a mapping it copies any of the generated columns (``pos``, then
    ``col`` for an array, ``key`` and ``value`` for a map) to new names, and ``col`` is dropped.
    Rows with a null or empty list give nothing. Only the exploded column itself is left out.
    """

    def apply(df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c.lower() != column.lower()]
        named = ["pos", alias] if isinstance(alias, str) else ["pos", *alias.values()]
        if twice := {c.lower() for c in kept} & {c.lower() for c in named}:
            raise ValueError(f"the table already has {sorted(twice)}")
        is_map = isinstance(df.schema[column].dataType, T.MapType)
        made = ["pos", "key", "value"] if is_map else ["pos", "col"]
        if isinstance(alias, str) and not is_map:
            made = ["pos", alias]
        if isinstance(alias, str):
            return df.select(*kept, F.posexplode(column).alias(*made))
        own = [f"_made_{c}" for c in made]
        out = df.select(*kept, F.posexplode(column).alias(*own))
        shown = [F.col(o).alias(c) for o, c in zip(own, made) if c != "col"]
        return out.select(*kept, *shown, *[F.col(f"_made_{old}").alias(new) for old, new in alias.items()])

    return apply


def explode_recommendations(user: str = "user", recommendations: str = "recommendations") -> Operator:
    """Ranked list per user to one row ``userId, trackGroup, pos`` per candidate."""

    def apply(df: DataFrame) -> DataFrame:
        renamed = df.withColumnRenamed(user, "userId")
        return renamed.transform(explode_positions(recommendations, "trackGroup"))

    return apply


def explode_tracks(df: DataFrame) -> DataFrame:
    """``user, trackGroup``: one row per track of each list, repeats kept."""
    return df.select("user", F.explode("tracks").alias("trackGroup"))


def daily_slice(day: AsOf, size: int = 10) -> Operator:
    """The weekday's ``size`` tracks of a weekly list; empty past its end."""
    return lambda df: df.withColumn("tracks", F.slice("tracks", day_slice_start(day, size), F.lit(size)))


def long_enough(size: int, slack: int = 2) -> Operator:
    """Lists that miss at most ``slack`` of ``size`` tracks. A null list is not long enough."""
    return lambda df: df.where(F.size("tracks") >= size - slack)


def stamp_updated(moment: AsOf) -> Operator:
    """Add ``updated``, the run's time in epoch milliseconds."""
    return lambda df: df.withColumn("updated", updated_millis(F.lit(str(moment)).cast("timestamp")))
