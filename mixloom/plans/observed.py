"""Daily job: the tracks of the mixes that were opened."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.functions.time import AsOf
from mixloom.operators.shape import explode_tracks
from mixloom.plans.current import current_mixes

# Repeats of one mix that are written out together.
PORTION = 1000


def observed_tracks(mixes: DataFrame, observed: DataFrame, as_of: AsOf | None = None) -> DataFrame:
    """``user, trackGroup`` of the stored mixes whose ``mixId`` was observed.

    With ``as_of``, of stored mixes of several weeks, which share their ids, the current ones.
    A mix observed n times gives its tracks n times. Observations are counted before the join, which
    so has one row per mix on either side. Up to ``PORTION`` repeats are written out where the mix is;
    only mixes with more are shuffled, their further repeats dealt in portions to many tasks.
    """
    counts = observed.groupBy("mixId").agg(F.count(F.lit(1)).alias("times"))
    if as_of is not None:
        mixes = mixes.transform(current_mixes(as_of))
    opened = mixes.select("mixId", "user", "tracks").join(counts, "mixId")
    size = F.lit(PORTION).cast("long")
    first = opened.withColumn("start", F.lit(0).cast("long"))
    further = opened.where(F.col("times") > PORTION).select(
        "*", F.explode(F.sequence(size, F.col("times") - 1, size)).alias("start")
    )
    portions = first.unionByName(further.repartition("mixId", "start"))
    last = F.least(F.col("start") + PORTION, F.col("times"))
    repeats = portions.select("user", "tracks", F.explode(F.sequence(F.col("start") + 1, last)))
    return repeats.transform(explode_tracks)
