"""The mixes that hold on a day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.functions.time import AsOf
from mixloom.operators.shape import Operator


def current_mixes(day: AsOf, owner: str = "user") -> Operator:
    """Of each owner's stored mixes the latest as of ``day``.

    Ids are the same every week, so a job that looks mixes up by id starts here. One maximum per owner, partly
    taken before the shuffle; among mixes of one date the greatest id and list.
    """

    def apply(df: DataFrame) -> DataFrame:
        others = ["atDate", *[c for c in df.columns if c not in (owner, "atDate")]]
        # Dates are ISO text, whose order is that of time.
        stored = df.where(F.substring("atDate", 1, 10) <= str(day)[:10])
        latest = stored.groupBy(owner).agg(F.max(F.struct(*others)).alias("_mix"))
        return latest.select(owner, "_mix.*").select(*df.columns)

    return apply
