"""Ranked rows to stored mixes."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.functions import mix_id, ordered_values
from mixloom.functions.ids import ARTIST_TOP_TRACKS_PREFIX, DISCOVERY_PREFIX
from mixloom.functions.time import AsOf
from mixloom.operators.rank import top_n
from mixloom.operators.shape import Operator


def ordered_tracks(owner: str, order_by: Sequence[str]) -> Operator:
    """One row per owner with its ``tracks``, as text, in order. Equal ranks go by track group."""

    def apply(df: DataFrame) -> DataFrame:
        texts = df.withColumn("trackGroup", F.col("trackGroup").cast("string"))
        return texts.groupBy(owner).agg(ordered_values("trackGroup", [*order_by, "trackGroup"]).alias("tracks"))

    return apply


def assemble_discovery_mix(
    as_of: AsOf, order_by: Sequence[str] = ("rank", "innerRank"), min_mix_size: int = 66, id_type: str = "int"
) -> Operator:
    """``user, tracks, mixId, atDate`` for the users that have at least ``min_mix_size`` tracks.

    Ids beyond ``int`` need ``id_type="bigint"``.
    """

    def apply(df: DataFrame) -> DataFrame:
        lists = df.transform(ordered_tracks("userId", order_by)).where(F.size("tracks") >= min_mix_size)
        owned = lists.select(F.col("userId").cast(id_type).alias("user"), "tracks")
        return owned.select(
            "user", "tracks", mix_id(DISCOVERY_PREFIX, "user").alias("mixId"), F.lit(str(as_of)).alias("atDate")
        )

    return apply


def assemble_artist_mix(
    as_of: AsOf, order_by: Sequence[str] = ("rank",), id_type: str = "int", size: int | None = None
) -> Operator:
    """``artistId, tracks, mixId, atDate``, one row per artist.

    With ``size``, the first so many tracks: rows beyond it are dropped before the shuffle. Without it the list is
    as long as the artist's rows, which then must be few enough for one row.
    """

    def apply(df: DataFrame) -> DataFrame:
        if size is not None:
            named = df.where(F.col("trackGroup").isNotNull()).withColumn("trackGroup", F.col("trackGroup").cast("string"))
            df = named.transform(top_n(["artistId"], [*order_by, "trackGroup"], size))
        lists = df.transform(ordered_tracks("artistId", order_by))
        owned = lists.select(F.col("artistId").cast(id_type).alias("artistId"), "tracks")
        return owned.select(
            "artistId",
            "tracks",
            mix_id(ARTIST_TOP_TRACKS_PREFIX, "artistId").alias("mixId"),
            F.lit(str(as_of)).alias("atDate"),
        )

    return apply
