"""Choosing and ordering candidates within a user. Every order is total, so results repeat."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.operators.shape import Operator


def top_n(
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    n: int | Column,
    at_most: int | None = None,
    rank_col: str | None = None,
) -> Operator:
    """The first ``n`` rows of each group.

    ``n`` may differ per row; ``at_most``, a bound on it, then lets Spark cut every group before the
    shuffle, as it does by itself for a plain number. ``rank_col`` keeps the 1-based rank.
    """
    name = rank_col or "_place"

    def apply(df: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
        ranked = df.withColumn(name, place)
        if at_most is not None:
            ranked = ranked.where(F.col(name) <= at_most)
        kept = ranked.where(F.col(name) <= n)
        return kept if rank_col else kept.drop(name)

    return apply


def known_quota(mix_size: int, known_share: float) -> int:
    """Tracks of known artists in a full mix. The product is truncated: 0.29 of 100 is 28."""
    return int(known_share * mix_size)


def split_known_unknown(mix_size: int = 70, known_share: float = 0.2) -> Operator:
    """Keep the best candidates within the quotas of known and unknown artists.

    A shortage on one side is filled by the other; at most ``mix_size`` rows per user are left.
    Rows without an artist rank as unknown, but do not count as supply of unknown artists.

    No quota exceeds ``mix_size`` and no count above it changes one. So each user's known, unknown
    and artist-less rows are first cut to the best ``mix_size``, before the shuffle where possible,
    and the counts are taken over what is left.
    """
    known_cap = known_quota(mix_size, known_share)
    unknown_cap = mix_size - known_cap
    order = ["pos", "trackGroup"]

    def apply(df: DataFrame) -> DataFrame:
        marked = df.withColumn("_nameless", F.col("artistId").isNull())
        short = marked.transform(top_n(["userId", "knownArtist", "_nameless"], order, mix_size)).drop("_nameless")

        user = Window.partitionBy("userId")
        supply = short.withColumns(
            {"_known": F.sum("knownArtist").over(user), "_artists": F.count("artistId").over(user)}
        ).withColumn("_unknown", F.col("_artists") - F.col("_known"))

        fill_known = F.when(F.col("_unknown") < unknown_cap, mix_size - F.col("_unknown")).otherwise(known_cap)
        fill_unknown = F.when(F.col("_known") < known_cap, mix_size - F.col("_known")).otherwise(unknown_cap)
        limit = F.when(F.col("knownArtist") == 1, fill_known).otherwise(fill_unknown)
        chosen = supply.transform(top_n(["userId", "knownArtist"], order, limit, at_most=mix_size))
        return chosen.drop("_known", "_artists", "_unknown")

    return apply


def diversity_rank(
    group_one: Sequence[str],
    group_two: Sequence[str],
    *,
    id_cols: Sequence[str] = ("userId",),
    order_by: str = "pos",
    gap: int = 5,
    rank_col: str = "rank",
    tie_breaker: Sequence[str] = ("trackGroup",),
) -> Operator:
    """Rank a list so that rows of one group (say cluster, or artist) stand apart.

    The n-th row of a group moves ``n * gap`` places down, by the group in which it comes later; it
    starts from the better of its two groups' places. Of equal rows the one with the larger
    ``order_by`` comes first. The rows are shuffled by the id once, and all windows use that; cut
    long lists before, as the quota split does.
    """
    ids = list(id_cols)

    def apply(df: DataFrame) -> DataFrame:
        one = Window.partitionBy(*ids, *group_one).orderBy(order_by, *tie_breaker)
        two = Window.partitionBy(*ids, *group_two).orderBy(order_by, *tie_breaker)
        placed = df.repartition(*ids).withColumns(
            {
                "_head1": F.first(order_by, ignorenulls=True).over(one),
                "_nth1": F.row_number().over(one) - 1,
                "_head2": F.first(order_by, ignorenulls=True).over(two),
                "_nth2": F.row_number().over(two) - 1,
            }
        )
        by_id = Window.partitionBy(*ids)
        best_group = F.least(
            F.dense_rank().over(by_id.orderBy("_head1")), F.dense_rank().over(by_id.orderBy("_head2"))
        )
        score = placed.withColumn("_score", best_group - 1 + gap * F.greatest("_nth1", "_nth2"))
        final = by_id.orderBy("_score", F.desc(order_by), *tie_breaker)
        ranked = score.withColumn(rank_col, F.row_number().over(final))
        return ranked.drop("_head1", "_nth1", "_head2", "_nth2", "_score")

    return apply


def spread_known_artists(mix_size: int = 70, rank_col: str = "rank", tie_col: str = "innerRank") -> Operator:
    """Spread the tracks of known artists evenly over the list.

    With K known tracks of ``mix_size`` M the i-th known track gets the key ``i * (M - K)`` and the
    j-th unknown track ``j * K``, in whole numbers, so that nothing depends on rounding. The key
    replaces ``rank_col``; the rank before it stays in ``tie_col`` to order equal keys.
    """

    def apply(df: DataFrame) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy("userId", "knownArtist").orderBy(rank_col, "trackGroup"))
        known = F.sum("knownArtist").over(Window.partitionBy("userId"))
        counted = df.withColumns({"_nth": nth, "_known": known, tie_col: F.col(rank_col)})
        step = F.when(F.col("knownArtist") == 1, mix_size - F.col("_known")).otherwise(F.col("_known"))
        return counted.withColumn(rank_col, F.col("_nth") * step).drop("_nth", "_known")

    return apply
