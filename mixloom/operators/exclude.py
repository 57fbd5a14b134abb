"""Take-out filters: what a user has heard, saved, been shown or blacklisted.

Each filter is a key set and an anti join. The key sets are functions of their own, not yet made
distinct, so that a job can union the sets over the same columns and pay for one shuffle and join.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.functions import months_before
from mixloom.functions.time import AsOf
from mixloom.operators.joins import without, without_each
from mixloom.operators.shape import Operator

TRACK_KEY = ("userId", "trackGroup")
TITLE_KEY = ("userId", "cleanedTitle")
ARTIST_KEY = ("userId", "artistId")
ALBUM_KEY = ("userId", "masterBundleId")


def plays_or_recent(history: DataFrame, min_plays: int, months: int, as_of: AsOf, date_col: str) -> Column:
    """Played often enough, or lately. A null on one side leaves the decision to the other."""
    cutoff = months_before(as_of, months, history.schema[date_col].dataType)
    return (F.col("count") >= min_plays) | (F.col(date_col) >= cutoff)


def heard_keys(
    history: DataFrame,
    on: Sequence[str] = TRACK_KEY,
    *,
    as_of: AsOf | None = None,
    min_plays: int = 1,
    months: int = 12,
    date_col: str = "lastStreamedDate",
) -> DataFrame:
    """Key rows of the history that count as heard. With ``min_plays`` or ``months`` 0, all of them."""
    if min_plays and months:
        if as_of is None:
            raise ValueError("as_of is needed with min_plays and months")
        history = history.where(plays_or_recent(history, min_plays, months, as_of, date_col))
    return history.select(*on)


def filter_heard(
    history: DataFrame | None,
    on: Sequence[str] = TRACK_KEY,
    *,
    as_of: AsOf | None = None,
    min_plays: int = 1,
    months: int = 12,
    date_col: str = "lastStreamedDate",
    enabled: bool = True,
    few: bool = False,
    by_user: int = 0,
) -> Operator:
    """Remove what was heard. Without a history, or disabled, nothing is removed. ``few`` is that of ``joins.without``.

    ``by_user``, about how many candidates there are, deals them and the keys by user alone, see ``joins.without_each``.
    """

    def apply(df: DataFrame) -> DataFrame:
        if history is None or not enabled:
            return df
        keys = heard_keys(history, on, as_of=as_of, min_plays=min_plays, months=months, date_col=date_col)
        return without_each(df, [(keys, on)], on[0], by_user) if by_user else without(df, keys, on, few)

    return apply


def filter_known_keys(*key_sets: DataFrame, on: Sequence[str] = TRACK_KEY) -> Operator:
    """Remove the rows whose key is in any of the sets, with one anti join."""

    def apply(df: DataFrame) -> DataFrame:
        return without(df, reduce(DataFrame.unionByName, (s.select(*on) for s in key_sets)), on)

    return apply


def blacklist_keys(
    blacklist: DataFrame, kind: str, like: DataFrame, id_col: str, user_col: str = "userId"
) -> DataFrame:
    """``user_col, id_col`` of the entries of one kind.

    Blacklists hold ids as text. They are read as the types the columns have in ``like``, after the
    kinds are told apart; a malformed id becomes null and matches nothing.
    """
    types = like.schema
    entries = blacklist.where(F.col("artifactType") == kind).select(
        F.col("userId").try_cast(types[user_col].dataType).alias(user_col),
        F.col("artifactId").try_cast(types[id_col].dataType).alias(id_col),
    )
    return entries.where(F.col(id_col).isNotNull())


def blacklisted_artist_keys(
    blacklist: DataFrame, compounds: DataFrame, like: DataFrame, user_col: str = "userId"
) -> DataFrame:
    """Blacklisted artists, and every compound artist that one of them is a constituent of."""
    named = blacklist_keys(blacklist, "ARTIST", like, "artistId", user_col)
    members = compounds.select(
        F.col("artistCompoundId").alias("artistId"), F.col("artistId").alias("_compound")
    ).dropDuplicates()
    wider = named.join(members, "artistId").select(user_col, F.col("_compound").alias("artistId"))
    return named.unionByName(wider)


Keys = tuple[DataFrame, list[str]]


def _blacklisted_tracks(blacklist: DataFrame, like: DataFrame, user_col: str) -> Keys:
    return blacklist_keys(blacklist, "TRACK", like, "trackGroup", user_col), [user_col, "trackGroup"]


def _blacklisted_videos(blacklist: DataFrame, like: DataFrame, user_col: str) -> Keys:
    return blacklist_keys(blacklist, "VIDEO", like, "videoId", user_col), [user_col, "videoId"]


def _blacklisted_artists(blacklist: DataFrame, compounds: DataFrame, like: DataFrame, user_col: str) -> Keys:
    return blacklisted_artist_keys(blacklist, compounds, like, user_col), [user_col, "artistId"]


def filter_blacklisted_tracks(blacklist: DataFrame, user_col: str = "userId") -> Operator:
    return lambda df: without(df, *_blacklisted_tracks(blacklist, df, user_col))


def filter_blacklisted_videos(blacklist: DataFrame, user_col: str = "userId") -> Operator:
    return lambda df: without(df, *_blacklisted_videos(blacklist, df, user_col))


def filter_blacklisted_artists(blacklist: DataFrame, compounds: DataFrame, user_col: str = "userId") -> Operator:
    return lambda df: without(df, *_blacklisted_artists(blacklist, compounds, df, user_col))


def filter_blacklist(
    blacklist: DataFrame,
    compounds: DataFrame,
    *,
    tracks: bool = True,
    videos: bool = False,
    artists: bool = True,
    user_col: str = "userId",
    by_user: int = 0,
) -> Operator:
    """The kinds of blacklisting that are switched on.

    ``by_user``, about how many candidates there are, deals them and the keys of all kinds by user once, see ``joins.without_each``.
    """

    def apply(df: DataFrame) -> DataFrame:
        sets = [
            *([_blacklisted_tracks(blacklist, df, user_col)] if tracks else []),
            *([_blacklisted_videos(blacklist, df, user_col)] if videos else []),
            *([_blacklisted_artists(blacklist, compounds, df, user_col)] if artists else []),
        ]
        if by_user and sets:
            return without_each(df, sets, user_col, by_user)
        return reduce(lambda rows, one: without(rows, *one), sets, df)

    return apply


def album_play_counts(history: DataFrame, min_plays: int) -> DataFrame:
    """``userId, masterBundleId, plays`` of the albums played at least ``min_plays`` times over all tracks."""
    plays = history.groupBy(*ALBUM_KEY).agg(F.sum("count").alias("plays"))
    return plays.where(F.col("plays") >= min_plays)


def filter_heard_albums(history: DataFrame, min_plays: int, by_user: int = 0) -> Operator:
    """Remove the albums a user knows; the counts are one row per key already. ``by_user`` is that of ``filter_heard``."""
    known = lambda: album_play_counts(history, min_plays).drop("plays")
    if by_user:
        return lambda df: without_each(df, [(known(), ALBUM_KEY)], ALBUM_KEY[0], by_user)
    return lambda df: df.join(known(), list(ALBUM_KEY), "left_anti")
