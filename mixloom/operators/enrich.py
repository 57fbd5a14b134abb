"""Attaching user, track and artist data."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.functions.time import AsOf
from mixloom.operators.exclude import ARTIST_KEY, plays_or_recent
from mixloom.operators.joins import distinct_keys, lookup
from mixloom.operators.shape import Operator


def user_country(users: DataFrame) -> DataFrame:
    return users.select(F.col("id").alias("userId"), "countryCode")


def with_user_country(users: DataFrame) -> Operator:
    """Add ``countryCode``; users without one row in ``users`` drop.

    Apply it before the lists are exploded: it then moves one row per user, not one per candidate.
    """
    return lambda df: df.join(user_country(users), "userId")


def track_group_metadata(tracks: DataFrame) -> DataFrame:
    """``trackGroup, artistId, title`` of the track with the lowest id of each group.

    The artist is the first of the track's main artists, null when it has none.
    """
    shown = F.struct(F.get("mainArtistsIds", F.lit(0)).alias("artistId"), "title")
    lowest = tracks.groupBy("trackGroup").agg(F.min_by(shown, "id").alias("_shown"))
    return lowest.select("trackGroup", "_shown.artistId", "_shown.title")


def with_track_metadata(tracks: DataFrame, *more: DataFrame) -> Operator:
    """Add ``artistId`` and ``title``; unknown track groups drop.

    The catalogue is hashed, so candidates are not sorted by track. ``more`` tables by ``trackGroup`` are joined to the catalogue, so
    that candidates move once for all.
    """
    side = reduce(lambda shown, other: shown.join(other.hint("merge"), "trackGroup"), more, track_group_metadata(tracks))
    return lambda df: lookup(df, side, "trackGroup", hashed=True, by="userId")


def available_in_country(track_groups: DataFrame) -> Operator:
    """Keep the tracks that are available in the row's ``countryCode``."""

    def apply(df: DataFrame) -> DataFrame:
        countries = track_groups.select("trackGroup", F.col("AvailableCountryCodes").alias("_countries"))
        joined = lookup(df, countries, "trackGroup", large=True)
        return joined.where(F.array_contains("_countries", F.col("countryCode"))).drop("_countries")

    return apply


def known_artist_keys(
    history: DataFrame,
    favourites: DataFrame | None = None,
    *,
    as_of: AsOf,
    min_plays: int = 3,
    months: int = 6,
    date_col: str = "lastStreamedDate",
) -> DataFrame:
    """Key rows of the artists that a user plays often, played lately or saved."""
    keys = history.where(plays_or_recent(history, min_plays, months, as_of, date_col)).select(*ARTIST_KEY)
    if favourites is not None:
        keys = keys.unionByName(favourites.select(*ARTIST_KEY))
    return keys


def known_artists(history: DataFrame, favourites: DataFrame | None = None, **rules) -> DataFrame:
    """Distinct ``userId, artistId`` of ``known_artist_keys``."""
    return distinct_keys(known_artist_keys(history, favourites, **rules), ARTIST_KEY)


def flag_known_artists(known: DataFrame) -> Operator:
    """Add ``knownArtist``, 1 or 0, and keep only what ranking needs. Repeated known keys count once."""

    def apply(df: DataFrame) -> DataFrame:
        flags = distinct_keys(known, ARTIST_KEY).withColumn("_known", F.lit(1))
        joined = df.join(flags, list(ARTIST_KEY), "left")
        return joined.select(
            "userId", "artistId", "trackGroup", F.coalesce("_known", F.lit(0)).alias("knownArtist"), "pos"
        )

    return apply


def with_artist_cluster(clusters: DataFrame, artist_col: str = "artistId", cluster_col: str = "cluster") -> Operator:
    """Add the artist's cluster, null when it has none."""
    side = clusters.select(F.col("artistId").alias(artist_col), cluster_col)
    return lambda df: lookup(df, side, artist_col, "left")


def with_similar_artists(similar: DataFrame, max_similars: int) -> Operator:
    """Replace each row by one per similar artist: ``artistId``, ``enriched_position`` and ``enriched`` = 1.

    The shortened lists are joined and only then exploded, which moves one row per artist.
    """

    def apply(df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c.lower() != "artistid"]
        lists = similar.select("artistId", F.slice("neighbours", 1, max_similars).alias("_near"))
        return lookup(df, lists, "artistId").select(
            *kept, F.posexplode("_near").alias("enriched_position", "artistId"), F.lit(1).alias("enriched")
        )

    return apply


def with_artist_metadata(
    artists: DataFrame, artist_col: str = "artistId", columns: Sequence[str] = ("name", "image")
) -> Operator:
    """Add artist columns (``image`` is the table's ``picture``); rows of unknown artists drop."""
    index = artists.withColumnsRenamed({"id": artist_col, "picture": "image"}).select(artist_col, *columns)
    return lambda df: lookup(df, index, artist_col)


def with_user_columns(users: DataFrame, user_col: str, columns: Sequence[str] | Mapping[str, str]) -> Operator:
    """Add the named user columns, under new names when a mapping is given; unknown users get nulls."""
    if isinstance(columns, Mapping):
        names = dict(columns)
    elif isinstance(columns, (list, tuple)):
        names = {c: c for c in columns}
    else:
        raise ValueError("columns has to be a list, a tuple or a mapping")
    side = users.select(F.col("id").alias(user_col), *[F.col(old).alias(new) for old, new in names.items()])
    return lambda df: lookup(df, side, user_col, "left")


def main_artists(compounds: DataFrame) -> DataFrame:
    """``artistId, resolvedArtistId``: each compound's main constituent of lowest priority."""
    main = compounds.where(F.col("mainArtist"))
    order = F.struct("priority", "artistCompoundId")
    return main.groupBy("artistId").agg(F.min_by("artistCompoundId", order).alias("resolvedArtistId"))


def to_main_artist(compounds: DataFrame) -> Operator:
    """Replace compound artists by their main artist; other artists stay as they are."""

    def apply(df: DataFrame) -> DataFrame:
        joined = lookup(df, main_artists(compounds), "artistId", "left")
        resolved = joined.withColumn("artistId", F.coalesce("resolvedArtistId", "artistId"))
        return resolved.drop("resolvedArtistId")

    return apply
