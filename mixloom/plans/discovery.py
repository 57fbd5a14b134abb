"""Weekly job: ranked candidates to a stored discovery mix per user."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixloom.functions import clean_title
from mixloom.functions.time import AsOf
from mixloom.operators.assemble import assemble_discovery_mix
from mixloom.operators.enrich import known_artist_keys, track_group_metadata, with_artist_cluster, with_user_country
from mixloom.operators.exclude import (
    ARTIST_KEY,
    TITLE_KEY,
    TRACK_KEY,
    blacklist_keys,
    blacklisted_artist_keys,
    filter_known_keys,
    heard_keys,
)
from mixloom.operators.joins import SALTS, in_tasks, lookup, without_marked
from mixloom.operators.rank import diversity_rank, split_known_unknown, spread_known_artists, top_n
from mixloom.operators.shape import explode_recommendations


@dataclass(frozen=True)
class DiscoveryTables:
    """Inputs, with the columns of ``mixloom.sources.tables``."""

    recommendations: DataFrame
    users: DataFrame
    tracks: DataFrame
    track_groups: DataFrame
    blacklist: DataFrame
    compounds: DataFrame
    observed_tracks: DataFrame
    track_history: DataFrame
    favourite_tracks: DataFrame
    artist_history: DataFrame
    favourite_artists: DataFrame
    clusters: DataFrame


@dataclass(frozen=True)
class DiscoverySettings:
    # The product's rules.
    mix_size: int = 70
    min_mix_size: int = 30
    known_share: float = 0.2
    tracks_per_artist: int = 1
    known_artist_plays: int = 3
    known_artist_months: int = 6
    known_track_plays: int = 2
    known_track_months: int = 12
    # How many ways a much recommended track is split in the join with the catalogue.
    salts: int = SALTS
    # About how many candidates there are, where no user has more of them, or of keys, than a task can sort: all are then
    # dealt by user once, in tasks by this number. With 0 they are dealt by user and content, once per kind of key.
    candidates_by_user: int = 0


def catalogue(tracks: DataFrame, track_groups: DataFrame) -> DataFrame:
    """All a candidate needs of its track, one row per track group; titles are cleaned here, once per track."""
    shown = track_group_metadata(tracks).select("trackGroup", "artistId", clean_title("title").alias("cleanedTitle"))
    countries = track_groups.select("trackGroup", F.col("AvailableCountryCodes").alias("_countries"))
    return shown.join(countries.hint("merge"), "trackGroup")


def numbered_titles(tracks: DataFrame) -> DataFrame:
    """``cleanedTitle, titleId``: a short name of each title, the least of the track groups that have it."""
    shown = track_group_metadata(tracks).select("trackGroup", clean_title("title").alias("cleanedTitle"))
    return shown.groupBy("cleanedTitle").agg(F.min("trackGroup").alias("titleId"))


def candidate_tracks(tables: DiscoveryTables, salts: int = SALTS, titles: DataFrame | None = None) -> DataFrame:
    """Candidates with artist and title that may be played in the user's country.

    The country is attached to the list of a user, and metadata and availability come from one
    join, so that the exploded rows, the largest data of the job, are shuffled once here at most.
    With ``titles``, of ``numbered_titles``, they have ``titleId`` in place of the title.
    """
    ranked = tables.recommendations.withColumnRenamed("user", "userId").transform(with_user_country(tables.users))
    candidates = ranked.transform(explode_recommendations("userId"))
    shown, title = catalogue(tables.tracks, tables.track_groups), "cleanedTitle"
    if titles is not None:
        shown, title = shown.join(titles.hint("merge"), "cleanedTitle", "left").drop("cleanedTitle"), "titleId"
    tracks = lookup(candidates, shown, "trackGroup", salts=salts, large=True, by="userId")
    playable = tracks.where(F.array_contains("_countries", F.col("countryCode")))
    return playable.select("userId", "trackGroup", "pos", "artistId", title)


def artist_marks(known: DataFrame, blocked: DataFrame) -> DataFrame:
    """``userId, artistId, knownArtist, blocked`` (1 or 0) from rows of known and of blacklisted artists."""
    rows = known.select(*ARTIST_KEY, F.lit(1).alias("knownArtist"), F.lit(0).alias("blocked")).unionByName(
        blocked.select(*ARTIST_KEY, F.lit(0).alias("knownArtist"), F.lit(1).alias("blocked"))
    )
    return rows.groupBy(*ARTIST_KEY).agg(F.max("knownArtist").alias("knownArtist"), F.max("blocked").alias("blocked"))


def excluded_tracks(tables: DiscoveryTables, candidates: DataFrame, rules: dict) -> list[DataFrame]:
    """The key sets of tracks that a user has blacklisted, been shown, heard or saved."""
    return [
        blacklist_keys(tables.blacklist, "TRACK", candidates, "trackGroup"),
        tables.observed_tracks,
        heard_keys(tables.track_history, TRACK_KEY, **rules),
        tables.favourite_tracks,
    ]


def track_rules(as_of: AsOf, settings: DiscoverySettings) -> dict:
    return dict(as_of=as_of, min_plays=settings.known_track_plays, months=settings.known_track_months, date_col="dt")


def known_keys(tables: DiscoveryTables, as_of: AsOf, settings: DiscoverySettings) -> DataFrame:
    return known_artist_keys(
        tables.artist_history,
        tables.favourite_artists,
        as_of=as_of,
        min_plays=settings.known_artist_plays,
        months=settings.known_artist_months,
        date_col="dt",
    )


def unheard_candidates(tables: DiscoveryTables, as_of: AsOf, settings: DiscoverySettings) -> DataFrame:
    """Candidates after all take-out filters, with ``knownArtist``.

    Filters over the same columns are one join: track keys in the first, artist keys, blacklisted
    and known, in the last. User and content make up each key, which spreads heavy users as well as
    popular content.
    """
    candidates = candidate_tracks(tables, settings.salts)
    rules = track_rules(as_of, settings)
    fresh = candidates.transform(filter_known_keys(*excluded_tracks(tables, candidates, rules), on=TRACK_KEY))
    new_titles = fresh.transform(
        filter_known_keys(heard_keys(tables.track_history, TITLE_KEY, **rules), on=TITLE_KEY)
    ).drop("cleanedTitle")

    known = known_keys(tables, as_of, settings)
    marks = artist_marks(known, blacklisted_artist_keys(tables.blacklist, tables.compounds, candidates))
    marked = new_titles.join(marks, list(ARTIST_KEY), "left")
    allowed = marked.where(F.coalesce("blocked", F.lit(0)) == 0)
    return allowed.select(
        "userId", "artistId", "trackGroup", F.coalesce("knownArtist", F.lit(0)).alias("knownArtist"), "pos"
    )


def unheard_by_user(tables: DiscoveryTables, as_of: AsOf, settings: DiscoverySettings) -> DataFrame:
    """The rows of ``unheard_candidates``, of users whose candidates and keys a task can sort.

    Candidates, with a short name in place of the title, and the keys of all kinds are dealt by user once; the windows over
    a user and a track, a title or an artist, and those that choose the best, need no shuffle of their own then.
    """
    titles = numbered_titles(tables.tracks)
    candidates = candidate_tracks(tables, settings.salts, titles)
    rules = track_rules(as_of, settings)
    heard = lookup(heard_keys(tables.track_history, TITLE_KEY, **rules), titles, "cleanedTitle", large=True)
    keys = {
        "_track": [(k, "trackGroup") for k in excluded_tracks(tables, candidates, rules)],
        "_title": [(heard, "titleId")],
        "_known": [(known_keys(tables, as_of, settings), "artistId")],
        "_blocked": [(blacklisted_artist_keys(tables.blacklist, tables.compounds, candidates), "artistId")],
    }
    rows = candidates.withColumn("_kind", F.lit(None).cast("string"))
    for kind, sides in keys.items():
        for side, column in sides:
            named = side.where(F.col("userId").isNotNull() & F.col(column).isNotNull())
            rows = rows.unionByName(named.select("userId", column, F.lit(kind).alias("_kind")), allowMissingColumns=True)

    dealt = in_tasks(rows.repartition("userId"), settings.candidates_by_user, "userId")
    fresh = dealt.transform(without_marked(TRACK_KEY, "_track")).transform(without_marked(("userId", "titleId"), "_title"))
    known = F.coalesce(F.max(F.col("_kind") == "_known").over(Window.partitionBy(*ARTIST_KEY)), F.lit(False))
    allowed = fresh.withColumn("knownArtist", (known & F.col("artistId").isNotNull()).cast("int")).transform(
        without_marked(ARTIST_KEY, "_blocked")
    )
    return allowed.where("_kind IS NULL").select("userId", "artistId", "trackGroup", "knownArtist", "pos")


def discovery_mix(
    tables: DiscoveryTables, as_of: AsOf, settings: DiscoverySettings = DiscoverySettings()
) -> DataFrame:
    """``user, tracks, mixId, atDate`` per user with enough tracks left.

    Clusters are attached to the chosen tracks only, ``mix_size`` per user.
    """
    size = settings.mix_size
    unheard = unheard_by_user if settings.candidates_by_user else unheard_candidates
    return (
        unheard(tables, as_of, settings)
        .transform(top_n(["userId", "artistId"], ["pos", "trackGroup"], settings.tracks_per_artist))
        .transform(split_known_unknown(size, settings.known_share))
        .transform(with_artist_cluster(tables.clusters))
        .transform(diversity_rank(["cluster"], ["artistId"], gap=size // 7))
        .transform(spread_known_artists(size))
        .transform(assemble_discovery_mix(str(as_of)[:10], min_mix_size=settings.min_mix_size))
    )
