from datetime import datetime

import pytest

from mixloom.operators import enrich
from mixloom.operators.joins import lookup


def test_user_country_drops_unknown_users(frame, rows):
    users = frame("id bigint, countryCode string", (1, "AD"), (3, "AE"))
    lists = frame("userId bigint, recommendations array<string>", (1, ["x"]), (2, ["y"]))
    assert rows(lists.transform(enrich.with_user_country(users)), "userId", "countryCode") == [(1, "AD")]


TRACKS = "id bigint, trackGroup string, title string, mainArtistsIds array<bigint>"


@pytest.fixture
def tracks(frame):
    return frame(
        TRACKS,
        (2, "a", "second", [20]),
        (1, "a", "first", [10, 20]),
        (3, "b", None, []),
        (4, "c", "only", None),
    )


def test_lowest_track_represents_its_group(tracks, rows):
    metadata = enrich.track_group_metadata(tracks)
    assert metadata.columns == ["trackGroup", "artistId", "title"]
    assert rows(metadata) == [("a", 10, "first"), ("b", None, None), ("c", None, "only")]


def test_metadata_join(tracks, frame, rows):
    df = frame("userId bigint, trackGroup string, pos int", (1, "a", 0), (1, "zzz", 1), (2, "a", 0), (1, None, 2))
    out = df.transform(enrich.with_track_metadata(tracks))
    assert rows(out, "userId", "trackGroup", "pos", "artistId", "title") == [
        (1, "a", 0, 10, "first"),
        (2, "a", 0, 10, "first"),
    ]


@pytest.mark.parametrize("salts", [1, 2, 7])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_is_a_plain_join(frame, rows, how, salts):
    df = frame("k bigint, v array<int>", *[(i % 3, [i]) for i in range(30)], (None, [99]), (7, None))
    side = frame("k bigint, w string", (0, "zero"), (1, "one"), (5, "five"))
    expected = rows(df.join(side, "k", how), "k", "v", "w")
    assert rows(lookup(df, side, "k", how, salts), "k", "v", "w") == expected


def test_available_in_country(frame, rows):
    groups = frame("trackGroup string, AvailableCountryCodes array<string>", ("a", ["AD", "AE"]), ("b", []), ("c", None))
    df = frame(
        "userId bigint, trackGroup string, countryCode string",
        (1, "a", "AD"), (2, "a", "NO"), (1, "b", "AD"), (1, "c", "AD"), (1, "d", "AD"), (3, "a", None),
    )
    out = df.transform(enrich.available_in_country(groups))
    assert out.columns == ["trackGroup", "userId", "countryCode"]
    assert rows(out, "userId", "trackGroup") == [(1, "a")]


def test_known_artists_are_flagged_once(frame, rows):
    history = frame(
        "userId bigint, artistId bigint, count bigint, dt timestamp",
        (1, 10, 3, datetime(2019, 1, 1)),
        (1, 11, 1, datetime(2021, 1, 2)),
        (1, 12, 1, datetime(2020, 1, 1)),
        (1, 10, 9, datetime(2021, 6, 1)),
    )
    favourites = frame("userId bigint, artistId bigint, extra int", (1, 10, 0), (2, 12, 0))
    rules = dict(as_of="2021-07-01", min_plays=3, months=6, date_col="dt")
    assert rows(enrich.known_artists(history, **rules)) == [(1, 10), (1, 11)]
    known = enrich.known_artists(history, favourites, **rules)
    assert rows(known) == [(1, 10), (1, 11), (2, 12)]
    df = frame(
        "userId bigint, artistId bigint, trackGroup string, pos int, other string",
        (1, 10, "a", 0, "x"), (1, 12, "b", 1, "x"), (2, 12, "c", 0, "x"), (2, None, "d", 1, "x"),
    )
    out = df.transform(enrich.flag_known_artists(known.union(known)))
    assert out.columns == ["userId", "artistId", "trackGroup", "knownArtist", "pos"]
    assert rows(out, "trackGroup", "knownArtist") == [("a", 1), ("b", 0), ("c", 1), ("d", 0)]


def test_cluster_is_null_when_unknown(frame, rows):
    clusters = frame("artistId bigint, cluster bigint", (1, 42))
    df = frame("artistId bigint", (1,), (2,), (None,))
    assert rows(df.transform(enrich.with_artist_cluster(clusters)), "artistId", "cluster") == [
        (None, None), (1, 42), (2, None),
    ]
    renamed = df.withColumnRenamed("artistId", "who")
    assert set(renamed.transform(enrich.with_artist_cluster(clusters, "who")).columns) == {"who", "cluster"}


def test_similar_artists_replace_the_artist(frame, rows):
    similar = frame("artistId bigint, neighbours array<bigint>", (1, [7, 8, 9]), (2, []), (3, None))
    df = frame("userId bigint, artistId bigint, pos int", (5, 1, 0), (5, 2, 1), (5, 3, 2), (5, 4, 3))
    out = df.transform(enrich.with_similar_artists(similar, 2))
    assert rows(out, "userId", "artistId", "pos", "enriched_position", "enriched") == [(5, 7, 0, 0, 1), (5, 8, 0, 1, 1)]
    assert len(out.columns) == 5


def test_artist_metadata(frame, rows):
    artists = frame("id bigint, name string, picture string", (1, "One", "p"), (2, "Two", None))
    df = frame("artistId bigint", (1,), (2,), (3,))
    assert rows(df.transform(enrich.with_artist_metadata(artists))) == [(1, "One", "p"), (2, "Two", None)]
    assert df.transform(enrich.with_artist_metadata(artists, columns=["name"])).columns == ["artistId", "name"]


def test_user_columns(frame, rows):
    users = frame("id bigint, countryCode string, age int, other string", (1, "AD", 30, "x"))
    df = frame("owner bigint", (1,), (2,))
    listed = df.transform(enrich.with_user_columns(users, "owner", ["age"]))
    assert listed.columns == ["owner", "age"] and rows(listed) == [(1, 30), (2, None)]
    mapped = df.transform(enrich.with_user_columns(users, "owner", {"countryCode": "country"}))
    assert mapped.columns == ["owner", "country"] and rows(mapped) == [(1, "AD"), (2, None)]
    with pytest.raises(ValueError):
        enrich.with_user_columns(users, "owner", "age")


def test_main_artist_of_lowest_priority(frame, rows):
    compounds = frame(
        "artistId bigint, artistCompoundId bigint, priority bigint, mainArtist boolean",
        (33, 2, 2, True), (33, 1, 1, True), (33, 9, 0, False), (34, 5, 1, False),
    )
    df = frame("artistId bigint, trackGroup string", (33, "a"), (34, "b"), (1, "c"), (None, "d"))
    out = df.transform(enrich.to_main_artist(compounds))
    assert set(out.columns) == {"artistId", "trackGroup"}
    assert rows(out, "trackGroup", "artistId") == [("a", 1), ("b", 34), ("c", 1), ("d", None)]
