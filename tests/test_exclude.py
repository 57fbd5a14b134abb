from datetime import datetime

import pytest

from mixloom.operators import exclude
from mixloom.operators.joins import without, without_at, without_each

DATA = "userId bigint, trackGroup string, cleanedTitle string, artistId bigint, videoId bigint, masterBundleId string"
AS_OF = "2021-06-15 12:00:00"


@pytest.fixture
def data(frame):
    return frame(
        DATA,
        (1, "a", "one", 10, 100, "A"),
        (1, "b", "two", 11, 101, "A"),
        (1, "c", None, None, None, None),
        (2, "a", "one", 10, 100, "A"),
        (2, "111", "tri", 33, 102, "B"),
    )


HISTORY = "userId bigint, trackGroup string, cleanedTitle string, count bigint, dt timestamp"


@pytest.fixture
def history(frame):
    old, edge, late = datetime(2019, 1, 1), datetime(2020, 6, 15, 12), datetime(2020, 6, 15, 11, 59, 59)
    return frame(
        HISTORY,
        (1, "a", "two", 5, old),
        (1, "b", "x", 1, edge),
        (1, "c", None, 1, late),
        (2, "a", "one", None, None),
        (2, "111", "x", None, edge),
        (None, "a", "one", 9, edge),
    )


def left(rows, df):
    return rows(df, "userId", "trackGroup")


def test_heard_by_count_or_date(data, history, rows):
    rules = dict(as_of=AS_OF, min_plays=2, months=12, date_col="dt")
    assert left(rows, data.transform(exclude.filter_heard(history, **rules))) == [(1, "c"), (2, "a")]


def test_heard_titles_match_other_track_groups_and_keep_null_titles(data, history, rows):
    rules = dict(as_of=AS_OF, min_plays=2, months=12, date_col="dt")
    kept = data.transform(exclude.filter_heard(history, exclude.TITLE_KEY, **rules))
    assert left(rows, kept) == [(1, "a"), (1, "c"), (2, "111"), (2, "a")]


@pytest.mark.parametrize("limits", [dict(min_plays=0, months=12), dict(min_plays=2, months=0)])
def test_without_a_threshold_everything_counts(data, history, rows, limits):
    assert left(rows, data.transform(exclude.filter_heard(history, **limits))) == []


def test_switched_off_or_no_history(data, history, rows):
    assert data.transform(exclude.filter_heard(None, as_of=AS_OF)).count() == 5
    assert data.transform(exclude.filter_heard(history, min_plays=0, enabled=False)).count() == 5


def test_threshold_needs_a_date(data, history):
    with pytest.raises(ValueError):
        data.transform(exclude.filter_heard(history, date_col="dt"))


BLACKLIST = "userId string, artifactType string, artifactId string"


@pytest.fixture
def blacklist(frame):
    return frame(
        BLACKLIST,
        ("1", "TRACK", "a"),
        ("2", "TRACK", "111"),
        ("1", "VIDEO", "101"),
        ("1", "ARTIST", "11"),
        ("2", "ARTIST", "10"),
        ("2", "ARTIST", "3"),
        ("2", "ARTIST", "not-a-number"),
        ("not-a-number", "TRACK", "a"),
        ("3", "TRACK", "111"),
    )


@pytest.fixture
def compounds(frame):
    return frame("artistId bigint, artistCompoundId bigint", (33, 3), (33, 3), (10, 4), (11, 12))


def test_blacklisted_tracks(data, blacklist, rows):
    kept = data.transform(exclude.filter_blacklisted_tracks(blacklist))
    assert left(rows, kept) == [(1, "b"), (1, "c"), (2, "a")]


def test_blacklisted_videos(data, blacklist, rows):
    kept = data.transform(exclude.filter_blacklisted_videos(blacklist))
    assert left(rows, kept) == [(1, "a"), (1, "c"), (2, "111"), (2, "a")]


def test_blacklisted_artists_with_compounds(data, blacklist, compounds, rows):
    kept = data.transform(exclude.filter_blacklisted_artists(blacklist, compounds))
    assert left(rows, kept) == [(1, "a"), (1, "c")]


def test_blacklist_switches_and_user_column(data, blacklist, compounds, rows):
    kept = data.transform(exclude.filter_blacklist(blacklist, compounds))
    assert left(rows, kept) == [(1, "c")]
    only_videos = exclude.filter_blacklist(blacklist, compounds, tracks=False, videos=True, artists=False)
    assert data.transform(only_videos).count() == 4
    renamed = data.withColumnRenamed("userId", "listener")
    kept = renamed.transform(exclude.filter_blacklist(blacklist, compounds, videos=True, user_col="listener"))
    assert rows(kept, "listener", "trackGroup") == [(1, "c")]


def test_heard_albums_add_up_tracks(data, frame, rows):
    history = frame(
        "userId bigint, masterBundleId string, count bigint",
        (1, "A", 1), (1, "A", 1), (2, "A", 1), (2, "B", None), (1, None, 9),
    )
    assert rows(exclude.album_play_counts(history, 2)) == [(1, None, 9), (1, "A", 2)]
    assert left(rows, data.transform(exclude.filter_heard_albums(history, 2))) == [(1, "c"), (2, "111"), (2, "a")]


def test_merged_key_sets_equal_one_after_the_other(data, frame, rows):
    one = frame("userId bigint, trackGroup string", (1, "a"), (1, "a"))
    two = frame("trackGroup string, userId bigint, more int", ("b", 1, 0), (None, 2, 0))
    merged = data.transform(exclude.filter_known_keys(one, two))
    chained = data.transform(exclude.filter_known_keys(one)).transform(exclude.filter_known_keys(two))
    assert left(rows, merged) == left(rows, chained) == [(1, "c"), (2, "111"), (2, "a")]


def test_without_at_gives_the_rows_of_without(spark, frame, rows):
    schema = "userId bigint, trackGroup string, pos int"
    df = frame(schema, (1, "a", 0), (1, "a", 0), (1, "b", 1), (1, None, 2), (2, "a", 0), (None, "a", 3), (None, None, 4))
    keys = frame("userId bigint, trackGroup string, dt string", (1, "a", "x"), (1, "a", "y"), (1, None, "x"), (None, "a", "x"), (3, "b", "x"))
    on = ("userId", "trackGroup")
    found = without_at(df, keys, on, "userId")
    assert found.columns == df.columns
    assert rows(found) == rows(without(df, keys, on)) == rows(frame(schema, (1, "b", 1), (1, None, 2), (2, "a", 0), (None, "a", 3), (None, None, 4)))
    assert rows(without_at(df, keys.where("userId = 9"), on, "userId")) == rows(df)


def test_keys_of_all_kinds_by_owner(frame, rows):
    df = frame("userId int, trackGroup string, artistId bigint", (1, "5", 7), (1, None, 7), (None, "5", 8), (1, "6", 8), (2, "5", 8), (2, "5", 8), (2, "8", None))
    tracks = frame("userId bigint, trackGroup int", (1, 6), (None, 5), (2, None), (2**40, 5), (1, 6))
    artists = frame("userId int, artistId bigint", (1, 7), (2, None), (3, 8))
    sets = [(tracks, ("userId", "trackGroup")), (artists, ("userId", "artistId"))]
    found = without_each(df, sets, "userId", 10)
    assert found.schema.simpleString() == "struct<userId:int,artistId:bigint,trackGroup:string>"
    assert rows(found) == rows(df.where("userId IS NULL OR userId = 2").select(*found.columns))
