import pytest

from mixloom.operators.shape import (
    daily_slice,
    explode_positions,
    explode_recommendations,
    explode_tracks,
    long_enough,
    stamp_updated,
)


def test_explode_keeps_other_columns_and_drops_empty_lists(frame, rows):
    df = frame("track array<string>, trackGroup string", (["a", "b"], "g"), ([], "h"), (None, "i"), ([None], "j"))
    out = df.transform(explode_positions("track", "name"))
    assert set(out.columns) == {"trackGroup", "pos", "name"}
    assert rows(out, "trackGroup", "pos", "name") == [("g", 0, "a"), ("g", 1, "b"), ("j", 0, None)]


def test_explode_with_mapping_copies_columns(frame, rows):
    df = frame("id int, l array<string>", (1, ["a", "b"]))
    out = df.transform(explode_positions("l", {"col": "item", "pos": "place"}))
    assert set(out.columns) == {"id", "pos", "item", "place"}
    assert rows(out, "item", "place", "pos") == [("a", 0, 0), ("b", 1, 1)]


def test_explode_map(frame, rows):
    df = frame("id int, m map<string,string>", (1, {"x": "y"}), (2, None))
    assert rows(df.transform(explode_positions("m")), "id", "pos", "key", "value") == [(1, 0, "x", "y")]
    copied = df.transform(explode_positions("m", {"key": "k"}))
    assert rows(copied, "k", "key", "value") == [("x", "x", "y")]


def test_explode_recommendations(frame, rows):
    df = frame("user bigint, recommendations array<string>", (71, ["low", "high", "low"]))
    out = df.transform(explode_recommendations())
    assert rows(out, "userId", "trackGroup", "pos") == [(71, "high", 1), (71, "low", 0), (71, "low", 2)]


def test_explode_keeps_the_callers_columns(frame, rows):
    df = frame("col string, m map<string,int>", ("mine", {"x": 7}))
    out = df.transform(explode_positions("m", {"key": "name", "value": "n"}))
    assert rows(out, "col", "name", "n", "key", "value") == [("mine", "x", 7, "x", 7)]
    with pytest.raises(ValueError, match="already has"):
        frame("pos int, a array<int>", (1, [2])).transform(explode_positions("a"))


def test_daily_slice_by_weekday(frame):
    week = {"2023-05-01": ["m", "n"], "2023-05-03": ["q", "r"], "2023-05-06": ["w"], "2023-05-07": []}
    df = frame("user bigint, tracks array<string>", (802, list("mnopqrstuvw")))
    for day, part in week.items():
        assert df.transform(daily_slice(day, 2)).first()["tracks"] == part


def test_slice_past_the_end_and_minimum(frame, rows):
    df = frame("user bigint, tracks array<int>", (1, list(range(9))), (2, list(range(4))), (3, None))
    sliced = df.transform(daily_slice("2019-11-05", 4))
    assert rows(sliced, "user", "tracks") == [(1, [4, 5, 6, 7]), (2, []), (3, None)]
    assert rows(sliced.transform(long_enough(4)), "user") == [(1,)]
    assert rows(sliced.transform(long_enough(2)), "user") == [(1,), (2,)]


def test_explode_tracks_keeps_repeats(frame, rows):
    df = frame("user int, tracks array<string>, mixId string", (1, ["a", "a"], "m"), (2, [], "n"))
    assert rows(df.transform(explode_tracks)) == [(1, "a"), (1, "a")]


def test_stamp(frame):
    assert frame("a int", (1,)).transform(stamp_updated("2019-11-07 23:05:09+00:00")).first()["updated"] == 1573167909000
