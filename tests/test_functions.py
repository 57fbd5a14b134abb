from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mixloom.functions import (
    at_date,
    clean_title,
    day_slice_start,
    last_items,
    mix_id,
    months_before,
    ordered_values,
    pick_artists,
    pick_artists_with_cover,
    stable_mix_id,
    updated_millis,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_mix_id_of_user_one(frame):
    row = frame("user int", (1,), (None,)).select(mix_id("discovery_mix_", "user").alias("id")).collect()
    assert [r["id"] for r in row] == ["1f1451b3b417516e9e4b4423958", None]


def test_stable_id_is_head_of_md5(spark):
    assert value(spark, stable_mix_id(F.lit("abc"))) == "900150983cd24fb0d6963f7d28e17f72"[:27]


@pytest.mark.parametrize(
    "title, cleaned",
    [
        ("Blue Bolt", "blue bolt"),
        ("Blue Bolt (Live at Home) [feat. X]", "blue bolt"),
        ("Blue Bolt - Remastered 2011", "blue bolt"),
        ("Don't  Stop!", "dont stop"),
        ("Blå (x) ÉTÉ 99", "blå été 99"),
        ("(only this)", None),
        ("", None),
        (None, None),
        ("a-b", "ab"),
    ],
)
def test_clean_title(spark, title, cleaned):
    assert value(spark, clean_title(F.lit(title).cast("string"))) == cleaned


@pytest.mark.parametrize("n", range(1, 8))
@pytest.mark.parametrize("size", range(6))
def test_last_items(spark, size, n):
    items = list(range(size))
    column = F.lit(items).cast("array<int>") if items else F.array().cast("array<int>")
    assert value(spark, last_items(column, n)) == items[-n:]


def test_last_items_of_null_and_of_none_wanted(spark):
    assert value(spark, last_items(F.lit(None).cast("array<int>"), 2)) is None
    with pytest.raises(ValueError):
        last_items("items", 0)


def test_months_before_keeps_time_and_clamps_day(spark):
    assert value(spark, months_before("2021-03-31 10:20:30", 1)) == datetime(2021, 2, 28, 10, 20, 30)
    assert value(spark, months_before(datetime(2021, 1, 15), 12)) == datetime(2020, 1, 15)


@pytest.mark.parametrize("size", [1, 7, 12])
def test_day_slice_start_of_every_weekday(spark, size):
    week = [f"2019-11-{day:02}" for day in range(4, 11)]
    starts = [value(spark, day_slice_start(day, size)) for day in week]
    assert starts == [1 + n * size for n in range(7)]


def test_timestamps(spark):
    moment = F.lit("2019-11-07 23:05:09.400499").cast("timestamp")
    assert value(spark, at_date(moment)) == "2019-11-07T23:05:09"
    assert value(spark, updated_millis(moment)) == 1573167909400
    assert value(spark, updated_millis(F.lit("2019-11-07 23:05:09.4006").cast("timestamp"))) == 1573167909401


def test_ordered_values_keeps_owner_without_values(frame):
    df = frame("k int, r int, v string", (1, 2, "b"), (1, 1, "c"), (1, 1, "a"), (1, 3, None), (2, 1, None))
    lists = {r["k"]: r["l"] for r in df.groupBy("k").agg(ordered_values("v", ["r"]).alias("l")).collect()}
    assert lists == {1: ["a", "c", "b"], 2: []}


CARDS = "cards array<struct<id int, name string, image string, cover string>>"


def test_pick_artists(frame):
    cards = [
        (1, "a", None, "c"),
        (2, "b", "i", None),
        (1, "a", "i", "c"),
        (2, "b", "j", "c"),
        (3, "c", "", "c"),
        (4, "d", "i", "c"),
        (1, "z", "i", "c"),
    ]
    df = frame(CARDS, (cards,), ([],), (None,))
    picked = [r["p"] for r in df.select(pick_artists("cards", 2).alias("p")).collect()]
    assert [[tuple(c)[:3] for c in picked[0]], picked[1], picked[2]] == [[(2, "b", "i"), (1, "a", "i")], [], None]
    covered = df.select(pick_artists_with_cover("cards", 9).alias("p")).first()["p"]
    assert [tuple(c) for c in covered] == [(1, "a", "i", "c"), (2, "b", "j", "c"), (4, "d", "i", "c")]
