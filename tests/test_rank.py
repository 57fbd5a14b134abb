import random

import pytest
from pyspark.sql import functions as F

from mixloom.operators.rank import diversity_rank, known_quota, split_known_unknown, spread_known_artists, top_n


def test_top_n_breaks_ties_and_takes_limits_per_row(frame, rows):
    df = frame("k int, pos int, t string, n int", (1, 1, "b", 2), (1, 1, "a", 2), (1, 0, "c", 2), (2, 5, "d", 0))
    assert rows(df.transform(top_n(["k"], ["pos", "t"], 2)), "k", "t") == [(1, "a"), (1, "c"), (2, "d")]
    assert rows(df.transform(top_n(["k"], ["pos", "t"], F.col("n"), at_most=2)), "k", "t") == [(1, "a"), (1, "c")]
    ranked = df.transform(top_n(["k"], ["pos", "t"], 9, rank_col="r"))
    assert rows(ranked, "k", "r", "t") == [(1, 1, "c"), (1, 2, "a"), (1, 3, "b"), (2, 1, "d")]


def test_quota_is_truncated():
    assert [known_quota(70, 0.2), known_quota(100, 0.29), known_quota(1, 1.0)] == [14, 28, 1]


FLAGGED = "userId bigint, artistId bigint, trackGroup string, knownArtist int, pos int"


def quota_by_hand(rows, size, share):
    """The quota rule on one user's rows, in plain Python."""
    known_cap = int(share * size)
    unknown_cap = int(size - known_cap)
    known = [r for r in rows if r[3] == 1]
    unknown = [r for r in rows if r[3] == 0]
    n_unknown = sum(r[1] is not None for r in rows) - len(known)
    known_limit = size - n_unknown if unknown_cap > n_unknown else size - unknown_cap
    unknown_limit = size - len(known) if known_cap > len(known) else size - known_cap

    def best(some, n):
        return sorted(some, key=lambda r: (r[4], r[2]))[: max(n, 0)]

    return best(known, known_limit) + best(unknown, unknown_limit)


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
@pytest.mark.parametrize("size", [1, 5, 10])
def test_split_equals_rule(frame, rows, size, share):
    rng = random.Random(size * 10 + int(share * 10))
    data = []
    for user in range(25):
        n_known, n_unknown, n_null = rng.randint(0, 14), rng.randint(0, 14), rng.choice([0, 0, 1, 13])
        flags = [(1, 1)] * n_known + [(0, 1)] * n_unknown + [(0, None)] * n_null
        rng.shuffle(flags)
        for pos, (flag, named) in enumerate(flags):
            data.append((user, named and 1000 + pos, f"t{pos}", flag, pos // 2))
    expected = [r for user in range(25) for r in quota_by_hand([r for r in data if r[0] == user], size, share)]
    out = frame(FLAGGED, *data).transform(split_known_unknown(size, share))
    assert out.columns == ["userId", "artistId", "trackGroup", "knownArtist", "pos"]
    key = lambda r: [(v is not None, v) for v in r]
    assert rows(out) == sorted(expected, key=key)


def test_split_fills_a_shortage_from_the_other_side(frame, rows):
    few_unknown = [(1, i, f"k{i}", 1, i) for i in range(9)] + [(1, 100, "u", 0, 50)]
    few_known = [(2, 1, "k", 1, 99)] + [(2, 10 + i, f"u{i}", 0, i) for i in range(20)]
    out = frame(FLAGGED, *few_unknown, *few_known).transform(split_known_unknown(5, 0.4))
    counts = {(r["userId"], r["knownArtist"]): r["count"] for r in out.groupBy("userId", "knownArtist").count().collect()}
    assert counts == {(1, 1): 4, (1, 0): 1, (2, 1): 1, (2, 0): 4}


PLACED = "userId bigint, pos int, cluster string, artistId bigint, trackGroup string"


def ranked(frame, data, gap):
    out = frame(PLACED, *data).transform(diversity_rank(["cluster"], ["artistId"], gap=gap))
    assert set(out.columns) == {"userId", "pos", "cluster", "artistId", "trackGroup", "rank"}
    return out


def test_diversity_worked_by_hand(frame):
    groups = ["A1", "A2", "B3", "A4", "C5", "B6"]
    data = [(1, o, g[0], int(g[1]), f"t{o}") for o, g in enumerate(groups)]
    out = ranked(frame, data, 2).orderBy("rank").collect()
    assert [r["pos"] for r in out] == [0, 2, 4, 1, 5, 3]
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5, 6]


def diversity_by_hand(data, gap):
    """The definition, row by row."""
    by_pos = sorted(data, key=lambda r: (r[1], r[4]))
    scored = []
    for row in by_pos:
        places, nths = [], []
        for column in (2, 3):
            firsts = {}
            for other in by_pos:
                firsts.setdefault(other[column], other[1])
            places.append(sorted(set(firsts.values())).index(firsts[row[column]]))
            same = [r for r in by_pos if r[column] == row[column]]
            nths.append(same.index(row))
        scored.append((min(places) + gap * max(nths), -row[1], row[4]))
    return [t for _, _, t in sorted(scored)]


@pytest.mark.parametrize("gap", [0, 1, 3])
def test_diversity_equals_definition(frame, gap):
    rng = random.Random(gap)
    users = {}
    for user in range(20):
        users[user] = [
            (user, rng.randint(0, 12), rng.choice(["A", "B", "C", None]), rng.randint(1, 6), f"t{i:02}")
            for i in range(rng.randint(1, 14))
        ]
    out = ranked(frame, [r for data in users.values() for r in data], gap).orderBy("userId", "rank").collect()
    for user, data in users.items():
        assert [r["trackGroup"] for r in out if r["userId"] == user] == diversity_by_hand(data, gap)


RANKED = "userId bigint, trackGroup string, knownArtist int, rank int"


def in_order(df):
    return [r["trackGroup"] for r in df.orderBy("rank", "innerRank", "trackGroup").collect()]


def test_spread_places_known_tracks_evenly(frame):
    data = [(1, f"K{i}", 1, i) for i in (1, 2)] + [(1, f"U{i}", 0, 2 + i) for i in range(1, 9)]
    out = frame(RANKED, *data).transform(spread_known_artists(10))
    assert in_order(out) == ["U1", "U2", "U3", "K1", "U4", "U5", "U6", "U7", "K2", "U8"]
    assert out.where("trackGroup = 'K2'").first()["rank"] == 16


@pytest.mark.parametrize("known", [0, 1])
def test_spread_keeps_the_order_when_all_are_alike(frame, known):
    data = [(1, f"t{9 - i}", known, i) for i in range(10)]
    assert in_order(frame(RANKED, *data).transform(spread_known_artists(10))) == [f"t{9 - i}" for i in range(10)]


@pytest.mark.parametrize("size, known", [(70, 14), (70, 33), (12, 5), (10, 1)])
def test_spread_never_reverses_the_fractional_order(frame, size, known):
    data = [(1, f"t{i:03}", int(i < known), i) for i in range(size)]
    share = known / size
    place = {f"t{i:03}": (i + 1) * (1 - share) if i < known else (i - known + 1) * share for i in range(size)}
    keys = [place[t] for t in in_order(frame(RANKED, *data).transform(spread_known_artists(size)))]
    assert all(later > earlier - 1e-9 for earlier, later in zip(keys, keys[1:]))
