from mixloom.operators.assemble import assemble_artist_mix, assemble_discovery_mix

ROWS = "userId bigint, trackGroup bigint, rank bigint, innerRank int"


def test_discovery_mix(frame):
    df = frame(ROWS, (1, 7, 5, 1), (1, 8, 5, 0), (1, 9, 1, 9), (1, None, 0, 0), (2, 7, 1, 1))
    out = df.transform(assemble_discovery_mix("2020-06-01", min_mix_size=2))
    assert out.dtypes == [("user", "int"), ("tracks", "array<string>"), ("mixId", "string"), ("atDate", "string")]
    assert [tuple(r) for r in out.collect()] == [(1, ["9", "8", "7"], "1f1451b3b417516e9e4b4423958", "2020-06-01")]


def test_equal_ranks_go_by_track_group(frame):
    df = frame(ROWS, *[(1, t, 0, 0) for t in (3, 1, 2)])
    assert df.transform(assemble_discovery_mix("d", min_mix_size=0)).first()["tracks"] == ["1", "2", "3"]


def test_artist_mix_has_no_minimum(frame):
    df = frame("artistId bigint, trackGroup string, rank int", (5, "b", 2), (5, "a", 3), (5, "c", 1), (6, "z", 1))
    out = df.transform(assemble_artist_mix("2020-06-01"))
    assert out.dtypes == [("artistId", "int"), ("tracks", "array<string>"), ("mixId", "string"), ("atDate", "string")]
    found = {r["artistId"]: (r["tracks"], r["mixId"]) for r in out.collect()}
    assert found[5][0] == ["c", "b", "a"] and found[6][0] == ["z"]
    assert found[5][1] != found[6][1] and len(found[5][1]) == 27


def test_artist_mix_of_a_size(frame):
    df = frame("artistId bigint, trackGroup bigint, rank int", (5, 9, 1), (5, 10, 1), (5, None, 0), (5, 3, 2), (6, 4, 7))
    out = df.transform(assemble_artist_mix("2020-06-01", size=2))
    assert {r["artistId"]: r["tracks"] for r in out.collect()} == {5: ["10", "9"], 6: ["4"]}
    whole = df.transform(assemble_artist_mix("2020-06-01"))
    assert {r["artistId"]: r["tracks"] for r in whole.collect()} == {5: ["10", "9", "3"], 6: ["4"]}
