"""The keyed table against a dictionary."""

import random

import pytest

from mixloom.plans import MixCheckError, publish_keyed
from mixloom.sources.keyed import CommitError, KeyedTable

SCHEMA = "user bigint, tracks array<string>, atDate string"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "mixes"), "user", buckets=4)


def state(df):
    return {r.user: (tuple(r.tracks or ()), r.atDate) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_equal_a_replay(spark, frame, table, seed):
    rng = random.Random(seed)
    now, history = {}, {0: {}}
    for version in range(1, 8):
        users = rng.sample(range(30), rng.randint(1, 12))
        put = {u: ((f"t{version}", str(u)), f"day {version}") for u in users[: rng.randint(1, len(users))]}
        gone = [u for u in users if u not in put]
        rows = frame(SCHEMA, *[(u, list(t), d) for u, (t, d) in put.items()])
        assert table.commit(rows, frame("user bigint", *[(u,) for u in gone]) if gone or version % 2 else None) == version
        now = {u: v for u, v in {**now, **put}.items() if u not in gone}
        history[version] = dict(now)
        if version in (3, 6):
            assert table.compact() == version
            assert table.compact() == version
    for version in range(1, 8):
        assert state(table.read(version)) == history[version]
    assert state(table.read()) == now
    some = rng.sample(range(35), 9)
    assert state(table.get(some)) == {u: v for u, v in now.items() if u in some}
    for since, until in ((0, 2), (1, 7), (3, 5), (6, 7)):
        changed = {r.user: r.change for r in table.changes(since, until).collect()}
        before, after = history[since], history[until]
        for u in set(before) ^ set(after):
            assert changed[u] == ("insert" if u in after else "delete")
        for u in set(before) & set(after):
            assert changed.get(u, "update") == "update" and (u in changed or before[u] == after[u])
        assert set(changed) <= set(before) | set(after)
    assert table.changes(7).collect() == []
    table.expire()
    assert state(table.read()) == now and state(table.get(some)) == {u: v for u, v in now.items() if u in some}
    with pytest.raises(ValueError):
        table.read(5)


def test_bad_commits_leave_the_table_as_it_was(frame, table):
    with pytest.raises(ValueError):
        table.commit()
    with pytest.raises(ValueError):
        table.read()
    table.commit(frame(SCHEMA, (1, ["a"], "d")))
    for rows in ([(2, ["b"], "d"), (2, ["c"], "d")], [(None, ["b"], "d")]):
        with pytest.raises(CommitError):
            table.commit(frame(SCHEMA, *rows))
    with pytest.raises(CommitError):
        table.commit(frame(SCHEMA, (1, ["b"], "d")), frame("user bigint", (1,)))
    assert table.version() == 1 and state(table.read()) == {1: (("a",), "d")}


def test_a_lost_job_leaves_no_version(frame, table, monkeypatch):
    table.commit(frame(SCHEMA, (1, ["a"], "d")))
    failing = frame(SCHEMA, (2, ["b"], "d")).selectExpr("user", "tracks", "raise_error('lost') AS atDate")
    with pytest.raises(Exception, match="lost"):
        table.commit(failing)
    assert table.version() == 1 and state(table.read()) == {1: (("a",), "d")}
    assert table.commit(frame(SCHEMA, (3, ["c"], "d"))) == 2


def test_merging_does_not_shuffle_the_base(spark, frame, table):
    rows = spark.range(5000).selectExpr("id AS user", "array('a', 'b') AS tracks", "'d' AS atDate")
    table.commit(rows)
    table.compact()
    table.commit(frame(SCHEMA, (7, ["z"], "e")))
    merged = table.read()
    assert merged.count() == 5000
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_published_mixes_are_checked_first(frame, table):
    good = frame(SCHEMA, (1, ["a", "b"], "d"), (2, ["a", "b"], "d"))
    assert publish_keyed(good, table, 2, 3) == 1
    with pytest.raises(MixCheckError):
        publish_keyed(frame(SCHEMA, (3, ["a"], "d")), table, 2, 3)
    assert publish_keyed(frame(SCHEMA, (1, ["c", "d"], "e")), table, 2, 3, gone=frame("user bigint", (2,))) == 2
    assert state(table.read()) == {1: (("c", "d"), "e")}
