"""The stream of observations against the batch job."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from mixloom.plans import observed_tracks
from mixloom.streaming import DELIVERIES, read_observed, stream_observed

MIXES = [(u, [f"t{u}{k}" for k in range(u % 4)], f"m{u}", "2022-05-02") for u in range(9)] + [(8, ["late"], "m8", "2022-05-09")]
SCHEMA = "user int, tracks array<string>, mixId string, atDate string"


def deliveries(rng):
    start = datetime(2022, 5, 3)
    rows = [(f"d{n}", f"m{rng.randrange(12)}", start + timedelta(minutes=rng.randrange(3000))) for n in range(60)]
    return rows + [rng.choice(rows) for _ in range(40)] + [("none", None, start)]


def run(spark, path, mixes, n=2, **options):
    paths = str(path / "in"), mixes, str(path / "out"), str(path / "state")
    query = stream_observed(spark, *paths, max_files=n, **options)
    query.awaitTermination()
    assert query.exception() is None
    return query


@pytest.mark.parametrize("seed, starts", [(1, 1), (2, 3)])
def test_stream_equals_the_batch_job_over_any_split(spark, frame, tmp_path, seed, starts):
    rng = random.Random(seed)
    rows = deliveries(rng)
    rng.shuffle(rows)
    mixes = frame(SCHEMA, *MIXES[:-1])
    cuts = sorted(rng.sample(range(1, len(rows)), 5))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    for n in range(starts):
        for part in parts[n::starts]:
            frame(DELIVERIES, *part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run(spark, tmp_path, mixes)
    once = {r[0]: r for r in rows}
    expected = observed_tracks(mixes, frame(DELIVERIES, *once.values()).select("mixId"))
    got = read_observed(spark, str(tmp_path / "out"))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect())) and got.count()
    run(spark, tmp_path, mixes)
    assert read_observed(spark, str(tmp_path / "out")).count() == expected.count()


def test_current_mixes_and_late_deliveries(spark, frame, tmp_path):
    mixes = frame(SCHEMA, *MIXES)
    first = [("a", "m8", datetime(2022, 5, 10)), ("a", "m8", datetime(2022, 5, 10))]
    frame(DELIVERIES, *first).write.parquet(str(tmp_path / "in"))
    run(spark, tmp_path, mixes, delay="1 day", as_of="2022-05-10")
    assert [tuple(r) for r in read_observed(spark, str(tmp_path / "out")).collect()] == [(8, "late")]
    frame(DELIVERIES, ("b", "m8", datetime(2022, 5, 1))).write.mode("append").parquet(str(tmp_path / "in"))
    query = run(spark, tmp_path, mixes, delay="1 day", as_of="2022-05-10")
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 1 and read_observed(spark, str(tmp_path / "out")).count() == 1
