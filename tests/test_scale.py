"""What the plans look like beyond one machine: no broadcasts, and a key that holds a third of the rows."""

import contextlib
import io
import re
from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from mixloom.operators import enrich, exclude, joins, rank, shape
from mixloom.operators.joins import in_tasks, lookup
from mixloom.operators.scoring import decode
from mixloom.plans import DiscoveryTables, discovery_mix, observed_tracks, score_sequences
from mixloom.sources.sinks import save_bucketed
from workload.inputs import AS_OF, SETTINGS, Inputs
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The flagship's inputs as stored tables."""
    tmp_path = tmp_path_factory.mktemp("stored")
    tables = Inputs(spark, SF).discovery
    for field in fields(DiscoveryTables):
        getattr(tables, field.name).write.parquet(f"{tmp_path}/{field.name}")
    return DiscoveryTables(**{f.name: spark.read.parquet(f"{tmp_path}/{f.name}") for f in fields(DiscoveryTables)})


def hot_rows(spark, n=60_000):
    """``n`` rows over 500 keys, of which key 0 holds a third and null some."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 0).when(i % 50 == 1, None).otherwise(i % 500)
    track = F.md5(i.cast("string"))
    return spark.range(0, n, 1, 6).select(key.alias("artistId"), i.alias("userId"), track.alias("trackGroup"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_is_split_although_the_side_is_grouped(spark, no_broadcast, how):
    side = spark.range(0, 2000).groupBy((F.col("id") % 400).alias("artistId")).agg(F.max("id").alias("top"))
    df = hot_rows(spark)
    joined = lookup(df, side, "artistId", how, salts=2)
    total = joined.agg(F.count("*").alias("n"), F.count("top").alias("matched"), F.sum("userId").alias("users"))
    found = len(joined.collect())
    assert "skew=true" in plan_of(joined)
    expected = df.where("artistId < 400").count() if how == "inner" else df.count()
    assert found == expected == total.first()["n"]
    assert total.first()["matched"] == df.where("artistId < 400").count()


def test_repeats_of_a_hot_mix_are_dealt_out(spark, no_broadcast):
    i = F.col("id")
    tracks = F.array(F.lit("a"), F.lit("b"))
    mixes = spark.range(0, 300).select(
        F.concat(F.lit("mix"), "id").alias("mixId"), i.alias("user"), tracks.alias("tracks")
    )
    mix = F.concat(F.lit("mix"), F.when(i % 3 == 0, 0).otherwise(i % 300).cast("string"))
    out = observed_tracks(mixes, spark.range(0, 60_000, 1, 6).select(mix.alias("mixId")))
    counts = {r["user"]: r["count"] for r in out.groupBy("user").count().collect()}
    assert counts[0] == 40_000 and counts[1] == 400 and sum(counts.values()) == 120_000
    assert re.search(r"Exchange hashpartitioning\(mixId#\d+, start#\d+L?, \d+\), REPARTITION_BY_COL", plan_of(out))


def test_groups_are_cut_before_the_shuffle(spark):
    flagged = hot_rows(spark).select("*", F.lit(0).alias("knownArtist"), F.col("userId").cast("int").alias("pos"))
    for df in (
        flagged.transform(rank.top_n(["artistId"], ["pos", "trackGroup"], 2)),
        flagged.withColumn("userId", F.lit(1)).transform(rank.split_known_unknown(10, 0.2)),
    ):
        plan = plan_of(df)
        assert re.search(r"Exchange hashpartitioning.*\n\W*WindowGroupLimit .*Partial", plan)


def test_flagship_shuffles(stored, no_broadcast):
    """Each list once, then the candidates by track and by three kinds of user keys; no Python, no cross join."""
    plan = plan_of(discovery_mix(stored, AS_OF, SETTINGS))
    spine = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    keys = [re.search(r"hashpartitioning\((.*?), \d+\)", line).group(1) for line in spine]
    names = [tuple(re.sub(r"#\d+L?", "", k).split(", ")) for k in keys]
    count = names.count
    assert count(("userId", "trackGroup")) == 2
    assert count(("userId", "cleanedTitle")) == 2
    assert count(("userId", "artistId")) == 2
    assert count(("trackGroup", "_salt")) == 2
    assert count(("userId", "knownArtist", "_nameless")) == 1
    # Users and lists, then the quota's rows, then the clustered rows.
    assert count(("userId",)) == 4
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(stored, no_broadcast):
    keys = exclude.heard_keys(stored.track_history, as_of=AS_OF, min_plays=2, months=12, date_col="dt")
    plan = plan_of(keys)
    assert "PushedFilters: [Or(GreaterThanOrEqual(count,2),GreaterThanOrEqual(dt,2000-08-01T00:00))]" in plan
    assert "ReadSchema: struct<trackGroup:string,userId:bigint,count:bigint,dt:timestamp_ntz>" in plan
    entries = exclude.blacklist_keys(stored.blacklist, "TRACK", stored.observed_tracks, "trackGroup")
    assert "EqualTo(artifactType,TRACK)" in plan_of(entries)


def test_album_counts_share_the_shuffle_of_the_join(spark, no_broadcast, frame):
    history = frame("userId bigint, masterBundleId string, count bigint", (1, "a", 2))
    df = frame("userId bigint, masterBundleId string, pos int", (1, "a", 0))
    assert plan_of(df.transform(exclude.filter_heard_albums(history, 1))).count("Exchange") == 2


def test_shaping_does_not_shuffle(spark, stored):
    assert "Exchange" not in plan_of(stored.recommendations.transform(shape.explode_recommendations()))


def test_bucketed_lists_join_without_a_shuffle(spark, stored, no_broadcast, rows):
    save_bucketed(stored.recommendations, "bucketed_recommendations", "user", 4)
    save_bucketed(stored.users, "bucketed_users", "id", 4)
    lists = spark.table("bucketed_recommendations").withColumnRenamed("user", "userId")
    joined = lists.transform(enrich.with_user_country(spark.table("bucketed_users")))
    assert "Exchange" not in plan_of(joined)
    unbucketed = stored.recommendations.withColumnRenamed("user", "userId").transform(enrich.with_user_country(stored.users))
    assert rows(joined, "userId", "countryCode") == rows(unbucketed, "userId", "countryCode")


def test_hot_last_item_in_scoring(spark, no_broadcast):
    i = F.col("id")
    last = F.when(i % 3 == 0, 1).otherwise(i % 100 + 2).cast("int")
    sequences = spark.range(0, 6000, 1, 6).select(i.alias("user"), F.array((i % 7 + 1).cast("int"), last).alias("items"))
    vocabulary = spark.range(1, 102).select(F.concat(F.lit("v"), "id").alias("item"), i.cast("int").alias("index"))
    out = score_sequences(sequences, vocabulary, n_recs=5)
    assert out.count() == 6000
    assert out.select(F.max(F.size("recommendations"))).first()[0] == 5


def test_vocabulary_is_joined_as_the_session_allows(spark, no_broadcast, frame):
    vocabulary = frame("item string, index int", ("a", 1), ("b", 2)).distinct()
    lists = frame("user bigint, recommendations array<int>", (1, [2, 9, 1]), (2, [3]))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    out = lists.transform(decode(vocabulary))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
    assert "SortMergeJoin" in plan_of(out) and "Broadcast" not in plan_of(out)


def test_hot_artist_in_the_compounds_is_split(spark, no_broadcast, frame):
    i = F.col("id")
    artist = F.when(i % 3 == 0, 0).otherwise(i % 400)
    entries = spark.range(0, 60_000, 1, 6).select(
        F.md5(i.cast("string")).alias("userId"), F.lit("ARTIST").alias("artifactType"), artist.cast("string").alias("artifactId")
    )
    members = spark.range(0, 400).select(i.alias("artistCompoundId"), (i + 1000).alias("artistId"))
    keys = exclude.blacklisted_artist_keys(entries, members, frame("userId string, artistId bigint"))
    found = {r["artistId"]: r["count"] for r in keys.groupBy("artistId").count().collect()}
    assert found[0] == found[1000] >= 20_000 and sum(found.values()) == 120_000
    assert len(keys.collect()) == 120_000 and "skew=true" in plan_of(keys)


def test_lists_of_usual_mixes_are_not_shuffled_again(spark, no_broadcast, frame):
    mixes = frame("user int, tracks array<string>, mixId string, atDate string", (1, ["a"], "m", "d"))
    plan = plan_of(observed_tracks(mixes, frame("mixId string", ("m",))), "extended").split("== Physical Plan ==")[1]
    first, further = plan[plan.index("Union") :].split("REPARTITION_BY_COL")
    # Above the join the one shuffle is that of mixes with further repeats.
    assert "Exchange" not in first.split("SortMergeJoin")[0] and "times" in further


def test_lookup_of_rows_with_maps(frame, rows):
    df = frame("k bigint, m map<string,int>, a array<map<string,int>>", (1, {"x": 1}, []), (2, None, None))
    assert rows(lookup(df, frame("k bigint, w string", (1, "one")), "k").select("k", "w")) == [(1, "one")]


@pytest.mark.parametrize("query", ["recs_with_country", "available_in_country", "recs_with_metadata", "filter_heard_albums", "mix_sketch"])
def test_lists_and_the_catalogue_are_not_broadcast(spark, query):
    """Estimates count compressed files and one element per list; what is broadcast here are nations and users."""
    plan = plan_of(QUERIES[query](Inputs(spark, SF)))
    built = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert not [line for line in built if re.search("trackGroup|bucket|userId.*BuildLeft", line)]


def test_repeats_of_a_side_count_in_its_size(spark, frame):
    side = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    size = lambda df: df._jdf.queryExecution().optimizedPlan().children().last().stats().sizeInBytes()
    df = frame("k bigint, w string", (1, "one"))
    assert size(lookup(df, side, "k", "left", salts=8)) >= 8 * 16_000
    assert "SortMergeJoin" in plan_of(lookup(df, side, "k", large=True)) and "SortMergeJoin" in plan_of(
        lookup(df.select("k"), side, "k", large=True)
    )
    assert "BroadcastHashJoin" in plan_of(lookup(df, side, "k"))


@pytest.mark.parametrize("query", ["daily_mix", "current_mixes"])
def test_candidates_of_stored_mixes_move_to_the_catalogue_and_back_to_their_user(spark, no_broadcast, query):
    plan = plan_of(QUERIES[query](Inputs(spark, SF)))
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    # Twice by track: candidates and catalogue. The one by user and track is that of the plays, before they are counted.
    assert keys.count("trackGroup, _salt") == 2 and keys.count("userId, artistId") == 0
    assert keys.count("userId") == 1 and sum(k.startswith("userId, ") for k in keys) == 1


def test_candidates_are_not_sorted_by_track(spark, no_broadcast, frame, rows):
    """The catalogue is hashed after the shuffle: what a task holds does not grow with the candidates."""
    tracks = frame(
        "trackGroup string, id bigint, title string, mainArtistsIds array<bigint>",
        ("a", 2, "later", [8]), ("a", 1, "first", [7, 8]), ("b", 3, "bare", []), (None, 4, "none", [9]),
    )
    df = frame("userId bigint, trackGroup string, pos int", (1, "a", 0), (1, "a", 0), (2, "b", 1), (3, "z", 2), (4, None, 3))
    joined = df.transform(enrich.with_track_metadata(tracks))
    plan = plan_of(joined)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    found = [(1, "a", 0, 7, "first"), (1, "a", 0, 7, "first"), (2, "b", 1, None, "bare")]
    assert rows(joined, "userId", "trackGroup", "pos", "artistId", "title") == found


def test_hot_track_is_split_with_a_hashed_side(spark, no_broadcast):
    side = spark.range(0, 2000).groupBy((F.col("id") % 400).alias("artistId")).agg(F.max("id").alias("top"))
    joined = lookup(hot_rows(spark), side, "artistId", salts=2, hashed=True)
    assert len(joined.collect()) == hot_rows(spark).where("artistId < 400").count()
    assert "ShuffledHashJoin(skew=true)" in plan_of(joined) or re.search(r"ShuffledHashJoin.*skew=true", plan_of(joined))


def test_candidates_are_not_sorted_for_few_keys(spark, no_broadcast, frame, rows):
    df = frame("userId bigint, trackGroup string", (1, "a"), (1, "b"), (1, "b"), (2, "a"), (None, "a"), (1, None))
    saved = frame("userId bigint, trackGroup string", (1, "a"), (1, "a"), (None, "a"), (1, None))
    left = df.transform(exclude.filter_heard(saved, min_plays=0, months=0, few=True))
    assert "ShuffledHashJoin" in plan_of(left) and "SortMergeJoin" not in plan_of(left)
    assert rows(left) == [(None, "a"), (1, None), (1, "b"), (1, "b"), (2, "a")]
    plan = plan_of(QUERIES["filter_favourite_tracks"](Inputs(spark, SF)))
    assert re.search(r"ShuffledHashJoin \[userId#\d+L?, trackGroup#\d+\].*LeftAnti", plan)


def test_tasks_of_many_rows_are_cut(spark, monkeypatch):
    df = spark.range(100).select((F.col("id") % 9).alias("userId"), "id")
    assert "Exchange" not in plan_of(in_tasks(df, 100, "userId"))
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 10)
    cut = in_tasks(df, 100, "userId")
    assert re.search(r"Exchange hashpartitioning\(userId#\d+L?, 10\), REPARTITION_BY_NUM", plan_of(cut))
    assert cut.agg(F.sum("id")).first()[0] == 4950


def test_best_of_an_artist_are_chosen_in_tasks_by_the_number_of_candidates(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 1_000)
    plan = plan_of(QUERIES["top_track_per_artist"](Inputs(spark, SF)))
    sides = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?)\)", plan)]
    # In tasks for the number of candidates.
    assert "userId, artistId, 30" in sides


def moved(df):
    """Names of the columns of each shuffle of the plan before it is run."""
    found = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.initialPlan())
        if node.nodeName() == "Exchange":
            output = node.output()
            found.append({output.apply(n).name() for n in range(output.size())})
        children = node.children()
        for n in range(children.size()):
            walk(children.apply(n))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_candidates_of_a_user_get_one_salt(spark, no_broadcast):
    inputs = Inputs(spark, SF)
    for joined in (QUERIES["recs_with_metadata"](inputs), discovery_mix(inputs.discovery, AS_OF, SETTINGS)):
        assert re.search(r"pmod\(xxhash64\(userId#\w+, 42\), 4\)", plan_of(joined, "formatted"))


@pytest.mark.parametrize("name, moves", [("filter_blacklist_all", 2), ("filter_heard_albums", 2), ("filter_heard_titles", 2), ("filter_heard_near_titles", 2)])
def test_candidates_move_to_the_catalogue_and_to_their_user(spark, no_broadcast, name, moves):
    found = [columns for columns in moved(QUERIES[name](Inputs(spark, SF))) if "pos" in columns]
    assert len(found) == moves and not any("cleanedTitle" in columns for columns in found)


def test_discovery_candidates_are_dealt_by_user_with_short_names_of_titles(spark, no_broadcast):
    found = [columns for columns in moved(QUERIES["discovery_mix"](Inputs(spark, SF))) if "pos" in columns]
    assert any("titleId" in columns for columns in found) and not any("cleanedTitle" in columns for columns in found)


def test_plays_move_to_stored_mixes_without_titles(spark, no_broadcast):
    assert "cleanedTitle" not in plan_of(Inputs(spark, SF).mixes, "extended").split("== Optimized")[1]
    assert not any("o_orderdate" in columns for columns in moved(Inputs(spark, SF).mixes))


@pytest.mark.parametrize("name", ["filter_observed_tracks", "observed_tracks"])
def test_candidates_dealt_by_user_take_as_many_tasks_as_they_need(spark, monkeypatch, name):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 2_000)
    inputs = Inputs(spark, SF)
    assert inputs.n_candidates == 30_000
    assert re.search(r"hashpartitioning\(userId#\w+, 15\), REPARTITION_BY_NUM", plan_of(QUERIES[name](inputs)))
