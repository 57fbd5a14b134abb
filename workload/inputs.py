"""The library's input tables, derived from the given tables.

Parts act as track groups, ``p_partkey % 40`` as artists, customers as users, order lines as plays
and the events' numbers as sequence items. ``workload.sql`` states the same tables in SQL.
"""

import tempfile
from dataclasses import fields, replace
from functools import cached_property
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixloom.functions import clean_title, mix_id, ordered_values
from mixloom.functions.ids import DISCOVERY_PREFIX
from mixloom.operators.assemble import assemble_discovery_mix
from mixloom.operators.enrich import track_group_metadata, with_track_metadata
from mixloom.operators.exclude import TRACK_KEY, heard_keys
from mixloom.operators.joins import lookup, without_at
from mixloom.operators.rank import top_n
from mixloom.operators.shape import explode_recommendations
from mixloom.plans import DiscoverySettings, DiscoveryTables, observed_tracks
from mixloom.sources.keyed import KeyedTable
from mixloom.sources.tables import read_vocabulary

# The last order date of the data.
AS_OF = "2001-08-01"
# A Sunday, on which mixes of fewer than 68 tracks have no daily part any more.
DAILY_DATE = "2001-08-05"
# Run days of a back-fill: eight weeks up to the last one.
BACKFILL = ["2001-06-13", "2001-06-20", "2001-06-27", "2001-07-04", "2001-07-11", "2001-07-18", "2001-07-25", "2001-08-01"]
RUN_AT = "2001-08-05 04:05:06+00:00"
SETTINGS = DiscoverySettings(mix_size=35, min_mix_size=34)
ARTISTS = 40
LIST_SIZE = 200


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def whole(column: Column | str, by: int) -> Column:
    """Whole part of a division of a non-negative number."""
    return F.floor((F.col(column) if isinstance(column, str) else column) / by).cast("bigint")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; a temporary one, for tests, only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="workload-")
    return f"{folder.rstrip('/')}/{name}-{uuid4().hex}"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One of the given tables; its footer is read once."""
        if name not in self.tables:
            self.tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.tables[name]

    # Catalogue

    @cached_property
    def tracks(self) -> DataFrame:
        """One track per part, and a second one, with a higher id and other values, for every fifth."""
        part = self.table("part").select("p_partkey", "p_name")
        key = F.col("p_partkey")
        artist = key % ARTISTS
        suffix = (
            F.when(key % 4 == 1, " (Live)")
            .when(key % 4 == 2, " - Remastered 2011")
            .when(key % 4 == 3, " [feat. X]")
            .otherwise("")
        )
        first = F.struct(
            (key * 2).alias("id"),
            F.concat("p_name", suffix).alias("title"),
            F.array(artist).alias("mainArtistsIds"),
        )
        second = F.struct(
            (key * 2 + 1).alias("id"),
            F.concat(F.lit("another "), "p_name").alias("title"),
            F.array((key + 1) % ARTISTS, artist).alias("mainArtistsIds"),
        )
        versions = F.when(key % 5 == 0, F.array(second, first)).otherwise(F.array(first))
        return part.select(
            text(key).alias("trackGroup"),
            text(whole(key, 8)).alias("masterBundleId"),
            key.alias("videoId"),
            F.inline(versions),
        )

    @cached_property
    def track_groups(self) -> DataFrame:
        """Nations in which a track is available: two thirds of them."""
        nation = F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
        nations = self.table("nation").agg(F.sort_array(F.collect_list(nation))).scalar()
        open_to = F.filter(F.col("nations"), lambda n: (F.col("p_partkey") + n["key"]) % 3 != 0)
        return (
            self.table("part")
            .select("p_partkey", nations.alias("nations"))
            .select(
                text("p_partkey").alias("trackGroup"),
                F.transform(open_to, lambda n: n["name"]).alias("AvailableCountryCodes"),
            )
        )

    @cached_property
    def artist_ids(self) -> DataFrame:
        return self.table("part").select((F.col("p_partkey") % ARTISTS).alias("artistId")).distinct()

    @cached_property
    def artists(self) -> DataFrame:
        """Names are those of nations, of which there are fewer than artists; some have no picture."""
        a = F.col("n_nationkey")
        return self.table("nation").select(
            a.alias("id"),
            F.col("n_name").alias("name"),
            F.when(a % 5 != 0, F.concat(F.lit("picture-"), text(a))).alias("picture"),
        )

    @cached_property
    def clusters(self) -> DataFrame:
        """Nations' regions; the artists beyond them have no cluster."""
        return self.table("nation").select(F.col("n_nationkey").alias("artistId"), F.col("n_regionkey").alias("cluster"))

    @cached_property
    def similar_artists(self) -> DataFrame:
        near = F.array(*[(F.col("n_nationkey") + step) % ARTISTS for step in (1, 3, 7, 12)])
        return self.table("nation").select(F.col("n_nationkey").alias("artistId"), near.alias("neighbours"))

    @cached_property
    def compounds(self) -> DataFrame:
        """Artists from 32 on are compounds: two main constituents and one other, of lowest priority."""
        a = F.col("artistId")

        def member(offset: int, priority: int, main: bool) -> Column:
            return F.struct(
                ((a - offset) % 32).alias("artistCompoundId"),
                F.lit(priority).cast("bigint").alias("priority"),
                F.lit(main).alias("mainArtist"),
            )

        members = F.array(member(31, 2, True), member(32, 1, True), member(30, 0, False))
        return self.artist_ids.where("artistId >= 32").select("artistId", F.inline(members))

    @cached_property
    def nested_compounds(self) -> DataFrame:
        """Parts as artists, of which most are compounds of a half and a third of their own number, which may be compounds too: chains
        and diamonds. Every fiftieth and the one after it are compounds of each other: cycles."""
        a = F.col("p_partkey")

        def member(other: Column, priority: int) -> Column:
            return F.struct(
                a.alias("artistId"),
                other.cast("bigint").alias("artistCompoundId"),
                F.lit(priority).cast("bigint").alias("priority"),
                F.lit(True).alias("mainArtist"),
            )

        members = F.array(
            F.when((a > 3) & (a % 4 != 1), member(whole("p_partkey", 2), 1)),
            F.when((a > 3) & (a % 4 != 1), member(whole("p_partkey", 3), 2)),
            F.when(a % 50 == 0, member(a + 1, 0)),
            F.when(a % 50 == 1, member(a - 1, 0)),
        )
        return self.table("part").select(F.inline(F.array_compact(members)))

    # Users

    @cached_property
    def users(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name")
        customer = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("id"),
            F.col("n_name").alias("countryCode"),
            F.col("c_mktsegment").alias("segment"),
        )

    @cached_property
    def recommendations(self) -> DataFrame:
        return self.lists_of(self.table("customer"))

    def lists_of(self, customers: DataFrame) -> DataFrame:
        """Some 200 parts per user, the same ones for the users of one bucket, in an order of the user's own.

        Runs of as many parts as there are artists are dealt to the buckets in turn, so each part is in one whatever
        its key. A bucket's parts, which are about as many as a list has, are one array that its users' rows join. Then users are dealt to tasks, because the table may be one file; with their arrays they
        are too large for AQE to put them into fewer tasks than there are cores. Each row orders its own array.

        Spark's estimate counts one element per array. Joined by the distinct bucket alone, lists would have an estimate of a few
        bytes per user, for which later joins would broadcast them; the salted join has none that is too low, and is merged.
        """
        buckets = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / LIST_SIZE))
        n_buckets = self.table("part").agg(buckets).scalar()
        bucket = (whole("p_partkey", ARTISTS) % n_buckets).alias("bucket")
        parts = self.table("part").groupBy(bucket).agg(F.collect_list("p_partkey").alias("parts"))
        customer = customers.select(F.col("c_custkey").alias("user"))
        dealt = lookup(customer.withColumn("bucket", F.col("user") % n_buckets), parts, "bucket", large=True).repartition("user")
        order = lambda part: ((part + 1) * (F.col("user") + 17) % 100003).alias("order")
        entries = F.transform("parts", lambda part: F.struct(order(part), text(part).alias("trackGroup")))
        lists = F.transform(F.sort_array(entries), lambda entry: entry["trackGroup"])
        # Through a row of its own, or a filter on the list's size would be pushed into the join and order it twice.
        return dealt.select("user", F.explode(F.array(lists)).alias("recommendations"))

    @cached_property
    def n_candidates(self) -> int:
        """About how many candidates the lists hold, for the number of tasks."""
        return self.table("customer").count() * LIST_SIZE

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with the user, as plays."""
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"), "l_quantity", "l_returnflag"
        )
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("userId"), "o_orderdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def track_history(self) -> DataFrame:
        plays = self.lines.groupBy("userId", text("part").alias("trackGroup")).agg(
            F.count(F.lit(1)).alias("count"), F.max("o_orderdate").alias("dt")
        )
        titles = track_group_metadata(self.tracks).select("trackGroup", clean_title("title").alias("cleanedTitle"))
        return plays.join(titles.hint("merge"), "trackGroup")

    @cached_property
    def artist_history(self) -> DataFrame:
        return self.lines.groupBy("userId", (F.col("part") % ARTISTS).alias("artistId")).agg(
            F.count(F.lit(1)).alias("count"), F.max("o_orderdate").alias("dt")
        )

    @cached_property
    def track_plays(self) -> DataFrame:
        """One row per play."""
        return self.lines.select("userId", text("part").alias("trackGroup"), F.col("o_orderdate").alias("playedAt"))

    @cached_property
    def album_history(self) -> DataFrame:
        """Plays per track of an album."""
        return self.lines.groupBy("userId", "part").agg(F.count(F.lit(1)).alias("count")).select(
            "userId", text(whole("part", 8)).alias("masterBundleId"), "count"
        )

    @cached_property
    def favourite_tracks(self) -> DataFrame:
        return self.lines.where("l_quantity = 50").select("userId", text("part").alias("trackGroup"))

    @cached_property
    def favourite_artists(self) -> DataFrame:
        return self.lines.where("l_quantity >= 49").select("userId", (F.col("part") % ARTISTS).alias("artistId"))

    @cached_property
    def blacklist(self) -> DataFrame:
        """Ids as text; some artist ids are malformed."""
        kind = (
            F.when(F.col("l_returnflag") == "R", "TRACK")
            .when((F.col("l_returnflag") == "A") & (F.col("l_quantity") == 1), "ARTIST")
            .when((F.col("l_returnflag") == "N") & (F.col("l_quantity") == 2), "VIDEO")
        )
        artifact = (
            F.when((kind == "ARTIST") & (F.col("l_linenumber") == 7), F.concat(F.lit("artist-"), text("part")))
            .when(kind == "ARTIST", text(F.col("part") % ARTISTS))
            .otherwise(text("part"))
        )
        entries = self.lines.select(
            text("userId").alias("userId"), kind.alias("artifactType"), artifact.alias("artifactId")
        )
        return entries.where(F.col("artifactType").isNotNull())

    # Stored mixes and sequences

    @cached_property
    def mixes(self) -> DataFrame:
        return self.mixes_of(self.recommendations)

    def mixes_of(self, recommendations: DataFrame) -> DataFrame:
        """Stored mixes: of the tracks that a user never played, the best two of each artist.

        Candidates move twice only: to the catalogue, and to their user, where played ones go, the best are chosen and lists are made.
        Plays go there without their titles: which of them have one makes no difference to candidates that the catalogue has.
        """
        described = recommendations.transform(explode_recommendations()).transform(with_track_metadata(self.tracks))
        played = heard_keys(self.lines.select("userId", text("part").alias("trackGroup")).distinct(), min_plays=0, months=0)
        unheard = without_at(described.select("userId", "trackGroup", "pos", "artistId"), played, TRACK_KEY, "userId", self.n_candidates)
        best = unheard.transform(top_n(["userId", "artistId"], ["pos", "trackGroup"], 2))
        return best.transform(assemble_discovery_mix(AS_OF, order_by=["pos"], min_mix_size=1))

    @cached_property
    def mixes_of_two_weeks(self) -> DataFrame:
        """The stored mixes, and those of the week before with the tracks the other way round; a mix is made once for both."""
        earlier = F.date_sub(F.lit(AS_OF).cast("date"), 7).cast("string")
        weeks = F.array(F.struct("tracks", "atDate"), F.struct(F.reverse("tracks").alias("tracks"), earlier.alias("atDate")))
        return self.mixes.select("user", "mixId", F.inline(weeks)).select(*self.mixes.columns)

    @cached_property
    def mix_table(self) -> KeyedTable:
        """Mixes by user in four versions: all of the week before, two thirds of this week's, corrections and users that left, and
        half of those coming back."""
        path = scratch(self.spark, "mixes")
        self.mixes.write.parquet(path)
        mixes = self.spark.read.schema(self.mixes.schema).parquet(path)
        user = F.col("user")
        earlier = {"tracks": F.reverse("tracks"), "atDate": F.date_sub(F.lit(AS_OF).cast("date"), 7).cast("string")}
        table = KeyedTable(self.spark, scratch(self.spark, "mix-table"), "user", buckets=16)
        table.commit(mixes.withColumns(earlier))
        table.commit(mixes.where(user % 3 != 0))
        corrected = mixes.where((user % 10 == 0) & (user % 7 != 3)).withColumn("tracks", F.slice("tracks", 1, 40))
        table.commit(corrected, mixes.where(user % 7 == 3).select("user"))
        table.commit(mixes.where(user % 14 == 3))
        return table

    @cached_property
    def observed_mixes(self) -> DataFrame:
        """Mixes that a third of the users opened, some of them twice."""
        opened = self.table("customer").select(F.col("c_custkey").alias("user")).where("user % 3 = 0")
        times = F.when(F.col("user") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return opened.select(mix_id(DISCOVERY_PREFIX, "user").alias("mixId"), F.explode(times).alias("time")).drop(
            "time"
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        """The observations as deliveries in one day; every second one of them is delivered again."""
        user = F.col("c_custkey")
        opened = self.table("customer").select(user.alias("user")).where("user % 3 = 0")
        times = F.when(F.col("user") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        observed = opened.select("user", F.explode(times).alias("time"))
        copies = F.explode(F.when(F.col("user") % 4 < 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
        return observed.select("user", "time", copies).select(
            F.concat_ws("-", "user", "time").alias("deliveryId"),
            mix_id(DISCOVERY_PREFIX, "user").alias("mixId"),
            F.timestamp_seconds(F.lit(996_969_600) + F.col("user") % 80_000).alias("observedAt"),
            "copy",
        )

    @cached_property
    def observed_tracks(self) -> DataFrame:
        """Tracks of the mixes that were opened; only those are made, as a mix's id tells its user."""
        opened = self.observed_mixes.select("mixId").distinct()
        customers = self.table("customer").withColumn("mixId", mix_id(DISCOVERY_PREFIX, "c_custkey"))
        mixes = self.mixes_of(self.lists_of(customers.join(opened, "mixId", "left_semi")))
        seen = observed_tracks(mixes, self.observed_mixes)
        return seen.select(F.col("user").cast("bigint").alias("userId"), "trackGroup")

    @cached_property
    def artist_cards(self) -> DataFrame:
        """Cards of the artists of a user's recommendations; some lack the image or the cover."""

        def card(track: Column) -> Column:
            a = track.cast("int") % ARTISTS
            image = F.when(a % 7 == 0, "").when(a % 5 != 0, F.concat(F.lit("image-"), text(a)))
            cover = F.when(a % 3 != 0, F.concat(F.lit("cover-"), text(a)))
            name = F.concat(F.lit("Artist "), text(a))
            return F.struct(a.alias("id"), name.alias("name"), image.alias("image"), cover.alias("cover"))

        cards = F.transform("recommendations", card)
        return self.recommendations.select(F.col("user").alias("userId"), cards.alias("cards"))

    @cached_property
    def plays(self) -> DataFrame:
        """Events as ``user, ts, event_id, index``; index 0 stays free for padding."""
        number = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").select(
            F.col("user_id").alias("user"), "ts", "event_id", (number + 1).alias("index")
        )

    @cached_property
    def sequences(self) -> DataFrame:
        """Each user's events in order of time."""
        return self.plays.groupBy("user").agg(ordered_values("index", ["ts", "event_id"]).alias("items"))

    @cached_property
    def vocabulary(self) -> DataFrame:
        """Suppliers' names by key, which some of the events' numbers are not."""
        return self.table("supplier").select(F.col("s_name").alias("item"), F.col("s_suppkey").cast("int").alias("index"))

    @cached_property
    def stored_vocabulary(self) -> DataFrame:
        """The vocabulary as it is stored with a model."""
        model = scratch(self.spark, "model")
        self.vocabulary.write.parquet(f"{model}/vocabulary")
        return read_vocabulary(self.spark, model)

    @cached_property
    def discovery(self) -> DiscoveryTables:
        return DiscoveryTables(
            recommendations=self.recommendations,
            users=self.users,
            tracks=self.tracks,
            track_groups=self.track_groups,
            blacklist=self.blacklist,
            compounds=self.compounds,
            observed_tracks=self.observed_tracks,
            track_history=self.track_history,
            favourite_tracks=self.favourite_tracks,
            artist_history=self.artist_history,
            favourite_artists=self.favourite_artists,
            clusters=self.clusters,
        )

    @cached_property
    def stored_discovery(self) -> DiscoveryTables:
        """The same inputs, written once: two runs read them. Plays are joined once for all tables made of them."""
        plays = self.lines.select("userId", "part", "o_orderdate", "l_linenumber", "l_quantity", "l_returnflag")
        apart = Inputs(self.spark, self.sf_dir)
        apart.lines = self.stored(plays, "lines")
        apart.track_history = self.stored(apart.track_history, "track_history")
        names = [f.name for f in fields(DiscoveryTables) if f.name != "track_history"]
        tables = {name: self.stored(getattr(apart.discovery, name), name) for name in names}
        return DiscoveryTables(track_history=apart.track_history, **tables)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def discovery_before(self) -> DiscoveryTables:
        """Inputs of the run before: of some users each, one track, one availability and one compound they were others."""
        now = self.stored_discovery
        user = lambda every, rest, column="userId": F.pmod(F.col(column).cast("bigint"), F.lit(every)) == rest
        other = lambda column, value, when: F.when(when, value).otherwise(F.col(column))
        late = user(60, 11, "user")
        return replace(
            now,
            recommendations=now.recommendations.withColumn(
                "recommendations", other("recommendations", F.reverse("recommendations"), late)
            ),
            users=now.users.withColumn("countryCode", other("countryCode", F.lit("NOWHERE"), user(70, 5, "id"))),
            tracks=now.tracks.withColumn("title", other("title", F.lit("An earlier name"), F.col("trackGroup") == "9")),
            track_groups=now.track_groups.withColumn(
                "AvailableCountryCodes", other("AvailableCountryCodes", F.array().cast("array<string>"), F.col("trackGroup") == "44")
            ),
            blacklist=now.blacklist.where(~user(40, 3)),
            compounds=now.compounds.where("NOT (artistId = 33 AND priority = 2)"),
            observed_tracks=now.observed_tracks.where(~user(45, 6)),
            track_history=now.track_history.withColumn("count", other("count", F.col("count") + 5, user(55, 7))),
            favourite_tracks=now.favourite_tracks.where(~user(65, 8)),
            artist_history=now.artist_history.withColumn("count", other("count", F.col("count") + 9, user(75, 1))),
            favourite_artists=now.favourite_artists.where(~user(85, 6)),
        )
