"""Input tables: their columns, and reading them as just these columns."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the inputs. Ids of users and artists are numbers, of track
# groups and mixes text; blacklists hold all ids as text.
SCHEMAS = {
    "recommendations": "user bigint, recommendations array<string>",
    "tracks": "id bigint, trackGroup string, title string, mainArtistsIds array<bigint>",
    "track_groups": "trackGroup string, AvailableCountryCodes array<string>",
    "users": "id bigint, countryCode string",
    "track_history": "userId bigint, trackGroup string, cleanedTitle string, count bigint, dt timestamp",
    "favourite_tracks": "userId bigint, trackGroup string",
    "observed_tracks": "userId bigint, trackGroup string",
    "artist_history": "userId bigint, artistId bigint, count bigint, dt timestamp",
    "favourite_artists": "userId bigint, artistId bigint",
    "album_history": "userId bigint, masterBundleId string, count bigint",
    "blacklist": "userId string, artifactType string, artifactId string",
    "compounds": "artistId bigint, artistCompoundId bigint, priority bigint, mainArtist boolean",
    "clusters": "artistId bigint, cluster bigint",
    "similar_artists": "artistId bigint, neighbours array<bigint>",
    "artists": "id bigint, name string, picture string",
    "mixes": "user bigint, tracks array<string>, mixId string, atDate string",
    "observed_mixes": "mixId string",
    "sequences": "user bigint, items array<int>",
    "vocabulary": "item string, index int",
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in its types. Names match in any letter case; other columns are not read."""
    schema = T.StructType.fromDDL(SCHEMAS[table])
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table by its path, or by its name in the catalog, which has no slash."""
    return conform(spark.read.parquet(path) if "/" in path else spark.table(path), table)


def read_vocabulary(spark: SparkSession, model_path: str) -> DataFrame:
    """The vocabulary stored with a sequence model."""
    return read_table(spark, f"{model_path}/vocabulary", "vocabulary")
