"""Mix identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored mixes are looked up by these ids.
MIX_ID_LENGTH = 27
DISCOVERY_PREFIX = "discovery_mix_"
ARTIST_TOP_TRACKS_PREFIX = "artist_top_tracks_mix_"


def stable_mix_id(key: Column | str) -> Column:
    """Id that depends on one key only."""
    return F.substring(F.md5(_col(key).cast("string")), 1, MIX_ID_LENGTH)


def mix_id(prefix: Column | str, key: Column | str) -> Column:
    """Id of a product (``prefix``, a literal when given as text) for one owner (``key``)."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return stable_mix_id(F.concat(head.cast("string"), _col(key).cast("string")))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
