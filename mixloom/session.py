"""Session settings for the jobs, by size of data and cluster."""

MIB = 1024**2
SHUFFLE_PARTITION_BYTES = 128 * MIB
BROADCAST_LIMIT_BYTES = 64 * MIB


def settings(cores: int, shuffle_bytes: int = 0) -> dict[str, str]:
    """Spark SQL settings for ``cores`` and the bytes of the job's largest shuffle (0 when small).

    Shuffles start with enough partitions for the largest one; AQE merges them where there is less.
    Joins on content keys rely on AQE's skew join, see ``mixloom.operators.joins``. A side is
    broadcast below the limit only. A job has more generated classes than Spark keeps by default,
    so that executors would compile them again and again. The last one is for the session's builder
    only: Spark reads it once.
    """
    partitions = max(cores, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.codegen.cache.maxEntries": "2000",
    }
