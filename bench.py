"""Times the queries and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8). Each query's whole result
goes to Spark's no-op sink, so all columns are computed and nothing is collected. One small query and one pass of rows
through Python run first, untimed, to start the JVM and the Python side.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from mixloom.session import settings
from workload.queries import QUERIES, run

HEADLINE = [
    "explode_recommendations",
    "recs_with_metadata",
    "available_in_country",
    "filter_blacklist_all",
    "filter_heard_tracks",
    "filter_observed_tracks",
    "filter_heard_titles",
    "filter_heard_albums",
    "flag_known_artists",
    "enrich_similar_artists",
    "resolve_main_artist",
    "top_track_per_artist",
    "split_known_unknown",
    "diversity_rank",
    "spread_known_artists",
    "assemble_discovery_mix",
    "assemble_artist_mix",
    "pick_top_artists",
    "vocabulary_decode",
    "score_sequences",
    "score_sequences_with_model",
    "observed_tracks",
    "daily_mix",
    "discovery_mix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    unknown = [n for n in names if n not in QUERIES]
    if unknown:
        raise SystemExit(f"no such query: {', '.join(unknown)}")

    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in settings(cores=cpus).items():
        builder = builder.config(key, value)
    spark = builder.config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    run("explode_recommendations", spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, 4 * cpus, 1, cpus).mapInPandas(lambda frames: frames, "id long").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()

    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
