"""Time the headline queries and print one JSON line.

The session is warmed first. Every query runs once to warm up and then three
times, and the median counts; the stream queries run once. The result is written to the noop sink, so all rows are produced and none reaches
the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pitchline.plans.registry import QUERIES
from pitchline.settings import local_session

HEADLINE = (
    "route_event_lines",
    "event_tags_exploded",
    "event_counters",
    "player_match_counters",
    "player_match_ratios",
    "career_profile",
    "appearances_on_field",
    "match_rating",
    "rating_history",
    "rating_latest",
    "pair_updates",
    "chemistry_final",
    "match_summary_core",
    "match_details_answer",
    "profile_answer",
    "win_prediction",
    "stream_player_match_counters",
    "stream_matches_played",
    "stream_match_dedup",
    "stream_profile",
    "stream_rating_latest",
    "stream_chemistry",
)

# Streams take their input in micro-batches of many jobs each; one timed run will do.
ONCE = tuple(name for name in HEADLINE if name.startswith("stream_"))


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("route_event_lines", "rating_latest"):  # warm the session, whatever comes first
        run(spark, name, sf_dir)
    seconds = {}
    for name in names:
        if name not in ONCE:
            run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(1 if name in ONCE else runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
