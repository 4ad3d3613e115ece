"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely with the no-op sink (no collect), after one
warm-up query. Prints one JSON line:
{"metric": "...", "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "contest_momentum", "contest_form", "team_career", "venue_stats", "batter_career", "bowler_career",
    "player_match", "team_match_stats", "innings_pivot", "last5_wins", "streak_before", "venue_team_rate",
    "h2h_total", "h2h_prior", "recent_form", "batter_rolling", "bowler_rolling", "player_streak",
    "label_encode", "training_set", "split_stratified", "target_correlation", "box_stats", "markup_to_html",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]] or HEADLINE
    from faceoff.registry import QUERIES
    from faceoff.session import build_session
    from faceoff.sources.tables import standin_tables
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times = {}
    t0 = time.time()
    standin_tables(spark, sf_dir)  # joins and writes the contest and play tables that the queries read
    times["standin_build"] = round(time.time() - t0, 3)
    QUERIES["innings_pivot"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    for name in only:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
