"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median counts. Results are
written to Spark's no-op sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from courtside.queries import QUERIES
from courtside.session import build

HEADLINES = (
    "player_rolling_time", "daily_schedule", "injury_benefit", "rolling_share", "player_dimension_refresh",
    "team_history_refresh", "player_schedule", "schedule_own_leg", "team_position_defence", "game_features",
    "played_game_features", "played_game_features_across", "player_stints", "pending_games", "players_not_done",
    "run_log_status", "latest_news", "landed_measure", "resultset_scrape", "season_rankings", "split_last_games",
    "split_by_game_number", "split_by_days_rest", "on_off_court", "lineups_of_five", "streamed_latest", "reporting_refresh",
    "game_run_log",
)


def main(names) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINES)
