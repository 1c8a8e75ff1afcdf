"""Time the headline queries; prints one JSON line.

The table is $BENCH_SF_DIR on local[$BENCH_CPUS]. Each query runs once to warm up and then
three times; its median counts. Results are written in full to a sink that drops them.

The word queries are told to deal the texts, which lie in files of one row group, to $BENCH_TEXT_PARTS tasks, one
per core by default; with 0 they read them in one task.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallybrook import build_session  # noqa: E402
from tallybrook.plans import bindings  # noqa: E402

HEADLINE = [
    "wc_top5",
    "wc_whitespace",
    "wc_hashed",
    "wc_weighted",
    "bigrams",
    "bigrams_top5",
    "multiplier_dist",
    "partitioned_scan",
    "join_agg_sort",
    "join_inner",
    "join_left",
    "join_semi",
    "join_anti",
    "interval_pairs",
    "dedup_by_key",
    "explode_array",
    "profile_customer",
    "csv_typed",
    "orc_roundtrip",
    "stream_wc",
    "tumble_5m",
    "tumble_10m_append",
    "tumble_10m_update",
    "stream_static",
    "stream_stream",
    "keyed_avg",
    "usage_pct",
    "timed_words",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    settings = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    spark = build_session("bench", f"local[{cpus}]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    bindings.TEXT_PARTS = int(os.environ.get("BENCH_TEXT_PARTS", settings["spark.sql.shuffle.partitions"])) or None
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            bindings.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
