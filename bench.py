"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 3); the
median counts.  Results go to Spark's noop sink, so every row is computed and
none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.queries import QUERIES
from millrace.session import build_session

HEADLINE = (
    "word_count", "word_cloud", "scan_parquet", "scan_csv_schema", "scan_json",
    "sink_parquet", "join_left_outer", "join_salted", "join_positional", "join_broadcast",
    "agg_multi_key_count", "agg_max_avg", "agg_dedupe", "agg_describe", "agg_pivot",
    "agg_histogram", "agg_quantiles", "agg_box", "win_row_position", "sort_desc", "top_k",
    "fn_from_json", "sliding_window", "stream_sliding_append", "stream_upsert", "vt_merge",
    "vt_update", "multi_hop", "feat_scale", "feature_pipeline", "ml_linreg_plain", "udf_score", "udf_group_fit", "retail_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else None,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"), spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
