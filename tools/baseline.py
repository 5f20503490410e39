"""Time all registered queries in Spark and their SQL in DuckDB; print a table.

    python tools/baseline.py [sf_dir] [runs]
"""

from __future__ import annotations

import pathlib
import statistics
import sys
import time

sys.path[:0] = [str(pathlib.Path(__file__).resolve().parents[1]), str(pathlib.Path(__file__).parent)]

import check  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    from millrace.queries import ORACLES, QUERIES
    from millrace.session import build_session

    spark = build_session("baseline", "local[8]", 8, spark__driver__memory="8g",
                          spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = check.duck(sf_dir)

    def timed(fn) -> float:
        start = time.perf_counter()
        fn()
        return time.perf_counter() - start

    print("| Query | Spark s | DuckDB s |\n|---|---|---|", flush=True)
    for name, query in QUERIES.items():
        def run():
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        try:
            run()
            ours = f"{statistics.median(timed(run) for _ in range(runs)):.2f}"
        except Exception as e:
            ours = f"failed: {type(e).__name__}"
        theirs = ""
        if name in ORACLES:
            def fetch():
                con.execute(ORACLES[name]).fetchall()

            fetch()
            theirs = f"{statistics.median(timed(fetch) for _ in range(runs)):.2f}"
        print(f"| {name} | {ours} | {theirs} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
