"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from envstream.checks import queries as Q
from envstream.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = (
    Q.unified, Q.batch_distinct, Q.drop_nulls, Q.fact_air, Q.fact_weather, Q.insert_if_absent,
    Q.regroup_air, Q.align_topics, Q.encode_roundtrip, Q.scan_map_json, Q.first_per_key,
    Q.locations, Q.fetch_plan, Q.regression_metrics, Q.confusion_matrix, Q.scaled_features,
    Q.rf_metrics,
)
STREAMS = (Q.stream_dedup, Q.stream_join, Q.stream_facts)


def seconds(query, spark) -> float:
    began = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main():
    with contextlib.redirect_stdout(sys.stderr):
        spark = build_session(
            "envstream-bench", shuffle_partitions=CPUS, master=f"local[{CPUS}]",
            extra={"spark.ui.enabled": "false", "spark.driver.memory": "12g",
                   "spark.ui.showConsoleProgress": "false"},
        )
        spark.sparkContext.setLogLevel("ERROR")
        seconds(Q.parse_air, spark)  # start-up, not counted
        times = {
            query.__name__: min(seconds(query, spark) for _ in range(REPEATS))
            for query in HEADLINE
        }
        # A replay is four runs of its own already.
        times |= {query.__name__: seconds(query, spark) for query in STREAMS}
        spark.stop()
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
