"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dqspark.session import build_session  # noqa: E402
from workloads import QUERIES  # noqa: E402

HEADLINE = (
    "profile_events",
    "profile_global",
    "profile_lineitem",
    "rolling_profile",
    "rollup_metrics",
    "json_dimension",
    "dimension_values",
    "time_precision",
    "freshness_buckets",
    "indicator_family",
    "indicator_backfill",
    "rolling_lookback",
    "exact_distinct",
    "exact_percentile_lineitem",
    "approx_distinct",
    "hll_rollup",
    "kll_quantile",
    "path_fields",
    "record_merge",
    "geo_join",
    "geo_dimensions",
    "metrics_table",
    "stream_profile",
    "stream_lookback",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a session also pays for class loading.
    QUERIES["profile_events"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps({
            "metric": "total seconds of the headline queries",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()
