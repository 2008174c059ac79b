"""Time the jobs and the headline queries; prints one JSON line.

BENCH_SF_DIR names the test folder, BENCH_CPUS the cores. Jobs write their layer
to the lake; each query is run once into the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallyspark.session import local_session
from workbench.lake import LAYERS, drop_lakes, lake_for
from workbench.registry import QUERIES

HEADLINES = (
    "clean_trades",
    "trade_quality_flags",
    "flag_split_break",
    "split_factors",
    "adjust_reported_positions",
    "daily_trade_activity",
    "position_reconstruction",
    "reconciliation_breaks",
    "break_summary",
    "price_index",
    "event_asof_forward",
    "event_window_metrics",
    "event_window_summary",
    "investigation_corpus",
    "vector_table",
    "knn_topk",
    "hybrid_evidence",
    "investigation_packet",
    "groundedness",
    "expected_by_date_basis",
    "timing_divergence",
    "forward_split_positions",
    "price_required_dates",
    "detection_scorecard",
)


def main(names: tuple[str, ...]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)

    lake = lake_for(spark, folder)
    for layer in LAYERS:
        timed(f"job_{layer}", lambda: lake.ensure(layer))
    for name in names:
        timed(
            name,
            lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save(),
        )
    drop_lakes(spark)
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main(tuple(sys.argv[1:]) or HEADLINES)
