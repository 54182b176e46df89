"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "scan_flow", "day_totals", "complete_day_rows", "align_weather", "deduplicate_cells",
    "day_tensor", "scan_raw_days", "scan_gen_days", "augment_flow", "union_batches",
    "grid_stencil", "grid_pool_2x2", "pool_net_flow", "split_80_20", "shuffle_rows",
    "shuffle_split", "bootstrap_batch", "leakage_audit", "checkpoint_retention",
    "scaler_transform", "covariance_matrix", "pca_project", "dense_layer", "extract_features",
    "logreg_l2", "linear_svc", "random_forest", "metric_report", "auc_score", "total_loss",
)


def main() -> None:
    from flowmosaic.catalog import QUERIES
    from flowmosaic.session import build_session

    spark = build_session("bench", master=f"local[{CPUS}]", shuffle_partitions=int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("day_totals")  # start the executors and compile once before the clock runs
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    scale = os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
