"""Times the headline queries on $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from barloom.plans.catalogue import QUERIES
from barloom.session import build_session

HEADLINES = [
    "risk_metrics",
    "risk_metrics_trailing",
    "risk_metrics_grouped_map",
    "rolling_metrics",
    "rolling_vol_var",
    "sector_rolling_vol",
    "latest_metrics",
    "quality_scores_all",
    "price_zscore_outliers",
    "upsert_prices",
    "insert_ignore",
    "change_feed",
    "normalize_validate",
    "coverage_gaps",
    "portfolio_normalize",
    "portfolio_risk",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start-up is not measured
    # nor is the first compilation of what most queries share
    QUERIES[HEADLINES[0]](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        begin = time.perf_counter()
        # every row and column is computed, nothing is collected
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
