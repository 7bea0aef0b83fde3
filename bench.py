"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the local cores. Every query is
run to its end into the no-op sink, so all columns of all rows are computed.
"""

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oncallmart import registry, session  # noqa: E402

HEADLINE = [
    "bronze_tickets", "silver_canonical", "base_features", "mart_daily", "mart_sla",
    "mart_cluster", "fct_incidents", "star_join", "date_rollup", "role_date_join",
    "group_rate_top10", "monthly_trend", "day_type_impact", "completeness", "numeric_corr",
    "duration_summary", "boxplot_stats", "compliance_audit", "business_hours",
    "quality_unique", "quality_orphans", "lags_rolling", "backtest_folds", "forecast_team",
    "iqr_vote", "freq_enc", "stratified_split", "pr_curve", "roc_auc", "iso_forest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_PARTITIONS", cpus),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.QUERIES["target_layered"](spark, folder).collect()

    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
