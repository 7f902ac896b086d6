"""Time the headline queries: python bench.py (BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS). Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskframe.plans.catalog import QUERIES  # noqa: E402
from riskframe.plans.views import Views  # noqa: E402
from riskframe.session import build_session  # noqa: E402

HEADLINE = (
    "risk_level_by_segment",
    "profile_nulls",
    "lab_outliers_dropped",
    "lab_cleaned_pivot",
    "lab_pivot_mean",
    "lab_range_lookup",
    "lab_trend_slopes",
    "integrate_entities",
    "risk_chart",
    "correlation_matrix",
    "describe_prices_by_status",
    "split_stratified",
    "fusion_decision",
    "metric_overall",
    "metric_auc_by_class",
    "text_lexicon_counts",
    "text_severity",
    "text_negations",
    "text_top_terms",
    "notes_concatenated",
    "curve_areas",
    "model_clusters",
    "model_anomalies",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "riskframe-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    views, seconds = Views(spark, folder, spread=int(os.environ.get("BENCH_SPREAD", cpus)) or None), {}
    for name in names:
        taken = []
        for _ in range(runs + 1):  # the first run warms the JVM and the file cache
            start = time.perf_counter()
            QUERIES[name](views).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name} {' '.join(f'{t:.2f}' for t in taken)}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
