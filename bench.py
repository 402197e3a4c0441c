"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``.  Every
query is run to the end and its result is counted through a no-op sink, so
lazy plans are paid for.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabloom.catalog import queries  # noqa: E402
from tabloom.session import build_session  # noqa: E402

HEADLINE = [
    "s01_load_csv", "s08_sample_exact", "s08_sample_with_replacement", "s09_shuffle",
    "a03_distinct_counts", "a04_describe", "a04_describe_bracketed", "a08_correlation", "a08_correlation_wide",
    "a10_count_outliers", "a11_histogram_auto", "a12_box_statistics", "a17_redundant_earlier", "a21_summary_by_granularity", "a21_summary_of_many_groups",
    "w01_row_position", "w02_difference_by_series", "w04_rolling_mean", "w05_running_count",
    "g01_variable_types", "g06_sparsity_pairs", "g07_pair_density",
    "c01_clean_flights_style", "c03_rare_categories", "e02_hierarchy_codes", "e03_one_hot", "e05_cyclic_by_period", "e09_frequency",
    "i02_fill_frequent", "i04_impute_by_neighbors", "o03_truncate", "n02_zscore", "b01_under_balance", "b02_over_balance",
    "b03_smote_balance", "k02_stratified_split", "j01_lookup_salted", "j06_nearest_neighbors", "j07_minority_neighbors",
    "q01_binary_metrics", "q06_roc_points", "q06_roc_by_model", "q08_forecast_errors",
    "t05_aggregate_by_period", "t07_autocorrelation", "t08_regular_grid", "t09_decompose_even", "t11_dickey_fuller", "st3_stream_by_hour",
    "m04_naive_bayes_study", "m07_decision_tree_study", "m08_random_forest_study", "m06_knn_study",
    "l02_flagship_preparation", "q07_registry_evaluate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g", "spark.log.level": "ERROR",
    })
    known = queries()
    # One warm-up starts the JVM's compilers and the Python workers.
    known["j06_nearest_neighbors"](spark, "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else folder).count()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
