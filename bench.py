"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from tallyloom.operators.aggregates import min_avg_max
from tallyloom.plans import QUERIES
from tallyloom.session import SCHEMAS, local_session, read_table
from tallyloom.sources.delimited import read_delimited, write_delimited

HEADLINE = [
    "minmaxavg_by_key",
    "minmaxavg_lines",
    "best_city_per_product",
    "tx_by_triplet",
    "monthly_sales",
    "not_offered_in",
    "requested_by_all",
    "largest_offer",
    "place_party_counts",
    "two_way_flow",
    "cube_32",
    "cube_city_pair",
    "olap_crossjoin",
    "parallel_period",
    "ytd",
    "last_10_days",
    "rolling_24h_range",
    "rolling_7d_best",
    "best_hour",
    "std_timestamp",
    "dedup_by_year",
    "impute_mean_mode",
    "mean_median",
    "box_summary",
    "corr_matrix",
    "auc_lines",
    "ols_errors",
    "route_cost",
    "model_compare",
]


def run(spark, folder: str, name: str) -> float:
    """Wall time of planning and running a query completely, without collecting its rows."""
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def text_source(spark, folder: str, path: str) -> None:
    """Key and value of every line as headerless ;-separated text, written before anything is timed."""
    lines = read_table(spark, folder, "lineitem").select("l_partkey", "l_extendedprice").repartition(8)
    write_delimited(lines, f"{path}/in", sep=";", header=False)


def run_text(spark, path: str) -> float:
    """Text in, minimum, mean and maximum per key, text out: the job with a published time."""
    started = time.perf_counter()
    lines = read_delimited(spark, f"{path}/in", "city string, temperature float", sep=";", header=False)
    write_delimited(min_avg_max(lines, ["city"], "temperature"), f"{path}/out")
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    for table in SCHEMAS:  # start the session and open the files before anything is timed
        read_table(spark, folder, table).limit(1).count()
    times = {name: round(min(run(spark, folder, name) for _ in range(repeats)), 3) for name in names}
    if len(sys.argv) == 1:
        with tempfile.TemporaryDirectory(prefix="tallyloom-bench-") as path:  # the bench runs on one machine
            text_source(spark, folder, path)
            times["text_min_avg_max"] = round(min(run_text(spark, path) for _ in range(repeats)), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
        "best_of": repeats,
    }
    rows = read_table(spark, folder, "lineitem").count()
    for name in ("text_min_avg_max", "minmaxavg_lines"):
        if name in times:
            out[f"{name}_rows_per_sec"] = round(rows / times[name])
    print(json.dumps(out))


if __name__ == "__main__":
    main()
