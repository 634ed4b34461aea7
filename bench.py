"""Time the headline queries on local[$BENCH_CPUS] and print one JSON line.

Each query runs once to warm up and three times more, into a no-op sink; the
median of the three counts.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tradeloom.functions.staging import remove_scratch
from tradeloom.plans.catalog import QUERIES

HEADLINE = [
    "null_fill", "type_cast_clean", "dedup", "dedup_rejects", "fx_convert", "date_expand",
    "lei_lookup", "exposure_rollup", "position_net", "surrogate_keys", "dim_date", "fact_trades",
    "vw_daily_cpty_exposure", "vw_asset_class_exposure", "dq_violations", "dq_violations_first",
    "dq_checkpoint_score", "dlq_roundtrip", "stage_counts", "lineage_graph_edges",
    "lineage_ancestors", "lineage_path", "lineage_summary", "rdf_triples", "pipeline_end_to_end",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(4):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_warm_median_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
