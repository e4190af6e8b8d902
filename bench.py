"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the tables and the cores. Every query reads the plain tables and all of its
rows are produced (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from cartpulse.plans import catalogue

# Besides the dashboards: the fact, the row-level what-if and a model job.
OTHERS = (
    "agg_order_items",
    "agg_products_performance",
    "agg_monthly_delivery_accuracy",
    "agg_top_bad_review_words",
    "text_corpus_keywords",
    "whatif_simulated_rows",
    "ml_customer_clusters",
    "stream_category_trend",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cartpulse-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.all_queries()
    names = [n for n in queries if n.startswith("q")] + list(OTHERS)

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    run("q1_2")  # start-up of the JVM and of code generation
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
