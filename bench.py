"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tallyloom import catalog
from tallyloom.session import local_session

HEADLINE = [
    "sales_measures",
    "invoice_prefix_summary",
    "customer_missing_summary",
    "basket_sizes",
    "flag_rules",
    "item_pair_rules",
    "sales_facts",
    "customer_features",
    "returns_log",
    "etl_summary",
    "monthly_metrics",
    "top_sellers",
    "fanout_naive",
    "fanout_safe",
    "dedup_groups",
    "route_counts",
    "token_batches",
    "issue_counts",
    "latest_status",
    "seller_daily",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # A tiny job starts the JVM's code paths; it is not measured.
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().collect()
    times = {}
    # Tables that several queries start from are written first, and that is measured by itself.
    for name, stage in {"stage_retail": catalog.work, "stage_reviews": catalog.reviews, "stage_texts": catalog.routed, "stage_answers": catalog.answered}.items():
        start = time.time()
        stage(spark, sf_dir)
        times[name] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
