"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query runs twice
into a no-op sink, including its planning; ``queries`` holds the faster run of each and
``first`` the first one.
"""

from __future__ import annotations

import json
import os
import time

from filetally.catalog import QUERIES
from filetally.session import builder

HEADLINE = [
    "reconciliation_report",
    "reconciliation_summary",
    "reconcile_order_status",
    "snapshot_operations",
    "snapshot_transfers",
    "delta_operations",
    "folded_state",
    "sharing_acl",
    "file_properties",
    "shared_links",
    "current_entries",
    "extraction_due",
    "document_contents",
    "transfer_outcomes",
    "applied_operations",
    "validated_records",
    "checkpoint_gate",
    "repair_plan",
    "folded_text",
    "stored_report",
]


def timed(query, spark, tables: str) -> float:
    start = time.perf_counter()
    query(spark, tables).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    first, best = {}, {}
    for name in HEADLINE:
        runs = [timed(QUERIES[name], spark, tables) for _ in range(2)]
        first[name], best[name] = runs[0], min(runs)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "first": first,
                "sf": os.path.basename(tables.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
