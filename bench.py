"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: testdata folder (default /root/testdata/sf0.1). BENCH_CPUS: local cores.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from ratebook.queries import QUERIES  # noqa: E402

HEADLINE = (
    "stg_contracts",
    "stg_rate_schedules",
    "int_contracts_enriched",
    "int_rates_normalized",
    "dim_payer",
    "dim_provider",
    "dim_service",
    "fact_contracted_rates",
    "fact_of_documents",
    "dq_report",
    "contract_history_two_loads",
    "validate_contracts",
    "extract_fields",
    "extract_documents",
    "json_roundtrip",
    "stream_documents",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ratebook-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").selectExpr("sum(o_totalprice)").collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
