"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads. Each query runs
once to warm up and then ``BENCH_RUNS`` times; the least time counts. Results are fully computed
(written to Spark's no-op sink). ``one_job_per_metric`` is the cost of the same assessment with a
job per column and rule instead of one fused scan.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions import cells
from assayer.operators.scoring import QualitySpec
from assayer.plans import load_queries, views
from assayer.plans.batch import assess
from assayer.plans.definitions import SALES_V1
from assayer.session import build_session, fresh_path

HEADLINE = [
    "completeness", "accuracy_combined", "timeliness", "tier_classify", "tier_by_group", "quality_metrics", "quality_columns",
    "group_quality_columns", "profile_columns", "pattern_validation", "range_validation", "validation_report", "rule_violations",
    "schema_diff", "evolve_v1_v2", "process_source", "tier_roundtrip", "tier_table_roundtrip", "run_totals", "latest_status",
    "run_history", "records_per_day", "api_pages", "cve_rows", "cve_filters", "json_array_rows", "xml_payload", "parse_run_log",
    "document_rows", "document_upsert", "incremental_load", "parse_event_json", "tumbling_counts", "sliding_counts",
    "stream_tumbling", "stream_tiering", "stream_dead_letter",
]
SPEC = QualitySpec(name="sales_transactions", rules={"quantity": {"min": 1, "max": 10000}}, date_column="transaction_date")


def run_fully(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def fused(sales: DataFrame) -> None:
    assess(sales, SPEC, SALES_V1, views.AS_OF).collect()


def one_job_per_metric(sales: DataFrame) -> None:
    rows = sales.count()
    for field in sales.schema.fields:
        sales.where(cells.is_missing(field.name, field.dataType)).count()
    sales.where(cells.outside(F.col("quantity"), 1, 10000)).count()
    sales.select(F.avg(cells.age_in_days("transaction_date", sales.schema["transaction_date"].dataType, F.lit(views.AS_OF)))).collect()
    for column, pattern in SALES_V1.patterns.items():
        sales.select(F.count_if(cells.pattern_hit(F.col(column), pattern))).collect()
    for column in SALES_V1.ranges:
        sales.select(F.min(column), F.max(column)).collect()
    assert rows


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def least(work, runs: int) -> float:
    work()
    return round(min(timed(work) for _ in range(runs)), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark: SparkSession = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load_queries()
    found = {name: least(lambda name=name: run_fully(queries[name](spark, sf_dir)), runs) for name in HEADLINE}
    landed = fresh_path(spark, "bench-sales")
    views.sales_src(spark, sf_dir).write.parquet(landed)
    sales = spark.read.parquet(landed)
    compared = {"fused_assessment": least(lambda: fused(sales), runs), "one_job_per_metric": least(lambda: one_job_per_metric(sales), runs)}
    spark.stop()
    json.dump(
        {
            "metric": "headline_queries_total", "value": round(sum(found.values()), 3), "unit": "sec", "queries": found,
            "compared": compared, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        },
        sys.stdout,
    )
    print()


if __name__ == "__main__":
    main()
