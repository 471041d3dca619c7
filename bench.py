"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemart.plans import catalog, stream_catalog  # noqa: E402
from tidemart.session import build_session  # noqa: E402

# Each layer once, and the dashboard on top of all of them.
TABLES = (
    "json_log_scan", "cdc_route_counts", "dim_upsert", "log_split_counts", "repair_is_new",
    "daily_first_visit", "jump_detail", "order_wide", "payment_wide", "visitor_stats",
    "product_stats", "province_stats", "keyword_stats", "product_keywords", "gmv_by_brand",
    "visitor_24h", "keyword_score")
STREAMS = ("stream_jump_detail", "stream_province_stats")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("tidemart-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    # One query first, so that the start of the JVM's compilers is not counted.
    catalog.table_query(catalog.TABLE_QUERIES["gmv_by_brand"])(spark, sf_dir).count()
    times: dict[str, float] = {}
    for name in TABLES + STREAMS:
        build = {**catalog.TABLE_QUERIES, **stream_catalog.STREAM_QUERIES}[name]
        begin = time.perf_counter()
        catalog.table_query(build)(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
