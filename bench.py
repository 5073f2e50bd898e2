"""Headline timings on the provided tables, as one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Every query runs twice and the second run counts, so that neither JVM start
nor code generation is measured; ``cold`` holds the first runs.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from nimbra.operators.daily import to_daily  # noqa: E402
from nimbra.plans import catalog, reports  # noqa: E402
from nimbra.plans.runs import Lakehouse, upsert_daily  # noqa: E402
from nimbra.scratch import new_folder  # noqa: E402
from nimbra.session import build_session  # noqa: E402


def consume(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark: SparkSession = build_session(
        "nimbra-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    lines_gold = catalog.stored_daily(spark, sf_dir, "lineitem")
    lines_events = catalog.stored_events(spark, sf_dir, "lineitem")
    lines_silver = catalog.written(spark, catalog.silver_of(spark, sf_dir, "lineitem"), "silver")
    lake = Lakehouse.at(new_folder(spark, "lake"))
    upsert_daily(spark, lake.daily, lines_gold)
    month = lines_silver.where(
        F.col("observation_date").between(F.lit(dt.date(1998, 5, 1)), F.lit(dt.date(1998, 5, 31)))
    )

    def four_reports() -> None:
        consume(reports.temp_trend(lines_gold, catalog.LINES_TREND_DAY))
        consume(reports.rainiest_cities(lines_gold, catalog.LINES_RAIN_DAY))
        consume(reports.extreme_summary(lines_events, catalog.LINES_RISK_DAY))
        consume(reports.extreme_timeline(lines_events, catalog.LINES_TREND_DAY))

    def registered(name: str):
        return lambda: consume(catalog.QUERIES[name](spark, sf_dir))

    queries = {
        "silver_lines": registered("silver_hourly_lines"),
        "gold_daily_lines": registered("gold_daily_summary_lines"),
        "gold_events_lines": registered("gold_extreme_events_lines"),
        "gold_daily_from_silver": lambda: consume(to_daily(lines_silver, catalog.AS_OF)),
        "four_reports_lines": four_reports,
        "upsert_one_month": lambda: upsert_daily(spark, lake.daily, to_daily(month, catalog.AS_OF)),
        "silver_events": registered("silver_hourly"),
        "bronze_split_daily": registered("bronze_split_daily"),
        "bronze_to_silver": registered("silver_from_bronze"),
        "temp_trend": registered("temp_trend"),
        "extreme_summary": registered("extreme_summary"),
        "run_range": registered("run_range_events"),
    }
    cold, warm = {}, {}
    for name, run in queries.items():
        for timings in (cold, warm):
            started = time.perf_counter()
            run()
            timings[name] = round(time.perf_counter() - started, 3)
    scale = pathlib.Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
