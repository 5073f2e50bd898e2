"""What the plans must look like for large inputs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nimbra.operators import silver as silver_ops
from nimbra.operators.daily import to_daily
from nimbra.plans import reports
from nimbra.plans.catalog import documents_of
from nimbra.sources.readings import hourly_readings
from nimbra.sources.tables import gold_daily_table
from tests.helpers import DAY, daily, document, events, frame_of

SF_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date(2024, 2, 1)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("table", ["events", "lineitem"])
def test_readings_need_no_window_and_no_shuffle(spark, table):
    plan = plan_of(silver_ops.to_silver(hourly_readings(spark, SF_DIR, table)))
    assert "Window" not in plan and "hashpartitioning" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
@pytest.mark.parametrize("table", ["events", "lineitem"])
def test_silver_and_rejects_add_up_to_the_table(spark, table, scale):
    sf_dir = f"/root/testdata/sf{scale}"
    readings = hourly_readings(spark, sf_dir, table)
    rejected = silver_ops.rejects(readings).agg(F.sum("rejected")).first()[0]
    there = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert silver_ops.to_silver(readings).count() + rejected == there


def test_readings_read_only_the_columns_they_use(spark):
    plan = plan_of(hourly_readings(spark, SF_DIR).select("city_name", "uv_index"))
    schema = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "props" not in schema and "value" not in schema


def test_documents_become_silver_without_a_shuffle(spark):
    plan = plan_of(silver_ops.to_silver(silver_ops.explode_hours(frame_of(spark, document()))))
    assert "Exchange" not in plan


def test_daily_summary_is_hash_aggregates(spark):
    documents = frame_of(spark, document())
    plan = plan_of(to_daily(silver_ops.to_silver(silver_ops.explode_hours(documents)), AS_OF))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert plan.count("hashpartitioning") == 2  # directions of a city-day, then the city-day


def test_daily_summary_scans_once_and_joins_nothing(spark, tmp_path):
    documents = frame_of(spark, document())
    silver_ops.to_silver(silver_ops.explode_hours(documents)).write.parquet(f"{tmp_path}/silver")
    plan = plan_of(to_daily(spark.read.parquet(f"{tmp_path}/silver"), AS_OF))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_no_numbering_over_a_whole_city_day(spark):
    plan = plan_of(documents_of(spark, SF_DIR))
    window = plan[plan.index("windowspecdefinition("):].split(", specifiedwindowframe")[0]
    assert "document" in window
    assert plan.count("Exchange hashpartitioning") == 1


def test_report_filters_reach_the_stored_table(spark, tmp_path):
    table = gold_daily_table(str(tmp_path))
    table.replace(spark, daily(spark, {}, {"weather_date": DAY + dt.timedelta(days=60)}), ["2024-01", "2024-03"])
    plan = plan_of(table.read(spark, DAY, DAY).select("city_name"))
    assert "GreaterThanOrEqual(weather_date" in plan
    trend = reports.temp_trend(table.read(spark), DAY)
    assert "GreaterThanOrEqual(weather_date" in plan_of(trend)


def test_no_rank_window_over_all_cities_of_a_date(spark):
    plan = plan_of(reports.temp_trend(daily(spark), DAY))
    assert "rank(" not in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_summary_reads_events_once(spark, tmp_path):
    events(spark).write.parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    plan = plan_of(reports.extreme_summary(stored, AS_OF))
    assert plan.count("FileScan") == 1 and "Join" not in plan
