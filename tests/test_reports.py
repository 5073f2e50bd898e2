from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from nimbra.operators.ranking import rank_descending
from nimbra.plans import reports
from tests.helpers import DAY, daily, events, rows

TODAY = dt.date(2024, 1, 25)


def day(n):
    return dt.date(2024, 1, n)


def test_rank_equals_the_window_rank(spark):
    random.seed(7)
    values = [None, 0.0, 0.0, -3.25, 12.5] + [random.randint(-4000, 4000) / 100 for _ in range(300)]
    values += [7.77] * 200  # a hot tie
    frame = spark.createDataFrame(
        [(random.choice("ab"), v, i) for i, v in enumerate(values)], "k string, v double, i int"
    )
    for within, width in ((["k"], 1.0), ([], 10.0), (["k"], 1000.0), ([], 0.01), (["k"], None), ([], None)):
        window = Window.partitionBy(*within).orderBy(F.col("v").desc_nulls_last())
        expected = frame.withColumn("place", F.rank().over(window))
        assert rows(rank_descending(frame, "v", "place", within, width)) == rows(expected)


def test_trend_rolls_over_rows_or_dates(spark):
    dates = [day(1), day(2), day(10), day(11)]
    frame = daily(spark, *[{"weather_date": d, "avg_temperature": t}
                           for d, t in zip(dates, [10.0, 20.0, 30.0, 45.55], strict=True)])
    by_row = reports.temp_trend(frame, TODAY).collect()
    assert [r["rolling_7day_avg_temp"] for r in by_row] == [10.0, 15.0, 20.0, 26.39]
    assert [r["temp_change_from_yesterday"] for r in by_row] == [None, 10.0, 10.0, 15.55]
    by_date = reports.temp_trend(frame, TODAY, calendar=True).collect()
    assert [r["rolling_7day_avg_temp"] for r in by_date] == [10.0, 15.0, 30.0, 37.78]
    assert [r["temp_change_from_yesterday"] for r in by_date] == [None, 10.0, None, 15.55]


def test_trend_ranks_share_and_skip_and_old_days_are_left_out(spark):
    temperatures = {"mumbai": 30.0, "delhi": 30.0, "tokyo": 10.0}
    frame = daily(
        spark,
        *[{"city_name": c, "city_display_name": c, "avg_temperature": t} for c, t in temperatures.items()],
        {"weather_date": TODAY - dt.timedelta(days=31), "avg_temperature": 99.0},
        {"weather_date": TODAY - dt.timedelta(days=30), "avg_temperature": 5.0},
    )
    got = reports.temp_trend(frame, TODAY)
    assert got.count() == 4
    ranks = {r["city_display_name"]: r["heat_rank_that_day"] for r in got.where(F.col("weather_date") == DAY).collect()}
    assert ranks == {"mumbai": 1, "delhi": 1, "tokyo": 3}
    assert [r["city_display_name"] for r in got.collect()] == ["delhi", "Mumbai", "mumbai", "tokyo"]


def test_rain_ranking(spark):
    frame = daily(
        spark,
        {"weather_date": day(3), "total_precipitation": 10.0, "total_rain": 4.0, "had_rain": True},
        {"weather_date": day(4)},
        {"weather_date": day(5)},
        {"city_name": "delhi", "city_display_name": "Delhi", "weather_date": day(3)},
        {"city_name": "tokyo", "city_display_name": "Tokyo", "weather_date": TODAY,
         "total_precipitation": 500.0, "had_rain": True},
        {"city_name": "tokyo", "city_display_name": "Tokyo", "weather_date": dt.date(2023, 12, 31),
         "total_precipitation": 500.0, "had_rain": True},
    )
    wet, dry = reports.rainiest_cities(frame, TODAY).collect()
    assert (wet["city_display_name"], wet["total_precipitation_mm"], wet["rain_rank"]) == ("Mumbai", 10.0, 1)
    assert (wet["rainy_days"], wet["total_days"], wet["rainy_day_percentage"]) == (1, 3, 33.3)
    assert (wet["avg_rain_per_rainy_day_mm"], wet["max_single_day_rain_mm"]) == (10.0, 10.0)
    assert (dry["city_display_name"], dry["avg_rain_per_rainy_day_mm"], dry["rain_rank"]) == ("Delhi", None, 2)


def test_rain_ranking_is_empty_on_the_first_of_a_month(spark):
    assert reports.rainiest_cities(daily(spark, {}), dt.date(2024, 2, 1)).count() == 0


def test_risk_counts_recent_events_but_types_of_all_time(spark):
    old = [{"event_date": dt.date(2023, 1, n), "event_type": "HIGH_UV"} for n in range(1, 5)]
    frame = events(
        spark, *old,
        {"event_date": day(1), "severity": "CRITICAL"}, {"event_date": day(2), "severity": "WARNING"},
        {"event_date": day(3), "event_type": "HIGH_UV"},
        {"city_name": "delhi", "city_display_name": "Delhi", "event_date": day(4), "event_type": "STRONG_WIND"},
        {"city_name": "delhi", "city_display_name": "Delhi", "event_date": day(5), "event_type": "HEAVY_RAIN"},
        {"city_name": "tokyo", "city_display_name": "Tokyo", "event_date": dt.date(2023, 1, 1)},
    )
    first, second = reports.extreme_summary(frame, TODAY).collect()
    assert (first["city_display_name"], first["risk_score"], first["total_extreme_events"]) == ("Mumbai", 6, 3)
    assert (first["heat_events"], first["high_uv_events"], first["critical_events"]) == (2, 1, 1)
    assert first["most_common_event_type"] == "HIGH_UV"  # 5 ever against 2
    assert first["most_recent_event"] == day(3)
    assert second["most_common_event_type"] == "STRONG_WIND"  # a tie: the later name


def test_timeline_order(spark):
    frame = events(
        spark, {"severity": "CRITICAL"}, {"severity": "WATCH", "city_name": "delhi"},
        {"severity": "WARNING", "city_name": "tokyo"}, {"event_date": day(20)},
        {"event_date": dt.date(2023, 12, 1)},
    )
    text = [r["severity"] for r in reports.extreme_timeline(frame, TODAY).collect()]
    assert text == ["WATCH", "WATCH", "WARNING", "CRITICAL"]
    ordinal = [r["severity"] for r in reports.extreme_timeline(frame, TODAY, ordinal_severity=True).collect()]
    assert ordinal == ["WATCH", "CRITICAL", "WARNING", "WATCH"]
