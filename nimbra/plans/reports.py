"""Dashboard reports over the Gold tables. ``as_of`` plays the role of today."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbra import fixed_values as V
from nimbra.functions.exact import exact_avg, exact_avg_over, exact_sum, round_half_away
from nimbra.functions.weather import severity_weight
from nimbra.operators.ranking import rank_descending


def _since(column: str, as_of: dt.date, days: int) -> Column:
    return F.col(column) >= F.lit(as_of - dt.timedelta(days=days))


def temp_trend(daily: DataFrame, as_of: dt.date, calendar: bool = False) -> DataFrame:
    """Temperature per city over the last 30 days, with rolling mean, change and rank.

    The rolling mean covers the last 7 rows, the change is against the row
    before. With ``calendar`` they cover the last 7 dates and the day before,
    which differs where a date is missing. The windows are per city, over at most
    31 rows each.
    """
    recent = daily.where(_since("weather_date", as_of, V.TREND_DAYS)).select(
        "city_name", "city_display_name", "country", "weather_date", "avg_temperature",
        "max_temperature", "min_temperature", "temperature_range", "comfort_score",
        "dominant_condition",
    )
    # A mean has two decimals, so a date has some thousands of distinct ones at most.
    ranked = rank_descending(recent, "avg_temperature", "heat_rank_that_day", ["weather_date"])
    city = Window.partitionBy("city_name").orderBy("weather_date")
    if calendar:
        day = Window.partitionBy("city_name").orderBy(F.unix_date("weather_date"))
        rolling = day.rangeBetween(-(V.ROLLING_ROWS - 1), 0)
        previous = F.max("avg_temperature").over(day.rangeBetween(-1, -1))
    else:
        rolling = city.rowsBetween(-(V.ROLLING_ROWS - 1), 0)
        previous = F.lag("avg_temperature", 1).over(city)
    return (
        ranked.withColumns(
            {
                "rolling_7day_avg_temp": round_half_away(
                    exact_avg_over(F.col("avg_temperature"), rolling), 2
                ),
                "temp_change_from_yesterday": round_half_away(
                    F.col("avg_temperature") - previous, 2
                ),
            }
        )
        .orderBy(F.asc_nulls_last("city_name"), F.asc_nulls_last("weather_date"))
        .select(
            "city_display_name", "country", "weather_date", "avg_temperature",
            "max_temperature", "min_temperature", "temperature_range", "comfort_score",
            "dominant_condition", "rolling_7day_avg_temp", "temp_change_from_yesterday",
            "heat_rank_that_day",
        )
    )


def rainiest_cities(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """Cities by rainfall from the first of the month up to yesterday."""
    month = daily.where(
        (F.col("weather_date") >= F.lit(as_of.replace(day=1)))
        & (F.col("weather_date") < F.lit(as_of))
    )
    totals = month.groupBy("city_name", "city_display_name", "country").agg(
        exact_sum(F.col("total_precipitation")).alias("precipitation"),
        exact_sum(F.col("total_rain")).alias("rain"),
        F.count_if("had_rain").alias("rainy_days"),
        F.count("*").alias("total_days"),
        F.max("total_precipitation").alias("max_single_day_rain_mm"),
        exact_avg(F.col("comfort_score")).alias("comfort"),
    )
    ranked = rank_descending(totals, "precipitation", "rain_rank", [], 10.0)
    per_rainy_day = F.col("precipitation") / F.nullif("rainy_days", F.lit(0).cast("bigint"))
    return (
        ranked.select(
            "city_name",
            "city_display_name",
            "country",
            round_half_away(F.col("precipitation"), 2).alias("total_precipitation_mm"),
            round_half_away(F.col("rain"), 2).alias("total_rain_mm"),
            "rainy_days",
            "total_days",
            round_half_away(F.col("rainy_days") * F.lit(100.0) / F.col("total_days"), 1).alias(
                "rainy_day_percentage"
            ),
            round_half_away(per_rainy_day, 2).alias("avg_rain_per_rainy_day_mm"),
            "max_single_day_rain_mm",
            "rain_rank",
            round_half_away(F.col("comfort"), 1).alias("avg_comfort_score"),
        )
        .orderBy(F.desc_nulls_last("total_precipitation_mm"), F.asc("city_name"))
        .drop("city_name")
    )


def extreme_summary(events: DataFrame, as_of: dt.date) -> DataFrame:
    """Risk per city: its events of the last 90 days by type and severity.

    The most common type is by all-time counts, among the types of the last 90
    days; the later name wins a tie. Events are reduced to one row per
    city and type before anything else, so one scan serves both periods and no
    join of events with their counts is needed.
    """
    recent = _since("event_date", as_of, V.RISK_DAYS)
    levels = [level for level, *_ in V.SEVERITIES] + [V.LOWEST_SEVERITY[0]]
    per_type = (
        events.where(F.col("event_type").isNotNull())
        .groupBy("city_name", "city_display_name", "country", "event_type")
        .agg(
            F.count("*").alias("ever"),
            F.count_if(recent).alias("recent"),
            *[
                F.count_if(recent & (F.col("severity") == level)).alias(level)
                for level in levels
            ],
            F.max(F.when(recent, F.col("event_date"))).alias("latest"),
            F.sum(F.when(recent, severity_weight(F.col("severity")))).alias("weight"),
        )
    )
    # A city has few rows left here: its event types times its labels.
    of_type = Window.partitionBy("city_name", "event_type")
    per_type = per_type.withColumn("type_count", F.sum("ever").over(of_type)).where("recent > 0")

    def of(event_type: str) -> Column:
        count = F.sum(F.when(F.col("event_type") == event_type, F.col("recent")))
        return F.coalesce(count, F.lit(0))

    return (
        per_type.groupBy(
            "city_name", F.lit("CITY_SUMMARY").alias("report_section"), "city_display_name",
            "country",
        )
        .agg(
            F.sum("recent").alias("total_extreme_events"),
            of("EXTREME_HEAT").alias("heat_events"),
            of("EXTREME_COLD").alias("cold_events"),
            of("HEAVY_RAIN").alias("heavy_rain_events"),
            of("STRONG_WIND").alias("strong_wind_events"),
            of("HIGH_UV").alias("high_uv_events"),
            of("THUNDERSTORM").alias("thunderstorm_events"),
            *[F.sum(level).alias(f"{level.lower()}_events") for level in levels],
            F.max("latest").alias("most_recent_event"),
            F.max_by("event_type", F.struct("type_count", "event_type")).alias(
                "most_common_event_type"
            ),
            F.sum("weight").alias("risk_score"),
        )
        .orderBy(F.desc("risk_score"), F.asc("city_name"))
        .drop("city_name")
    )


def extreme_timeline(
    events: DataFrame, as_of: dt.date, ordinal_severity: bool = False
) -> DataFrame:
    """Events of the last 30 days, latest first.

    Severity sorts as text, descending (WATCH first), or from CRITICAL down
    with ``ordinal_severity``.
    """
    order = severity_weight(F.col("severity")) if ordinal_severity else F.col("severity")
    return (
        events.where(_since("event_date", as_of, V.TIMELINE_DAYS))
        .orderBy(
            F.desc("event_date"), order.desc(), F.asc("city_display_name"), F.asc("event_type")
        )
        .select(
            F.lit("EVENT_TIMELINE").alias("report_section"),
            "event_date", "city_display_name", "country", "event_type", "severity",
            "max_temperature", "min_temperature", "total_precipitation", "max_wind_speed",
            "max_uv_index", "dominant_condition",
        )
    )
