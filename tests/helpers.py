"""Hand-made rows for the tests."""

from __future__ import annotations

import datetime as dt
import json
import pathlib

from nimbra.fixed_values import CITIES, HOURLY_VARIABLES
from nimbra.schemas import BRONZE, GOLD_DAILY, GOLD_EVENTS, SILVER

DAY = dt.date(2024, 1, 10)
PLAIN = {
    "temperature_2m": 20.0, "relative_humidity_2m": 50, "apparent_temperature": 19.0,
    "precipitation": 0.0, "rain": 0.0, "wind_speed_10m": 10.0, "wind_direction_10m": 90,
    "weather_code": 0, "uv_index": 3.0,
}


def silver_row(hour=0, city="mumbai", day=DAY, **values):
    readings = {**PLAIN, **values}
    when = dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=hour)
    row = {
        "city_name": city, "city_display_name": city.title(), "country": "X", "latitude": 1.0,
        "longitude": 2.0, "observation_timestamp": when, "observation_date": day,
        "observation_hour": when.hour, "timezone": "UTC", "weather_condition": "Clear sky",
        "ingestion_timestamp": when, "pipeline_run_date": day, "data_quality_flag": "GOOD",
        **readings,
    }
    return tuple(row[c] for c in SILVER.fieldNames())


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def daily(spark, *rows):
    base = {
        "city_name": "mumbai", "city_display_name": "Mumbai", "country": "India",
        "weather_date": DAY, "avg_temperature": 20.0, "max_temperature": 25.0,
        "min_temperature": 15.0, "avg_apparent_temperature": 19.0, "avg_humidity": 50.0,
        "max_humidity": 60, "min_humidity": 40, "total_precipitation": 0.0, "total_rain": 0.0,
        "had_rain": False, "avg_wind_speed": 10.0, "max_wind_speed": 20.0,
        "dominant_wind_direction": 90, "dominant_condition": "Clear sky",
        "dominant_weather_code": 0, "max_uv_index": 3.0, "avg_uv_index": 1.0,
        "temperature_range": 10.0, "comfort_score": 90.0, "first_seen_date": DAY,
        "last_updated_date": DAY, "pipeline_run_date": DAY, "record_count": 24,
    }
    made = [{**base, **row} for row in rows]
    return spark.createDataFrame(
        [tuple(r[c] for c in GOLD_DAILY.fieldNames()) for r in made], GOLD_DAILY
    )


def events(spark, *rows):
    base = {
        "city_name": "mumbai", "city_display_name": "Mumbai", "country": "India",
        "event_date": DAY, "event_type": "EXTREME_HEAT", "severity": "WATCH",
        "max_temperature": 43.0, "min_temperature": 15.0, "total_precipitation": 0.0,
        "max_wind_speed": 20.0, "max_uv_index": 3.0, "dominant_condition": "Clear sky",
        "detected_on": DAY, "pipeline_run_date": DAY,
    }
    made = [{**base, **row} for row in rows]
    return spark.createDataFrame(
        [tuple(r[c] for c in GOLD_EVENTS.fieldNames()) for r in made], GOLD_EVENTS
    )


def times(start: dt.date, hours: int) -> list[str]:
    first = dt.datetime.combine(start, dt.time())
    return [(first + dt.timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in range(hours)]


def document(city="mumbai", start=DAY, hours=24, without=(), **series):
    """A landed response or Bronze document as a dict."""
    about = next(c for c in CITIES if c["name"] == city)
    hourly = {"time": times(start, hours)}
    for variable in HOURLY_VARIABLES:
        if variable not in without:
            hourly[variable] = series.get(variable, [PLAIN[variable]] * hours)
    return {
        "latitude": about["latitude"], "longitude": about["longitude"],
        "timezone": about["timezone"], "city_name": city,
        "city_display_name": about["display_name"], "country": about["country"],
        "ingestion_timestamp": f"{start + dt.timedelta(days=1)}T00:05:00",
        "pipeline_run_date": str(start), "hourly_units": {"time": "iso8601"}, "hourly": hourly,
    }


def land(root: pathlib.Path, record: dict | str, city="mumbai", day=DAY, indent=None, name="raw"):
    folder = root / f"city={city}/year={day:%Y}/month={day:%m}/day={day:%d}"
    folder.mkdir(parents=True, exist_ok=True)
    text = record if isinstance(record, str) else json.dumps(record, indent=indent)
    (folder / f"{name}.json").write_text(text)


def frame_of(spark, *records):
    """Documents as a DataFrame, through the declared schema."""
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    from pyspark.sql import functions as F

    return lines.select(F.from_json("value", BRONZE).alias("d")).select("d.*")


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)
