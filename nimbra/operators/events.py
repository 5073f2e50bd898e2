"""Extreme days: daily summary rows that cross a threshold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbra.functions.weather import event_type, event_types, is_extreme, severity
from nimbra.schemas import GOLD_EVENTS

KEYS = ["city_name", "event_date", "event_type"]


def _stamped(daily: DataFrame, as_of: dt.date, run_date: dt.date | None) -> DataFrame:
    return daily.where(is_extreme()).withColumns(
        {
            "event_date": F.col("weather_date"),
            "severity": severity(),
            "detected_on": F.lit(as_of),
            "pipeline_run_date": F.lit(run_date) if run_date else F.col("weather_date"),
        }
    )


def to_events(daily: DataFrame, as_of: dt.date, run_date: dt.date | None = None) -> DataFrame:
    """One event per extreme day, of the first type that applies (14 columns)."""
    return (
        _stamped(daily, as_of, run_date)
        .withColumn("event_type", event_type())
        .select(GOLD_EVENTS.fieldNames())
    )


def to_events_multilabel(
    daily: DataFrame, as_of: dt.date, run_date: dt.date | None = None
) -> DataFrame:
    """One event per threshold crossed, so a day may have several."""
    return (
        _stamped(daily, as_of, run_date)
        .withColumn("event_type", F.explode(event_types()))
        .select(GOLD_EVENTS.fieldNames())
    )
