from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nimbra.functions import weather
from nimbra.functions.exact import exact_avg, exact_sum, round_half_away
from tests.helpers import daily

LABELS = {
    0: "Clear sky", 1: "Mainly clear", 2: "Partly cloudy", 3: "Overcast", 45: "Fog", 48: "Fog",
    51: "Drizzle", 53: "Drizzle", 55: "Drizzle", 61: "Rain", 63: "Rain", 65: "Rain",
    71: "Snow", 73: "Snow", 75: "Snow", 77: "Snow grains", 80: "Rain showers",
    81: "Rain showers", 82: "Rain showers", 85: "Snow showers", 86: "Snow showers",
    95: "Thunderstorm", 96: "Thunderstorm with hail", 99: "Thunderstorm with hail",
    100: "Unknown", -1: "Unknown", 4: "Unknown", None: "Unknown",
}


def test_every_weather_code(spark):
    frame = spark.createDataFrame([(c,) for c in LABELS], "code int")
    got = {r[0]: r[1] for r in frame.select("code", weather.condition_label(F.col("code"))).collect()}
    assert got == LABELS


@pytest.mark.parametrize(
    ("temperature", "humidity", "wind", "flag"),
    [
        (20.0, 50, 10.0, "GOOD"),
        (-60.0, 0, 0.0, "GOOD"), (60.0, 100, 300.0, "GOOD"),
        (-60.1, 50, 10.0, "SUSPECT"), (60.1, 50, 10.0, "SUSPECT"),
        (20.0, -1, 10.0, "SUSPECT"), (20.0, 101, 10.0, "SUSPECT"),
        (20.0, 50, -0.1, "SUSPECT"), (20.0, 50, 300.1, "SUSPECT"),
        (None, 50, 10.0, "BAD"), (20.0, None, 10.0, "BAD"), (20.0, 50, None, "BAD"),
        (None, 101, 400.0, "BAD"),
    ],
)
def test_quality_flag(spark, temperature, humidity, wind, flag):
    frame = spark.createDataFrame([(temperature, humidity, wind)], "t double, h int, w double")
    assert frame.select(weather.quality_flag(F.col("t"), F.col("h"), F.col("w"))).first()[0] == flag


def test_event_types_and_severity_at_their_bounds(spark):
    cases = [
        ({"max_temperature": 42.0}, None, "WATCH"),
        ({"max_temperature": 42.1}, "EXTREME_HEAT", "WATCH"),
        ({"max_temperature": 45.0}, "EXTREME_HEAT", "WATCH"),
        ({"max_temperature": 45.1}, "EXTREME_HEAT", "WARNING"),
        ({"max_temperature": 48.0}, "EXTREME_HEAT", "WARNING"),
        ({"max_temperature": 48.1}, "EXTREME_HEAT", "CRITICAL"),
        ({"min_temperature": 0.0}, None, "WATCH"),
        ({"min_temperature": -0.1}, "EXTREME_COLD", "WATCH"),
        ({"total_precipitation": 50.0}, None, "WATCH"),
        ({"total_precipitation": 50.1}, "HEAVY_RAIN", "WATCH"),
        ({"total_precipitation": 75.0}, "HEAVY_RAIN", "WATCH"),
        ({"total_precipitation": 75.1}, "HEAVY_RAIN", "WARNING"),
        ({"total_precipitation": 100.0}, "HEAVY_RAIN", "WARNING"),
        ({"total_precipitation": 100.1}, "HEAVY_RAIN", "CRITICAL"),
        ({"max_wind_speed": 60.0}, None, "WATCH"),
        ({"max_wind_speed": 60.1}, "STRONG_WIND", "WATCH"),
        ({"max_wind_speed": 90.1}, "STRONG_WIND", "WARNING"),
        ({"max_wind_speed": 120.1}, "STRONG_WIND", "CRITICAL"),
        ({"max_uv_index": 8.0}, None, "WATCH"),
        ({"max_uv_index": 8.1}, "HIGH_UV", "WATCH"),
        *[({"dominant_weather_code": c}, "THUNDERSTORM", "WATCH") for c in (95, 96, 99)],
        ({"min_temperature": -1.0, "total_precipitation": 120.0}, "EXTREME_COLD", "CRITICAL"),
        ({"max_temperature": None, "max_uv_index": 9.0}, "HIGH_UV", "WATCH"),
    ]
    frame = daily(spark, *[{**c, "record_count": i} for i, (c, *_) in enumerate(cases)])
    got = frame.select(
        "record_count", weather.event_type(), weather.severity(), weather.is_extreme()
    ).collect()
    for row in got:
        _, kind, level = cases[row[0]]
        assert (row[1], row[2]) == (kind, level), cases[row[0]]
        assert bool(row[3]) == (kind is not None)


def test_all_types_of_a_day(spark):
    frame = daily(spark, {"max_temperature": 43.0, "max_wind_speed": 61.0, "max_uv_index": 9.0})
    assert frame.select(weather.event_types()).first()[0] == [
        "EXTREME_HEAT", "STRONG_WIND", "HIGH_UV",
    ]


@pytest.mark.parametrize(
    ("temperature", "humidity", "score"),
    [(22.0, 50.0, 100.0), (30.0, 60.0, 81.0), (90.0, 100.0, 0.0), (None, 50.0, None), (22.0, None, None)],
)
def test_comfort_score(spark, temperature, humidity, score):
    frame = spark.createDataFrame([(temperature, humidity)], "t double, h double")
    assert frame.select(weather.comfort_score(F.col("t"), F.col("h"))).first()[0] == score


def test_severity_weight_of_an_unknown_level(spark):
    frame = spark.createDataFrame([("CRITICAL",), ("WARNING",), ("WATCH",), ("?",), (None,)], "s string")
    got = [r[0] for r in frame.select(weather.severity_weight(F.col("s"))).collect()]
    assert got == [3, 2, 1, 0, 0]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-99999, 99999)), min_size=1, max_size=40))
def test_sums_and_means_are_exact_and_order_free(spark, tenths):
    values = [None if t is None else t / 10 for t in tenths]
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    total, mean = frame.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()
    known = [Decimal(t) / 10 for t in tenths if t is not None]
    if not known:
        assert (total, mean) == (None, None)
    else:
        assert total == float(sum(known))
        assert mean == float(sum(known)) / len(known)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-10**7, 10**7), min_size=1, max_size=50))
def test_rounding_is_half_away_from_zero(spark, eighths):
    values = [e / 8 for e in eighths]  # exact in binary, halves included
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in frame.select(round_half_away(F.col("v"), 2)).collect()]
    cent = Decimal("0.01")
    assert got == [float(Decimal(v).quantize(cent, ROUND_HALF_UP)) for v in values]


def test_small_amounts_are_not_lost(spark):
    frame = spark.createDataFrame([(0.00004,)] * 3, "v double")
    total, mean = frame.agg(exact_sum(F.col("v")), exact_avg(F.col("v"))).first()
    assert (total, mean) == (0.00012, 0.00004)


def test_the_contract_values_are_these():
    """The SQL of the queries names the same values, and neither may change alone."""
    from nimbra import fixed_values as V

    assert V.PLAUSIBLE == {
        "temperature_2m": (-60, 60), "relative_humidity_2m": (0, 100), "wind_speed_10m": (0, 300),
    }
    assert (V.HEAT_ABOVE, V.COLD_BELOW, V.RAIN_ABOVE, V.WIND_ABOVE, V.UV_ABOVE) == (42, 0, 50, 60, 8)
    assert V.STORM_CODES == [95, 96, 99]
    assert V.SEVERITIES == [("CRITICAL", 48, 100, 120, 3), ("WARNING", 45, 75, 90, 2)]
    assert V.LOWEST_SEVERITY == ("WATCH", 1)
    assert (V.IDEAL_TEMPERATURE, V.IDEAL_HUMIDITY) == (22, 50)
    assert (V.TEMPERATURE_PENALTY, V.HUMIDITY_PENALTY) == (2, 0.3)
    assert (V.BACKFILL_DAYS, V.HOURS_PER_DAY, V.GOLD_COMPLETENESS) == (7, 24, 0.9)
