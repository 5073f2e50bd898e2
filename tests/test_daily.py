from __future__ import annotations

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from nimbra.operators.daily import condition_counts, to_daily
from nimbra.operators.events import to_events, to_events_multilabel
from nimbra.schemas import GOLD_DAILY, GOLD_EVENTS
from tests.helpers import DAY, daily, silver, silver_row

AS_OF = dt.date(2024, 2, 1)


def test_schema_and_audit_dates(spark):
    got = to_daily(silver(spark, [silver_row(h) for h in range(24)]), AS_OF)
    assert got.columns == GOLD_DAILY.fieldNames()
    assert [f.dataType for f in got.schema.fields] == [f.dataType for f in GOLD_DAILY.fields]
    row = got.first()
    assert (row["first_seen_date"], row["last_updated_date"], row["pipeline_run_date"]) == (
        AS_OF, AS_OF, DAY,
    )
    assert row["record_count"] == 24
    explicit = to_daily(silver(spark, [silver_row()]), AS_OF, dt.date(2024, 1, 12)).first()
    assert explicit["pipeline_run_date"] == dt.date(2024, 1, 12)


def test_ties_take_the_lowest_direction_and_label(spark):
    rows = [
        silver_row(0, wind_direction_10m=270, weather_code=65, weather_condition="Rain"),
        silver_row(1, wind_direction_10m=90, weather_code=61, weather_condition="Rain"),
        silver_row(2, wind_direction_10m=90, weather_code=48, weather_condition="Fog"),
        silver_row(3, wind_direction_10m=270, weather_code=48, weather_condition="Fog"),
        silver_row(4, wind_direction_10m=None, weather_code=45, weather_condition="Fog"),
        silver_row(5, wind_direction_10m=None, weather_code=63, weather_condition="Rain"),
    ]
    got = to_daily(silver(spark, rows), AS_OF).first()
    assert got["dominant_wind_direction"] == 90
    assert (got["dominant_condition"], got["dominant_weather_code"]) == ("Fog", 45)


def test_unknown_condition_without_a_code(spark):
    rows = [silver_row(h, weather_code=None, weather_condition="Unknown") for h in range(3)]
    got = to_daily(silver(spark, rows), AS_OF).first()
    assert (got["dominant_condition"], got["dominant_weather_code"]) == ("Unknown", None)


def test_day_without_precipitation_values_has_no_rain(spark):
    rows = [silver_row(h, precipitation=None, rain=None, uv_index=None) for h in range(3)]
    got = to_daily(silver(spark, rows), AS_OF).first()
    assert (got["had_rain"], got["total_precipitation"], got["total_rain"]) == (False, None, None)
    assert (got["max_uv_index"], got["avg_uv_index"]) == (None, None)


def test_bad_rows_are_left_out(spark):
    bad = list(silver_row(1, temperature_2m=None))
    bad[-1] = "BAD"
    got = to_daily(silver(spark, [silver_row(0), tuple(bad)]), AS_OF).first()
    assert got["record_count"] == 1


def test_changed_label_gives_two_rows(spark):
    other = list(silver_row(1))
    other[1] = "Bombay"
    assert to_daily(silver(spark, [silver_row(0), tuple(other)]), AS_OF).count() == 2


CODES = st.sampled_from(
    [(0, "Clear sky"), (45, "Fog"), (48, "Fog"), (95, "Thunderstorm"), (77, "Snow grains"), (7, "Unknown")]
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(CODES, st.integers(0, 3), st.integers(-300, 500)), min_size=1, max_size=30))
def test_against_brute_force(spark, readings):
    rows = [
        silver_row(0, weather_code=code, weather_condition=label, wind_direction_10m=way,
                   temperature_2m=t / 10)
        for (code, label), way, t in readings
    ]
    got = to_daily(silver(spark, rows).repartition(3), AS_OF).first()
    labels = Counter(label for (_, label), *_ in readings)
    best = min(labels, key=lambda x: (-labels[x], x))
    ways = Counter(way for _, way, _ in readings)
    assert got["dominant_condition"] == best
    assert got["dominant_weather_code"] == min(c for (c, x), *_ in readings if x == best)
    assert got["dominant_wind_direction"] == min(ways, key=lambda x: (-ways[x], x))
    temperatures = [t / 10 for *_, t in readings]
    assert (got["max_temperature"], got["min_temperature"]) == (max(temperatures), min(temperatures))
    assert abs(got["avg_temperature"] - sum(temperatures) / len(temperatures)) <= 0.005 + 1e-9
    counts = {r["weather_condition"]: r["condition_count"] for r in condition_counts(silver(spark, rows)).collect()}
    assert counts == labels


def test_a_hot_city_day_is_combined_before_the_shuffle(spark):
    rows = silver(spark, [silver_row(h % 24) for h in range(2000)]).repartition(4)
    daily_rows = to_daily(rows, AS_OF)
    assert daily_rows.first()["record_count"] == 2000
    plan = daily_rows._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "partial_sum" in plan


def test_events_first_type_and_all_types(spark):
    frame = daily(
        spark,
        {"max_temperature": 46.0, "max_uv_index": 9.0},
        {"weather_date": DAY + dt.timedelta(days=1)},
    )
    one = to_events(frame, AS_OF)
    assert one.columns == GOLD_EVENTS.fieldNames()
    assert [(r["event_type"], r["severity"], r["detected_on"]) for r in one.collect()] == [
        ("EXTREME_HEAT", "WARNING", AS_OF)
    ]
    several = to_events_multilabel(frame, AS_OF)
    assert sorted(r["event_type"] for r in several.collect()) == ["EXTREME_HEAT", "HIGH_UV"]
