from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nimbra.operators import upsert
from nimbra.operators.daily import KEYS
from nimbra.operators.silver import kept_rows
from nimbra.sources.tables import gold_daily_table, silver_table
from tests.helpers import DAY, daily, events, rows, silver, silver_row

LATER = dt.date(2024, 2, 1)
NEXT = DAY + dt.timedelta(days=1)


def test_matched_row_keeps_labels_and_first_date(spark):
    target = daily(spark, {}, {"weather_date": NEXT})
    source = daily(
        spark,
        {"city_display_name": "Bombay", "country": "IN", "avg_temperature": 30.0,
         "first_seen_date": LATER, "last_updated_date": LATER},
        {"city_name": "delhi", "city_display_name": "Delhi", "first_seen_date": LATER},
    )
    merged = {(r["city_name"], r["weather_date"]): r for r in upsert.merge_daily(target, source).collect()}
    assert len(merged) == 3
    hit = merged["mumbai", DAY]
    assert (hit["city_display_name"], hit["country"], hit["first_seen_date"]) == ("Mumbai", "India", DAY)
    assert (hit["avg_temperature"], hit["last_updated_date"]) == (30.0, LATER)
    assert merged["mumbai", NEXT]["avg_temperature"] == 20.0
    assert merged["delhi", DAY]["first_seen_date"] == LATER


def test_matched_null_overwrites_a_value(spark):
    target = daily(spark, {"max_uv_index": 5.0})
    merged = upsert.merge_daily(target, daily(spark, {"max_uv_index": None})).first()
    assert merged["max_uv_index"] is None


def test_same_source_twice_changes_nothing(spark):
    target, source = daily(spark, {}), daily(spark, {"avg_temperature": 1.0}, {"weather_date": NEXT})
    once = upsert.merge_daily(target, source)
    assert rows(upsert.merge_daily(once, source)) == rows(once)


def test_type_change_keeps_or_prunes_the_old_event(spark):
    target = events(spark, {}, {"event_date": NEXT}, {"city_name": "delhi"})
    source = events(spark, {"event_type": "HEAVY_RAIN"}, {"city_name": "delhi", "severity": "CRITICAL",
                                                           "detected_on": LATER})
    kept = upsert.merge_events(target, source)
    assert kept.count() == 4
    delhi = kept.where("city_name = 'delhi'").first()
    assert (delhi["severity"], delhi["detected_on"]) == ("CRITICAL", DAY)
    pruned = upsert.merge_events(target, source, F.col("event_date") == F.lit(DAY)).collect()
    assert sorted((r["city_name"], r["event_type"], r["event_date"]) for r in pruned) == [
        ("delhi", "EXTREME_HEAT", DAY), ("mumbai", "EXTREME_HEAT", NEXT), ("mumbai", "HEAVY_RAIN", DAY),
    ]


def test_unclassified_source_rows_take_no_part(spark):
    source = events(spark, {"event_type": None}, {"city_name": "delhi"})
    assert upsert.merge_events(events(spark), source).count() == 1


def test_two_source_rows_for_a_key_are_refused(spark):
    source = daily(spark, {}, {"city_display_name": "Bombay"})
    assert upsert.duplicate_keys(source, KEYS).first()["source_rows"] == 2
    with pytest.raises(upsert.DuplicateKeys):
        upsert.require_unique(source, KEYS)
    upsert.require_unique(daily(spark, {}, {"weather_date": NEXT}), KEYS)


def test_silver_keeps_other_cities_and_dates(spark):
    existing = silver(spark, [silver_row(0), silver_row(1), silver_row(0, "delhi"), silver_row(0, day=NEXT)])
    kept = kept_rows(existing, silver(spark, [silver_row(5)]))
    assert sorted((r["city_name"], r["observation_date"]) for r in kept.collect()) == [
        ("delhi", DAY), ("mumbai", NEXT),
    ]


def test_table_versions(spark, tmp_path):
    table = gold_daily_table(str(tmp_path))
    assert table.read(spark).count() == 0
    february = dt.date(2024, 2, 3)
    table.replace(spark, daily(spark, {}, {"weather_date": february}), ["2024-01", "2024-02"])
    assert table.read(spark).count() == 2
    before = table.read(spark)
    staged = table.stage(spark, daily(spark, {"avg_temperature": 1.0}, {"weather_date": NEXT}))
    assert table.read(spark).count() == 2  # not current yet
    staged.commit(spark, ["2024-01"])
    assert before.count() == 2  # the earlier reader's files are still there
    assert rows(table.read(spark).select("weather_date", "avg_temperature")) == rows(
        spark.createDataFrame(
            [(DAY, 1.0), (NEXT, 20.0), (february, 20.0)], "weather_date date, avg_temperature double"
        )
    )
    assert table.read(spark, start=february).count() == 1
    assert table.read(spark, end=DAY).count() == 1
    assert table.slices_in(table.read(spark)) == ["2024-01", "2024-02"]
    table.replace(spark, daily(spark), ["2024-01"])
    assert table.read(spark).count() == 1
    assert table.read_slices(spark, ["2024-01"]) is None


def test_range_read_touches_only_its_slices(spark, tmp_path):
    table = silver_table(str(tmp_path))
    days = [DAY + dt.timedelta(days=i) for i in range(4)]
    table.replace(spark, silver(spark, [silver_row(day=d) for d in days]), [str(d) for d in days])
    part = table.read(spark, days[1], days[2])
    assert {r["observation_date"] for r in part.collect()} == set(days[1:3])
    assert all("slice=2024-01-11" in f or "slice=2024-01-12" in f for f in part.inputFiles())
