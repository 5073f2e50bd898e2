from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nimbra.fixed_values import HOURLY_VARIABLES
from nimbra.operators import shape
from nimbra.operators.silver import explode_hours, flagged, rejects, to_silver
from nimbra.sources import bronze as source
from nimbra.sources.cities import configuration_text, configured_cities, read_cities
from tests.helpers import DAY, document, frame_of, land, rows


def test_pretty_printed_and_one_line_documents(spark, tmp_path):
    land(tmp_path / "pretty", document(), indent=2)
    land(tmp_path / "line", document())
    pretty = source.read_bronze(spark, str(tmp_path / "pretty"), multi_line=True)
    line = source.read_bronze(spark, str(tmp_path / "line"))
    assert rows(source.good_documents(pretty)) == rows(source.good_documents(line))
    assert pretty.first()["month"] == "01"


def test_pretty_printed_document_read_by_line_is_quarantined(spark, tmp_path):
    land(tmp_path, document(), indent=2)
    by_line = source.read_bronze(spark, str(tmp_path))
    assert source.good_documents(by_line).count() == 0
    assert source.malformed_documents(by_line).count() > 1


def test_malformed_document_does_not_fail_the_read(spark, tmp_path):
    land(tmp_path, document())
    land(tmp_path, '{"city_name": "delhi", "hourly": {', city="delhi")
    bronze = source.read_bronze(spark, str(tmp_path), multi_line=True)
    assert source.good_documents(bronze).count() == 1
    bad = source.malformed_documents(bronze).collect()
    assert [r["city"] for r in bad] == ["delhi"]
    assert bad[0]["document"].startswith('{"city_name": "delhi"')


def test_not_a_number_is_malformed(spark, tmp_path):
    land(tmp_path, '{"city_name": "mumbai", "latitude": NaN}')
    assert source.malformed_documents(source.read_bronze(spark, str(tmp_path))).count() == 1


@pytest.mark.parametrize("hours", [0, 1, 23, 24, 25, 48])
def test_all_positions_of_a_document(spark, hours):
    frame = frame_of(spark, document(hours=hours))
    exploded = explode_hours(frame)
    assert exploded.count() == hours
    off = shape.hour_count_off(frame).select("hours").collect()
    assert [r[0] for r in off] == ([] if hours == 24 else [hours])


def test_missing_variable_keeps_its_rows(spark):
    got = to_silver(explode_hours(frame_of(spark, document(without=["uv_index"])))).collect()
    assert len(got) == 24
    assert {r["uv_index"] for r in got} == {None}


def test_short_series_gives_nulls_and_rejects(spark):
    frame = frame_of(spark, document(temperature_2m=[20.0] * 20))
    assert to_silver(explode_hours(frame)).count() == 20
    assert rejects(explode_hours(frame)).first()["no_temperature"] == 4


def test_missing_hourly_block(spark):
    record = document()
    del record["hourly"]
    frame = frame_of(spark, record, document(city="delhi"))
    assert [r["city_name"] for r in shape.missing_hourly(frame).collect()] == ["mumbai"]
    with pytest.raises(PySparkException, match="no hourly data returned for mumbai"):
        shape.require_hourly(frame).collect()


def test_three_day_response_is_split_and_explodes_to_itself(spark):
    temperatures = [float(i) for i in range(72)]
    response = frame_of(spark, document(hours=72, temperature_2m=temperatures))
    split = shape.split_daily(response)
    assert sorted(r["day"] for r in split.collect()) == ["10", "11", "12"]
    assert {r["hours"] for r in split.select(F.size("hourly.time").alias("hours")).collect()} == {24}
    got = flagged(explode_hours(split)).orderBy("observation_timestamp").collect()
    assert [r["temperature_2m"] for r in got] == temperatures
    back = shape.collect_documents(
        explode_hours(split), ["city_name", "pipeline_run_date"], "position"
    )
    again = {r["pipeline_run_date"]: r["hourly"]["temperature_2m"] for r in back.collect()}
    assert again["2024-01-11"] == temperatures[24:48]


def test_split_of_unordered_times_and_missing_variable(spark):
    record = document(hours=3, without=["rain"], temperature_2m=[1.0, 2.0, 3.0])
    record["hourly"]["time"] = ["2024-01-11T00:00", "2024-01-10T05:00", "2024-01-11T01:00"]
    got = {r["day"]: r["hourly"] for r in shape.split_daily(frame_of(spark, record)).collect()}
    assert got["11"]["temperature_2m"] == [1.0, 3.0]
    assert got["10"]["temperature_2m"] == [2.0]
    assert got["10"]["rain"] is None


def test_hours_without_a_time_stay_in_a_document_of_their_own(spark):
    record = document(hours=4, temperature_2m=[1.0, 2.0, 3.0, 4.0])
    record["hourly"]["time"][2] = None
    split = shape.split_daily(frame_of(spark, record)).collect()
    assert {r["day"]: r["hourly"]["temperature_2m"] for r in split} == {None: [3.0], "10": [1.0, 2.0, 4.0]}


def test_a_long_response_is_split_in_linear_time(spark, tmp_path):
    """Ten years of hours: each value is cut once, not once a date."""

    def split_of(hours: int) -> float:
        path = str(tmp_path / f"{hours}")
        start = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
        every = F.sequence(F.lit(0), F.lit(hours - 1))
        time_of = F.transform(every, lambda i: F.date_format(F.timestamp_add("HOUR", i, start), "yyyy-MM-dd'T'HH:mm"))
        series = [F.transform(every, lambda i: i.cast("double")).alias(v) for v in HOURLY_VARIABLES]
        response = spark.range(1).select(F.lit("tokyo").alias("city_name"), F.struct(time_of.alias("time"), *series).alias("hourly"))
        response.write.parquet(path)
        took = []
        for _ in range(2):
            began = time.perf_counter()
            found = shape.split_daily(spark.read.parquet(path)).agg(F.count("*"), F.sum(F.size("hourly.rain"))).first()
            took.append(time.perf_counter() - began)
            assert tuple(found) == (hours // 24, hours)
        return min(took)

    assert split_of(87_600) < 5 * max(0.5, split_of(21_888))


def test_only_the_run_date_is_kept(spark):
    response = frame_of(spark, document(hours=48, temperature_2m=[float(i) for i in range(48)]))
    kept = shape.keep_date(response, F.lit("2024-01-11")).first()
    assert kept["hourly"]["temperature_2m"] == [float(i) for i in range(24, 48)]
    assert (kept["year"], kept["month"], kept["day"]) == ("2024", "01", "11")
    empty = shape.keep_date(response, F.lit("2024-01-20")).first()
    assert empty["hourly"]["time"] == []


def test_metadata_comes_from_the_city_dimension(spark):
    bare = frame_of(spark, document(city="tokyo")).withColumn("city", F.col("city_name")).drop(
        "city_name", "city_display_name", "country"
    )
    got = shape.attach_metadata(bare, configured_cities(spark), F.lit("2024-01-11T00:00:00")).first()
    assert (got["city_name"], got["city_display_name"], got["country"]) == ("tokyo", "Tokyo", "Japan")
    assert got["ingestion_timestamp"] == "2024-01-11T00:00:00"


def test_writing_a_city_day_replaces_only_it(spark, tmp_path):
    root = str(tmp_path / "bronze")
    both = shape.with_partition_keys(frame_of(spark, document(), document(city="delhi")))
    source.write_bronze(both, root)
    again = shape.with_partition_keys(frame_of(spark, document(hours=3)))
    source.write_bronze(again, root)
    got = source.good_documents(source.read_bronze(spark, root))
    sizes = {r["city"]: r["n"] for r in got.select("city", F.size("hourly.time").alias("n")).collect()}
    assert sizes == {"mumbai": 3, "delhi": 24}


def test_partition_filters_and_narrow_schema_reach_the_scan(spark, tmp_path):
    for city in ("mumbai", "delhi"):
        for day in (DAY, DAY + dt.timedelta(days=40)):
            land(tmp_path, document(city=city, start=day), city=city, day=day)
    bronze = source.read_bronze(spark, str(tmp_path), variables=["rain"])
    one = bronze.where((F.col("city") == "delhi") & source.in_date_range(DAY, DAY))
    assert one.count() == 1
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in scan  # nothing left to test on rows
    assert "PartitionFilters: [isnotnull(city" in scan
    assert bronze.schema["hourly"].dataType.fieldNames() == ["time", "rain"]


def test_catalog_table_sees_new_partitions(spark, tmp_path):
    land(tmp_path, document())
    source.register_bronze(spark, "landing", "bronze", str(tmp_path))
    assert spark.table("landing.bronze").count() == 1
    land(tmp_path, document(city="delhi"), city="delhi")
    source.register_bronze(spark, "landing", "bronze", str(tmp_path))
    assert spark.table("landing.bronze").where("month = '01'").count() == 2


def test_city_configuration_document(spark, tmp_path):
    (tmp_path / "cities.json").write_text(configuration_text())
    read = read_cities(spark, str(tmp_path / "cities.json"))
    assert rows(read) == rows(configured_cities(spark))
    assert read.count() == 6


def test_unparseable_time_fails_unless_tolerant(spark):
    record = document(hours=2)
    record["hourly"]["time"][1] = "yesterday"
    exploded = explode_hours(frame_of(spark, record))
    with pytest.raises(PySparkException):
        to_silver(exploded).collect()
    got = to_silver(exploded, tolerant=True).collect()
    assert [r["observation_date"] for r in got] == [DAY]  # the other is among the rejects
