from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nimbra.operators import gates, shape
from nimbra.operators.daily import partial_summaries, summary_of_partials
from nimbra.operators.silver import explode_hours, flagged, rejects
from nimbra.plans import runs
from nimbra.plans.runs import (
    Lakehouse,
    land_day,
    land_history,
    run_backfill,
    run_daily,
    run_range,
    run_silver,
    store_partials,
)
from nimbra.scratch import new_folder
from nimbra.sources import bronze as bronze_source
from nimbra.sources.bronze import good_documents, landed_files, read_bronze, write_bronze
from nimbra.sources.cities import configured_cities
from nimbra.streaming.ingest import stream_daily, stream_silver
from tests.helpers import DAY, daily, document, frame_of, land, rows, silver, silver_row

CITIES = ["mumbai", "delhi", "bangalore", "london", "new_york", "tokyo"]
DAYS = [DAY + dt.timedelta(days=i) for i in range(3)]
AUDIT = ["first_seen_date", "last_updated_date"]


@pytest.fixture
def landing(tmp_path):
    for c, city in enumerate(CITIES):
        for d, day in enumerate(DAYS):
            temperatures = [float(10 * c + 5 * d + h / 2) for h in range(24)]
            record = document(city=city, start=day, temperature_2m=temperatures)
            land(tmp_path / "bronze", record, city=city, day=day, indent=2)
    return str(tmp_path / "bronze")


def test_backfill_equals_daily_runs(spark, tmp_path, landing):
    cities = configured_cities(spark)
    whole, daily_lake = Lakehouse.at(str(tmp_path / "a")), Lakehouse.at(str(tmp_path / "b"))
    today = DAYS[-1] + dt.timedelta(days=1)
    total = run_backfill(spark, landing, whole, cities, today, 3, multi_line=True).first()
    assert (total["row_count"], total["status"]) == (18, "OK")
    for day in DAYS:
        status = run_daily(
            spark, landing, daily_lake, cities, day + dt.timedelta(days=1), multi_line=True
        ).first()
        assert (status["row_count"], status["status"]) == (6, "OK")
    for name in ("silver", "daily"):
        one, other = (getattr(lake, name).read(spark).drop(*AUDIT) for lake in (whole, daily_lake))
        assert rows(one) == rows(other)
    events = [lake.events.read(spark).drop("detected_on") for lake in (whole, daily_lake)]
    assert rows(events[0]) == rows(events[1])


def test_rerun_and_restatement(spark, tmp_path, landing):
    lake, cities = Lakehouse.at(str(tmp_path / "lake")), configured_cities(spark)
    for as_of in (dt.date(2024, 1, 20), dt.date(2024, 1, 21)):
        run_range(spark, landing, lake, cities, DAYS[0], DAYS[-1], as_of, multi_line=True)
    before = lake.daily.read(spark)
    assert {tuple(r) for r in before.select(*AUDIT).collect()} == {(dt.date(2024, 1, 20), dt.date(2024, 1, 21))}
    land(tmp_path / "bronze", document(city="london", temperature_2m=[43.0] * 24), city="london", indent=2)
    run_range(spark, landing, lake, cities, DAY, DAY, dt.date(2024, 1, 22), multi_line=True)
    after = lake.daily.read(spark)
    other = (F.col("city_name") != "london") | (F.col("weather_date") != F.lit(DAY))
    assert rows(after.where(other).drop(*AUDIT)) == rows(before.where(other).drop(*AUDIT))
    london = after.where(~other).first()
    assert (london["max_temperature"], london["first_seen_date"]) == (43.0, dt.date(2024, 1, 20))
    assert lake.silver.read(spark).count() == 18 * 24
    hot = lake.events.read(spark).where("city_name = 'london' AND event_type = 'EXTREME_HEAT'")
    assert {r["event_date"] for r in hot.collect()} >= {DAY}


def test_day_no_longer_extreme(spark, tmp_path, landing):
    lake, cities = Lakehouse.at(str(tmp_path / "lake")), configured_cities(spark)
    run = lambda **kw: run_range(
        spark, landing, lake, cities, DAY, DAY, dt.date(2024, 1, 20), multi_line=True, **kw
    )
    land(tmp_path / "bronze", document(city="delhi", temperature_2m=[50.0] * 24), city="delhi", indent=2)
    run()
    land(tmp_path / "bronze", document(city="delhi"), city="delhi", indent=2)
    run()
    delhi = F.col("city_name") == "delhi"
    assert lake.events.read(spark).where(delhi).count() == 1
    run(prune_stale=True)
    assert lake.events.read(spark).where(delhi).count() == 0


def test_missing_documents_stop_the_run(spark, tmp_path):
    for city in CITIES[:-1]:
        land(tmp_path / "bronze", document(city=city), city=city)
    lake, cities = Lakehouse.at(str(tmp_path / "lake")), configured_cities(spark)
    with pytest.raises(gates.GateFailed, match="tokyo"):
        run_range(spark, str(tmp_path / "bronze"), lake, cities, DAY, DAY, DAY)


def test_city_date_gate(spark, tmp_path):
    for city in CITIES:
        land(tmp_path / "bronze", document(city=city), city=city)
    lake, cities = Lakehouse.at(str(tmp_path / "lake")), configured_cities(spark)
    with pytest.raises(gates.GateFailed, match="missing documents"):
        run_range(spark, str(tmp_path / "bronze"), lake, cities, DAY, DAYS[1], DAY)


@pytest.mark.parametrize(("count", "status"), [(0, "FAIL"), (89, "WARN"), (90, "OK"), (100, "OK")])
def test_gold_total_gate(spark, count, status):
    frame = daily(spark, {}).limit(0) if not count else daily(spark, *[{} for _ in range(count)])
    got = gates.gold_total_status(frame, 100)
    assert got.first()["status"] == status
    if status == "FAIL":
        with pytest.raises(gates.GateFailed):
            gates.require_no_failure(got, "gold")


def test_gold_daily_gate(spark):
    frame = daily(spark, {"city_name": "a"}, {"city_name": "b"}, {"weather_date": DAYS[1]})
    got = gates.gold_daily_status(frame, gates.date_grid(spark, DAYS[0], DAYS[2]), 2).collect()
    assert {r["expected_date"]: (r["row_count"], r["status"]) for r in got} == {
        DAYS[0]: (2, "OK"), DAYS[1]: (1, "WARN"), DAYS[2]: (0, "FAIL"),
    }


def test_dates_of_a_run():
    assert gates.date_range(dt.date(2024, 3, 1), 1) == (dt.date(2024, 2, 29), dt.date(2024, 2, 29))
    assert gates.date_range(dt.date(2024, 3, 1), 7) == (dt.date(2024, 2, 23), dt.date(2024, 2, 29))


def test_provisional_hours(spark):
    def reading(hour, zone, ingested):
        row = dict(zip(silver(spark, []).columns, silver_row(hour), strict=True))
        row.update(timezone=zone, ingestion_timestamp=ingested)
        return tuple(row.values())

    ingested = dt.datetime(2024, 1, 11, 0, 5)
    frame = silver(spark, [
        reading(21, "America/New_York", ingested), reading(19, "America/New_York", ingested),
        reading(23, "Asia/Tokyo", ingested), reading(23, "Europe/London", ingested),
    ])
    assert [r["observation_hour"] for r in gates.provisional_hours(frame).collect()] == [21]


def test_incomplete_days(spark):
    frame = daily(spark, {"record_count": 23}, {"record_count": 24, "city_name": "delhi"})
    assert [r["city_name"] for r in gates.incomplete_days(frame).collect()] == ["mumbai"]


def test_stream_in_batches_equals_the_batch_run(spark, tmp_path):
    for city in CITIES:
        for half in (0, 12):  # a city-day in two files
            record = document(city=city, hours=12, temperature_2m=[float(half + h) for h in range(12)])
            record["hourly"]["time"] = [t.replace("T0", "T1") if half and t[11] == "0" else t
                                        for t in record["hourly"]["time"]]
            land(tmp_path / "bronze", record, city=city, name=f"part{half}")
    lake = Lakehouse.at(str(tmp_path / "stream"))
    checkpoint = new_folder(spark, "stream")

    def drain():
        stream_daily(
            spark, str(tmp_path / "bronze"), lake, checkpoint, dt.date(2024, 1, 20), files_per_batch=5
        ).awaitTermination()

    drain()
    batch = Lakehouse.at(str(tmp_path / "batch"))
    run_range(
        spark, str(tmp_path / "bronze"), batch, configured_cities(spark), DAY, DAY, dt.date(2024, 1, 20)
    )
    assert rows(lake.daily.read(spark)) == rows(batch.daily.read(spark))
    land(tmp_path / "bronze", document(city="tokyo", start=DAYS[1]), city="tokyo", day=DAYS[1])
    drain()
    assert lake.daily.read(spark).count() == 7


def test_landing_of_responses_to_gold(spark, tmp_path):
    """Three days of history, then one more day out of a 48-hour response."""
    cities = configured_cities(spark)
    bare = ["city_name", "city_display_name", "country"]

    def responses(start, hours):
        frame = frame_of(spark, *[document(city=c, start=start, hours=hours) for c in CITIES])
        return frame.withColumn("city", F.col("city_name")).drop(*bare)

    root, lake = str(tmp_path / "bronze"), Lakehouse.at(str(tmp_path / "lake"))
    stamp = F.lit("2024-01-13T06:00:00")
    land_history(responses(DAY, 72), cities, root, stamp)
    run_backfill(spark, root, lake, cities, DAY + dt.timedelta(days=3), 3)
    next_day = DAY + dt.timedelta(days=3)
    assert land_day(responses(next_day, 48), cities, root, next_day, stamp).count() == 0
    short = land_day(responses(next_day, 20), cities, str(tmp_path / "other"), next_day, stamp)
    assert {r["hours"] for r in short.collect()} == {20}
    status = run_daily(spark, root, lake, cities, next_day + dt.timedelta(days=1)).first()
    assert (status["row_count"], status["status"]) == (6, "OK")
    assert lake.daily.read(spark).count() == 24
    lake.create_views(spark)
    per_city = spark.sql(
        "SELECT city_display_name, COUNT(*) AS days FROM gold_daily_summary GROUP BY ALL"
    )
    assert {(r[0], r[1]) for r in per_city.collect()} >= {("Tokyo", 4), ("Mumbai", 4)}
    assert spark.table("silver_hourly").count() == 24 * 24


def test_a_range_reads_its_own_dates(spark, tmp_path):
    spread = [DAY, DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=70), dt.date(2031, 5, 6)]
    for day in spread:
        land(tmp_path, document(start=day, hours=2), day=day)
    land(tmp_path, "", city="delhi")  # an empty file is no document
    for last, count in ((DAY, 1), (spread[1], 2), (spread[2], 3), (spread[3], 4)):
        assert good_documents(read_bronze(spark, str(tmp_path), DAY, last)).count() == count
        assert landed_files(spark, str(tmp_path), DAY, last).count() == count
    assert read_bronze(spark, str(tmp_path), DAY, DAY).first()["month"] == "01"
    nothing = dt.date(2020, 1, 1)
    assert read_bronze(spark, str(tmp_path), nothing, nothing).count() == 0
    assert landed_files(spark, str(tmp_path), nothing, nothing).count() == 0


def test_the_manifest_names_what_is_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")

    def put(day, hours):
        write_bronze(shape.with_partition_keys(frame_of(spark, document(start=day, hours=hours))), root)

    def hours_of(*dates):
        found = good_documents(read_bronze(spark, root, *dates)).select("day", F.size("hourly.time").alias("n"))
        return {r["day"]: r["n"] for r in found.collect()}

    put(DAY, 2)
    put(DAYS[1], 3)
    assert hours_of() == {"10": 2, "11": 3} and hours_of(DAY, DAY) == {"10": 2}
    assert len(read_bronze(spark, root, DAY, DAY).inputFiles()) == 1
    put(DAY, 5)  # the last batch of a city-day counts, and no older one is read
    assert hours_of() == {"10": 5, "11": 3} and len(read_bronze(spark, root).inputFiles()) == 2
    assert {r["day"] for r in landed_files(spark, root, DAY, DAYS[1]).collect()} == {"10", "11"}

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(bronze_source, "record_batch", crash)  # after the files, before the manifest
    with pytest.raises(RuntimeError):
        put(DAY, 7)
    assert hours_of() == {"10": 5, "11": 3}
    nothing = dt.date(2020, 1, 1)
    assert read_bronze(spark, root, nothing, nothing).count() == 0
    assert landed_files(spark, root, nothing, nothing).count() == 0


def test_a_landing_is_parsed_once(spark, tmp_path, monkeypatch):
    """Once it is staged, a run can do without the landing."""
    for city in CITIES:
        land(tmp_path / "bronze", document(city=city), city=city)
    land(tmp_path / "bronze", document(city="delhi", hours=3), city="delhi", name="short")
    record = document(city="delhi")
    record["hourly"] = None
    land(tmp_path / "bronze", record, city="delhi", name="empty")
    stage = runs.staged_landing

    def staged_then_gone(spark, bronze):
        table, counts = stage(spark, bronze)
        assert counts == {"good": 7, "malformed": 0, "no_city": 0, "no_hours": 1, "short": 1}
        (tmp_path / "bronze").rename(tmp_path / "elsewhere")
        return table, counts

    monkeypatch.setattr(runs, "staged_landing", staged_then_gone)
    lake = Lakehouse.at(str(tmp_path / "lake"))
    status = run_range(spark, str(tmp_path / "bronze"), lake, configured_cities(spark), DAY, DAY, DAY).first()
    assert (status["row_count"], status["malformed"], status["short"]) == (6, 1, 1)
    assert [r["reason"] for r in lake.malformed.read(spark).collect()] == ["no_hours"]


def test_catalog_tables_follow_the_current_version(spark, tmp_path):
    lake = Lakehouse.at(str(tmp_path / "lake"), database="follows")
    lake.create_tables(spark)
    lake.create_tables(spark)  # there already
    assert spark.table("follows.silver_hourly").count() == 0
    run_silver(spark, lake, frame_of(spark, document(city="london"), document(city="delhi")))
    assert spark.table("follows.silver_hourly").count() == 48
    run_silver(spark, lake, frame_of(spark, document(city="london", temperature_2m=[None] * 24)))
    assert spark.table("follows.silver_hourly").count() == 24
    run_silver(spark, lake, frame_of(spark, document(city="delhi", hours=0)))
    assert spark.table("follows.silver_hourly").count() == 0  # an empty slice has no partition
    again = Lakehouse.at(str(tmp_path / "lake"), database="later")
    run_silver(spark, lake, frame_of(spark, document(city="tokyo", start=DAYS[1])))
    again.create_tables(spark)  # made after the fact, they see what is there
    assert spark.sql("SELECT DISTINCT city_name FROM later.silver_hourly").collect()[0][0] == "tokyo"


def test_late_documents_reach_gold(spark, tmp_path):
    lake, checkpoint = Lakehouse.at(str(tmp_path / "lake")), str(tmp_path / "checkpoint")
    for day in (dt.date(2024, 5, 1), DAY):  # the second comes sixteen weeks late
        land(tmp_path / "bronze", document(start=day), day=day)
        stream_daily(spark, str(tmp_path / "bronze"), lake, checkpoint, DAY).awaitTermination()
    assert {r["weather_date"] for r in lake.daily.read(spark).collect()} == {DAY, dt.date(2024, 5, 1)}
    assert stream_silver(spark, lake).count() == 48


def test_a_restated_document_replaces_its_partial_summaries(spark, tmp_path):
    lake = Lakehouse.at(str(tmp_path / "lake"))

    def put(name, **series):
        frame = frame_of(spark, document(**series)).withColumn("document", F.lit(name))
        readings = flagged(explode_hours(frame, "document"), "document")
        store_partials(spark, lake.partials, partial_summaries(readings, "document"), frame)

    put("a", hours=12, temperature_2m=[10.0] * 12)
    put("b", hours=12, temperature_2m=[20.0] * 12)
    put("a", hours=6, temperature_2m=[30.0] * 6)
    row = summary_of_partials(lake.partials.read(spark), DAY).first()
    assert (row["record_count"], row["max_temperature"], row["min_temperature"]) == (18, 30.0, 20.0)
    put("b", start=DAYS[1], hours=2)  # moved to another date
    got = {r["weather_date"]: r["record_count"] for r in summary_of_partials(lake.partials.read(spark), DAY).collect()}
    assert got == {DAY: 6, DAYS[1]: 2}
    plan = summary_of_partials(lake.partials.read(spark), DAY)._jdf.queryExecution().executedPlan().toString()
    assert "silver" not in plan and plan.count("FileScan") == 1


def test_a_day_restated_all_bad_loses_its_old_rows(spark, tmp_path):
    lake = Lakehouse.at(str(tmp_path / "lake"))
    run_silver(spark, lake, frame_of(spark, document(city="london"), document(city="delhi")))
    run_silver(spark, lake, frame_of(spark, document(city="london", temperature_2m=[None] * 24)))
    assert {r["city_name"]: r["count"] for r in lake.silver.read(spark).groupBy("city_name").count().collect()} == {"delhi": 24}
    run_silver(spark, lake, frame_of(spark, document(city="delhi", hours=0)))
    assert lake.silver.read(spark).count() == 0


def test_unreadable_times_are_rejected_not_stored(spark, tmp_path):
    lake = Lakehouse.at(str(tmp_path / "lake"))
    record = document(hours=3)
    record["hourly"]["time"][1] = "yesterday"
    frame = frame_of(spark, record)
    run_silver(spark, lake, frame, tolerant=True)
    assert lake.silver.read(spark).count() == 2
    rejected = {r["observation_date"]: r["no_time"] for r in rejects(explode_hours(frame), tolerant=True).collect()}
    assert rejected == {None: 1}


def test_pretty_printed_stream_gives_all_rows(spark, tmp_path, landing):
    lake = Lakehouse.at(str(tmp_path / "lake"))
    stream = stream_daily(
        spark, landing, lake, str(tmp_path / "checkpoint"), dt.date(2024, 1, 20), multi_line=True
    )
    stream.awaitTermination()
    assert lake.daily.read(spark).count() == 18


def test_gold_slices_per_day(spark, tmp_path):
    lake = Lakehouse.at(str(tmp_path / "lake"), gold_slices="yyyy-MM-dd")
    assert lake.daily.slices_in(daily(spark, {})) == [str(DAY)]
