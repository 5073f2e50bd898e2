"""Runs store what is no document and what Silver leaves out."""

from __future__ import annotations

import datetime as dt

import pytest

from nimbra.operators import gates
from nimbra.plans.runs import Lakehouse, run_daily, run_range
from nimbra.sources.cities import configured_cities
from nimbra.streaming.ingest import stream_daily
from tests.helpers import DAY, document, land

CITIES = ["mumbai", "delhi", "bangalore", "london", "new_york", "tokyo"]


@pytest.fixture
def landing(tmp_path):
    for city in CITIES:
        land(tmp_path / "bronze", document(city=city), city=city)
    land(tmp_path / "bronze", document(city="delhi", temperature_2m=[None, *[20.0] * 23]), city="delhi")
    folder = tmp_path / f"bronze/city=tokyo/year={DAY:%Y}/month={DAY:%m}/day={DAY:%d}"
    (folder / "broken.json").write_text('{"city_name": "tok\n{"country": "Japan"}\n')
    return tmp_path / "bronze"


def test_a_run_stores_and_counts_them(spark, tmp_path, landing):
    lake, cities = Lakehouse.at(str(tmp_path / "lake")), configured_cities(spark)
    today = DAY + dt.timedelta(days=1)
    for _ in range(2):
        status = run_daily(spark, str(landing), lake, cities, today).first()
        assert (status["status"], status["malformed"], status["rejected"]) == ("OK", 2, 1)
        bad = {(r["landed_date"], r["city"], r["document"]) for r in lake.malformed.read(spark).collect()}
        assert bad == {(DAY, "tokyo", '{"city_name": "tok'), (DAY, "tokyo", '{"country":"Japan"}')}
        assert [(r["city_name"], r["no_temperature"]) for r in lake.rejects.read(spark).collect()] == [("delhi", 1)]


def test_a_city_day_of_broken_documents_fails_the_gate(spark, tmp_path, landing):
    for file in (landing / "city=tokyo").rglob("*.json"):
        file.write_text('{"city_name": "tok\n')
    lake, cities = Lakehouse.at(str(tmp_path / "lake")), configured_cities(spark)
    with pytest.raises(gates.GateFailed, match="tokyo"):
        run_range(spark, str(landing), lake, cities, DAY, DAY, DAY)
    assert lake.malformed.read(spark).count() >= 1


def test_the_stream_stores_them(spark, tmp_path, landing):
    lake = Lakehouse.at(str(tmp_path / "lake"))
    for _ in range(2):
        stream_daily(spark, str(landing), lake, str(tmp_path / "checkpoint"), DAY).awaitTermination()
    assert spark.read.parquet(f"{lake.malformed.root}/stream/*").count() == 2
    assert spark.read.parquet(f"{lake.rejects.root}/stream/*").count() == 1
