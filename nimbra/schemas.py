"""Declared schemas of every layer; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from nimbra.fixed_values import HOURLY_VARIABLES

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    # Wall-clock time: local for observations, UTC for ingestion.
    "timestamp": T.TimestampNTZType(),
}


def struct(**fields: str | T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(n, t if isinstance(t, T.DataType) else _TYPES[t]) for n, t in fields.items()]
    )


BRONZE_PARTITIONS = ["city", "year", "month", "day"]
CORRUPT_COLUMN = "_corrupt_record"

HOURLY_UNITS = struct(time="string", **dict.fromkeys(HOURLY_VARIABLES, "string"))
HOURLY = struct(
    time=T.ArrayType(T.StringType()),
    **{v: T.ArrayType(_TYPES[t]) for v, t in HOURLY_VARIABLES.items()},
)

BRONZE = struct(
    latitude="double",
    longitude="double",
    generationtime_ms="double",
    utc_offset_seconds="int",
    timezone="string",
    timezone_abbreviation="string",
    elevation="double",
    hourly_units=HOURLY_UNITS,
    hourly=HOURLY,
    ingestion_timestamp="string",
    pipeline_run_date="string",
    city_name="string",
    city_display_name="string",
    country="string",
)

CITY = struct(
    name="string",
    display_name="string",
    latitude="double",
    longitude="double",
    timezone="string",
    country="string",
)

CONFIGURATION = struct(
    cities=T.ArrayType(CITY),
    api_settings=struct(hourly_variables=T.ArrayType(T.StringType()), backfill_days="int"),
)

SILVER = struct(
    city_name="string",
    city_display_name="string",
    country="string",
    latitude="double",
    longitude="double",
    observation_timestamp="timestamp",
    observation_date="date",
    observation_hour="int",
    timezone="string",
    temperature_2m="double",
    apparent_temperature="double",
    relative_humidity_2m="int",
    precipitation="double",
    rain="double",
    wind_speed_10m="double",
    wind_direction_10m="int",
    weather_code="int",
    weather_condition="string",
    uv_index="double",
    ingestion_timestamp="timestamp",
    pipeline_run_date="date",
    data_quality_flag="string",
)

GOLD_DAILY = struct(
    city_name="string",
    city_display_name="string",
    country="string",
    weather_date="date",
    avg_temperature="double",
    max_temperature="double",
    min_temperature="double",
    avg_apparent_temperature="double",
    avg_humidity="double",
    max_humidity="int",
    min_humidity="int",
    total_precipitation="double",
    total_rain="double",
    had_rain="boolean",
    avg_wind_speed="double",
    max_wind_speed="double",
    dominant_wind_direction="int",
    dominant_condition="string",
    dominant_weather_code="int",
    max_uv_index="double",
    avg_uv_index="double",
    temperature_range="double",
    comfort_score="double",
    first_seen_date="date",
    last_updated_date="date",
    pipeline_run_date="date",
    record_count="int",
)

GOLD_EVENTS = struct(
    city_name="string",
    city_display_name="string",
    country="string",
    event_date="date",
    event_type="string",
    severity="string",
    max_temperature="double",
    min_temperature="double",
    total_precipitation="double",
    max_wind_speed="double",
    max_uv_index="double",
    dominant_condition="string",
    detected_on="date",
    pipeline_run_date="date",
)


def bronze_read_schema(variables: list[str] | None = None) -> T.StructType:
    """Bronze schema with its partition columns as text.

    JSON is parsed whole, struct fields are not pruned for it; naming the
    wanted hourly ``variables`` keeps the others out of the parse.
    """
    fields = []
    for field in BRONZE.fields:
        if variables is not None and field.name in ("hourly", "hourly_units"):
            kept = [f for f in field.dataType.fields if f.name == "time" or f.name in variables]
            field = T.StructField(field.name, T.StructType(kept))
        fields.append(field)
    corrupt = T.StructField(CORRUPT_COLUMN, T.StringType())
    keys = [T.StructField(k, T.StringType()) for k in BRONZE_PARTITIONS]
    return T.StructType([*fields, corrupt, *keys])
