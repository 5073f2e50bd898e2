"""Silver to the daily summary: one row per city and date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbra.fixed_values import UNKNOWN_CONDITION, WEATHER_CONDITIONS
from nimbra.functions.exact import EXACT, round_half_away
from nimbra.functions.weather import comfort_score
from nimbra.schemas import GOLD_DAILY, SILVER

KEYS = ["city_name", "weather_date"]


def _lowest_code_by_condition() -> dict[str, Column]:
    """Lowest code seen of each label that stands for several codes.

    Tested on the code, which compares faster than the label.
    """
    code = F.col("weather_code")
    tests = {label: code.isin(codes) for label, codes in WEATHER_CONDITIONS if len(codes) > 1}
    tests[UNKNOWN_CONDITION] = F.col("weather_condition") == UNKNOWN_CONDITION
    return {label: F.min(F.when(test, code)) for label, test in tests.items()}


def _dominant_code() -> Column:
    """Code of the winning condition, from the columns of the aggregate."""
    dominant = F.col("dominant_condition")
    single = [(label, F.lit(c[0])) for label, c in WEATHER_CONDITIONS if len(c) == 1]
    shared = [(label, F.col(f"code of {label}")) for label in _lowest_code_by_condition()]
    return F.coalesce(*[F.when(dominant == label, code) for label, code in [*single, *shared]])


GROUP = ["city_name", "city_display_name", "country", "weather_date"]
#: Labels in descending order of their names, so that on a tie the first name has the largest place.
_LABELS = sorted([label for label, _ in WEATHER_CONDITIONS] + [UNKNOWN_CONDITION], reverse=True)
#: A count and a value in one integer: the largest has the highest count, then the least value.
_COUNT_STEP, _TOP_VALUE = 1 << 32, (1 << 31) - 1


#: Columns of Silver that are added up as decimals.
_SUMMED = [
    "temperature_2m", "apparent_temperature", "precipitation", "rain", "wind_speed_10m", "uv_index",
]
_EXTREMES = {
    "highest": (F.max, "temperature_2m"),
    "lowest": (F.min, "temperature_2m"),
    "max_humidity": (F.max, "relative_humidity_2m"),
    "min_humidity": (F.min, "relative_humidity_2m"),
    "wind": (F.max, "wind_speed_10m"),
    "uv": (F.max, "uv_index"),
}


def _partials() -> dict[str, tuple[Column, Callable]]:
    """Columns of a partial summary: how readings give it, and how several of them are merged."""
    humidity = F.col("relative_humidity_2m")
    states = {"records": (F.count("*"), F.sum)}
    for name in _SUMMED:
        states[f"sum of {name}"] = F.sum(F.col(name).cast(EXACT)), F.sum
        states[f"values of {name}"] = F.count(name), F.sum
    states["sum of humidity"] = F.sum(humidity.cast("bigint")), F.sum
    states["values of humidity"] = F.count(humidity), F.sum
    for name, (extreme, column) in _EXTREMES.items():
        states[name] = extreme(column), extreme
    for label, code in _lowest_code_by_condition().items():
        states[f"code of {label}"] = code, F.min
    for i, label in enumerate(_LABELS):
        states[f"count {i}"] = F.count_if(F.col("weather_condition") == label), F.sum
    return states


PARTIAL_KEYS = [*GROUP, "wind_direction_10m"]


def partial_schema(*carried: str) -> T.StructType:
    """Columns of stored partial summaries; ``carried`` ones are text."""
    kinds = {f.name: f.dataType for f in SILVER.fields} | {"weather_date": T.DateType()}
    fields = [T.StructField(name, kinds[name]) for name in PARTIAL_KEYS]
    fields += [T.StructField(name, T.StringType()) for name in carried]
    for name in _partials():
        if name in _EXTREMES:
            kind = kinds[_EXTREMES[name][1]]
        elif name.startswith("code of "):
            kind = kinds["weather_code"]
        elif name.startswith("sum of ") and name != "sum of humidity":
            kind = T.DecimalType(38, 10)
        else:
            kind = T.LongType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def partial_summaries(silver: DataFrame, *carried: str) -> DataFrame:
    """What a summary needs of its readings, per city-day, wind direction and ``carried``.

    Rows of any split of the readings can be merged by ``summary_of_partials``, so a
    document that is restated replaces its own rows and nothing else is read again.
    """
    readings = silver.where(F.col("data_quality_flag") != "BAD").withColumnRenamed(
        "observation_date", "weather_date"
    )
    return readings.groupBy(*PARTIAL_KEYS, *carried).agg(
        *[state.alias(name) for name, (state, _) in _partials().items()]
    )


def _merged(partials: DataFrame, *keys: str, **more: Column) -> DataFrame:
    merges = [merge(F.col(f"`{name}`")).alias(name) for name, (_, merge) in _partials().items()]
    return partials.groupBy(*keys).agg(*merges, *[c.alias(name) for name, c in more.items()])


def _mean(name: str) -> Column:
    values = F.nullif(F.col(f"values of {name}"), F.lit(0).cast("bigint"))
    return F.col(f"sum of {name}").cast("double") / values


def _summary(partials: DataFrame) -> DataFrame:
    """City-days of partial summaries, one row for each city-day and direction.

    Conditions are a fixed list, so each has a counter. The best direction is the
    greatest count, then the least value, in one integer.
    """
    place = F.col("records") * _COUNT_STEP + (_TOP_VALUE - F.col("wind_direction_10m").cast("bigint"))
    merged = _merged(partials, *GROUP, best=F.max(place))
    most = F.greatest(*[F.col(f"count {i}") * len(_LABELS) + i for i in range(len(_LABELS))])
    labels = F.array(*[F.lit(label) for label in _LABELS])
    return merged.withColumns(
        {
            "dominant_condition": F.get(labels, (most % len(_LABELS)).cast("int")),
            "dominant_wind_direction": (_TOP_VALUE - F.col("best") % _COUNT_STEP).cast("int"),
        }
    )


def summary_of_partials(
    partials: DataFrame, as_of: dt.date, run_date: dt.date | None = None
) -> DataFrame:
    """Daily summary of stored partial summaries, whatever they were split by."""
    return _finished(_summary(_merged(partials, *PARTIAL_KEYS)), as_of, run_date)


def to_daily(silver: DataFrame, as_of: dt.date, run_date: dt.date | None = None) -> DataFrame:
    """Daily summary of every city-day in ``silver`` (all 27 columns), in one scan.

    Hash aggregates over plain numbers, first per city-day and wind direction, then per
    city-day. Both combine rows in the input tasks; what is shuffled is one partial row
    for each direction of a city-day and task, whatever the size of the city-day.

    ``as_of`` stamps the audit dates. A range of days carries each day's own
    date as run date unless ``run_date`` is given.
    """
    return _finished(_summary(partial_summaries(silver)), as_of, run_date)


def _finished(summary: DataFrame, as_of: dt.date, run_date: dt.date | None) -> DataFrame:
    run = F.lit(run_date) if run_date else F.col("weather_date")
    measures = {
        "mean_temperature": _mean("temperature_2m"),
        "mean_humidity": _mean("humidity"),
        "precipitation": F.col("sum of precipitation").cast("double"),
        "record_count": F.col("records").cast("int"),
    }
    rounded = {
        "avg_temperature": F.col("mean_temperature"),
        "max_temperature": F.col("highest"),
        "min_temperature": F.col("lowest"),
        "avg_apparent_temperature": _mean("apparent_temperature"),
        "avg_humidity": F.col("mean_humidity"),
        "total_precipitation": F.col("precipitation"),
        "total_rain": F.col("sum of rain").cast("double"),
        "avg_wind_speed": _mean("wind_speed_10m"),
        "max_wind_speed": F.col("wind"),
        "max_uv_index": F.col("uv"),
        "avg_uv_index": _mean("uv_index"),
        "temperature_range": F.col("highest") - F.col("lowest"),
    }
    return summary.withColumns(measures).withColumns(
        {
            **{name: round_half_away(x, 2) for name, x in rounded.items()},
            # A day without any precipitation value is a day without rain.
            "had_rain": F.coalesce(F.col("precipitation") > 0, F.lit(False)),
            "dominant_weather_code": _dominant_code(),
            "comfort_score": comfort_score(F.col("mean_temperature"), F.col("mean_humidity")),
            "first_seen_date": F.lit(as_of),
            "last_updated_date": F.lit(as_of),
            "pipeline_run_date": run,
        }
    ).select(GOLD_DAILY.fieldNames())


def condition_counts(silver: DataFrame) -> DataFrame:
    """Readings per city, date and condition."""
    return silver.groupBy("city_name", "observation_date", "weather_condition").agg(
        F.count("*").alias("condition_count")
    )


#: Directions that a sketch counts exactly: there are 360.
SKETCHED = 1024


def wind_sketches(silver: DataFrame) -> DataFrame:
    """A frequent-items sketch of the wind directions of every city-day, to be stored and
    combined over any span of days without reading the readings again."""
    kept = silver.where((F.col("data_quality_flag") != "BAD") & F.col("wind_direction_10m").isNotNull())
    sketch = F.call_function("approx_top_k_accumulate", F.col("wind_direction_10m"), F.lit(SKETCHED))
    return kept.groupBy("city_name", F.col("observation_date").alias("weather_date")).agg(sketch.alias("directions"))


def dominant_wind(sketches: DataFrame, *keys: str | Column) -> DataFrame:
    """The direction with the greatest count of all sketches of a group, the least one on a
    tie, and that count. Exact while a group has no more directions than a sketch holds."""
    combined = F.call_function("approx_top_k_combine", F.col("directions"), F.lit(SKETCHED))
    found = F.call_function("approx_top_k_estimate", F.col("combined"), F.lit(SKETCHED))
    places = F.transform(found, lambda x: F.struct(x["count"].alias("n"), (-x["item"]).alias("minus")))
    return (
        sketches.groupBy(*keys)
        .agg(combined.alias("combined"))
        .withColumn("best", F.array_max(places))
        .withColumns({"dominant_wind_direction": (-F.col("best.minus")).cast("int"), "hours": F.col("best.n")})
        .drop("combined", "best")
    )
