"""Column expressions of the domain: decode, quality, events, comfort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbra import fixed_values as V
from nimbra.functions.exact import round_half_away


def condition_label(code: Column) -> Column:
    """Label of a weather code; unlisted and null codes are 'Unknown'."""
    (label, codes), *rest = V.WEATHER_CONDITIONS
    chain = F.when(code.isin(codes), label)
    for label, codes in rest:
        chain = chain.when(code.isin(codes), label)
    return chain.otherwise(V.UNKNOWN_CONDITION)


def quality_flag(temperature: Column, humidity: Column, wind: Column) -> Column:
    """BAD when a core measure is missing, SUSPECT when one is implausible, else GOOD."""
    core = {
        "temperature_2m": temperature,
        "relative_humidity_2m": humidity,
        "wind_speed_10m": wind,
    }
    missing = reduce(Column.__or__, [c.isNull() for c in core.values()])
    plausible = reduce(Column.__and__, [c.between(*V.PLAUSIBLE[n]) for n, c in core.items()])
    return F.when(missing, "BAD").when(plausible, "GOOD").otherwise("SUSPECT")


def comfort_score(avg_temperature: Column, avg_humidity: Column) -> Column:
    """0-100; null when either mean is null (greatest/least would skip it)."""
    raw = round_half_away(
        F.lit(100.0)
        - F.abs(avg_temperature - V.IDEAL_TEMPERATURE) * V.TEMPERATURE_PENALTY
        - F.abs(avg_humidity - V.IDEAL_HUMIDITY) * V.HUMIDITY_PENALTY,
        2,
    )
    return F.when(raw.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw)))


def event_tests() -> list[tuple[str, Column]]:
    """(event type, test on a daily summary row), in order of precedence."""
    return [
        ("EXTREME_HEAT", F.col("max_temperature") > V.HEAT_ABOVE),
        ("EXTREME_COLD", F.col("min_temperature") < V.COLD_BELOW),
        ("HEAVY_RAIN", F.col("total_precipitation") > V.RAIN_ABOVE),
        ("STRONG_WIND", F.col("max_wind_speed") > V.WIND_ABOVE),
        ("HIGH_UV", F.col("max_uv_index") > V.UV_ABOVE),
        ("THUNDERSTORM", F.col("dominant_weather_code").isin(V.STORM_CODES)),
    ]


def is_extreme() -> Column:
    return reduce(Column.__or__, [test for _, test in event_tests()])


def event_type() -> Column:
    """First threshold crossed; null when none is."""
    return F.coalesce(*[F.when(test, name) for name, test in event_tests()])


def event_types() -> Column:
    """Every threshold crossed, as an array."""
    return F.array_compact(F.array(*[F.when(test, name) for name, test in event_tests()]))


def severity() -> Column:
    """Level by temperature, rain or wind, whatever the event type."""
    levels = [
        F.when(
            (F.col("max_temperature") > heat)
            | (F.col("total_precipitation") > rain)
            | (F.col("max_wind_speed") > wind),
            level,
        )
        for level, heat, rain, wind, _ in V.SEVERITIES
    ]
    return F.coalesce(*levels, F.lit(V.LOWEST_SEVERITY[0]))


def severity_weight(level: Column) -> Column:
    """3, 2, 1 from CRITICAL down to WATCH; 0 for anything else."""
    weights = [(lv, w) for lv, *_, w in V.SEVERITIES] + [V.LOWEST_SEVERITY]
    return F.coalesce(*[F.when(level == lv, w) for lv, w in weights], F.lit(0))
