"""City dimension: the built-in configuration or one read from a JSON file."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbra.fixed_values import BACKFILL_DAYS, CITIES, HOURLY_VARIABLES
from nimbra.schemas import CITY, CONFIGURATION


def configured_cities(spark: SparkSession) -> DataFrame:
    """The configured cities as a literal relation.

    Its size is known to the optimizer, which broadcasts it when it fits the
    broadcast threshold; no hint is needed.
    """
    rows = ", ".join(
        f"('{c['name']}', '{c['display_name']}', {c['latitude']}D, {c['longitude']}D, "
        f"'{c['timezone']}', '{c['country']}')"
        for c in CITIES
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS city({', '.join(CITY.fieldNames())})")


def configuration_text() -> str:
    return json.dumps(
        {
            "cities": CITIES,
            "api_settings": {
                "hourly_variables": list(HOURLY_VARIABLES),
                "backfill_days": BACKFILL_DAYS,
            },
        }
    )


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """City rows of a configuration document ``{"cities": [...], ...}``."""
    document = spark.read.schema(CONFIGURATION).option("multiLine", True).json(path)
    return document.select(F.inline("cities"))
