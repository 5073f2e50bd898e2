"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Local wall-clock times are timestamp_ntz, so no result depends on the zone;
# UTC only fixes how zone-aware source columns turn into dates.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles a method of over 8000 bytes; a wide projection that
    # would become one is split into functions below this limit instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Fixed when a session starts. Call-site capture costs several JVM round trips
# per column expression.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller owns."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "nimbra", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **STATIC_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
