"""Session settings that suit the engine's wide rows and its joins."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Feature rows have 285 columns. Methods the JVM would not compile are worse than no codegen.
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
