"""ratelake: keyed daily rate series on Spark.

Layers (landing -> bronze -> silver -> gold -> forecast -> serving) are plain
DataFrame -> DataFrame functions built from Spark's own expressions, so every
step is planned by Catalyst and scales with rows and keys.
"""

from ratelake.schemas import (
    BRONZE_SCHEMA,
    FORECAST_SCHEMA,
    LANDING_SCHEMA,
    SILVER_SCHEMA,
    gold_schema,
)

__all__ = [
    "BRONZE_SCHEMA",
    "FORECAST_SCHEMA",
    "LANDING_SCHEMA",
    "SILVER_SCHEMA",
    "gold_schema",
]
