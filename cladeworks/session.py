"""Session helpers."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def on_workers(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it."""
    here = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (here, env.get("PYTHONPATH", "")) if x)
    return spark
