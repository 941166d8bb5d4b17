"""Reading the driver's tables by Spark's own readers, from any file system Spark knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``; the session is made ready for this package on the way."""
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
