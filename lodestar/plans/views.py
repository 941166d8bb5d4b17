"""The driver's tables seen as catalogue data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.tables import table


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product entities from ``part``; every tenth has no brand."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("seq"),
        F.when(F.col("p_partkey") % 10 == 0, "").otherwise(F.col("p_brand")).alias("brand"),
        F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))), F.lit("-"), F.col("p_size").cast("string")).alias("product_model"),
        F.col("p_type").alias("manufacturer"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("series"),
        F.col("p_type").alias("category"),
    )


#: The same view for DuckDB.
ENTITIES = """
E AS (SELECT p_partkey AS seq, CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_brand END AS brand,
  upper(replace(p_name, ' ', '-')) || '-' || p_size AS product_model, p_type AS manufacturer, split_part(p_name, ' ', 1) AS series, p_type AS category FROM part)"""
