"""Plain table sinks: Parquet paths, managed tables, views, parameterised SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def create_table(df: DataFrame, name: str) -> None:
    """Create or replace a persistent table in the session catalog."""
    df.write.mode("overwrite").saveAsTable(name)


def register(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def execute(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """SQL with named parameters (``:name`` markers) bound as literals."""
    return spark.sql(query, args=params) if params else spark.sql(query)
