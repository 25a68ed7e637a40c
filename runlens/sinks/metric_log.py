"""Metrics of jobs (PM1-5) as a stored table: name, value, unit, timestamp, tags.

A measurement is a DataFrame of such rows, computed by Spark from the data, from the snapshot log or
from a status distribution, and appended to Parquet in the shared folder. Only the duration of a step is known to the driver
alone; it enters as a literal row. Summaries are queries over the stored table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens import schemas as S

# Metric names and units.
ROWS_NAME, ROWS_UNIT = "record_count_", "records"
SIZE_NAME, SIZE_UNIT = "data_size_", "MB"
SHARE_NAME, SHARE_UNIT = "status_percentage_", "%"
TIME_NAME, TIME_UNIT = "execution_time_", "ms"


def _row(name: Column, value: Column, unit: str, at: Column, **tags: Column) -> Column:
    pairs = [x for k, v in tags.items() for x in (F.lit(k), v)]
    kept = F.create_map(*pairs) if pairs else F.create_map().cast(S.STR_MAP)
    return F.struct(name.alias("name"), value.cast("double").alias("value"), F.lit(unit).alias("unit"),
                    at.alias("timestamp"), kept.alias("tags"))


def _rows(df: DataFrame, *rows: Column) -> DataFrame:
    return df.select(F.inline(F.array(*rows)))


def row_count(df: DataFrame, dataset: str, at: dt.datetime) -> DataFrame:
    """How many rows ``df`` has."""
    name = F.lit(dataset)
    return _rows(df.agg(F.count(F.lit(1)).alias("n")),
                 _row(F.concat(F.lit(ROWS_NAME), name), F.col("n"), ROWS_UNIT, F.lit(at), dataset=name))


def snapshot_volumes(log: DataFrame) -> DataFrame:
    """Rows and megabytes of the logged snapshots (observed and listed when they were written)."""
    name, at = F.col("table_name"), F.col("written_at")
    return _rows(log, _row(F.concat(F.lit(ROWS_NAME), name), F.col("rows"), ROWS_UNIT, at, dataset=name),
                 _row(F.concat(F.lit(SIZE_NAME), name), F.col("size_mb"), SIZE_UNIT, at, dataset=name))


def status_shares(distribution: DataFrame, at: dt.datetime) -> DataFrame:
    """Percentage per status."""
    status = F.col("status")
    return _rows(distribution, _row(F.concat(F.lit(SHARE_NAME), status), F.coalesce("percentage", F.lit(0.0)), SHARE_UNIT,
                                    F.lit(at), status=status))


def durations(spark: SparkSession, steps: dict[str, float], at: dt.datetime) -> DataFrame:
    """Milliseconds per step of one job."""
    return _rows(spark.range(1), *[_row(F.lit(TIME_NAME + k), F.lit(float(v)), TIME_UNIT, F.lit(at), step=F.lit(k))
                                   for k, v in steps.items()])


def append(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PIPELINE_METRIC).parquet(path)


def summary(metrics: DataFrame) -> DataFrame:
    """One row: how many values, their time range and the distinct names."""
    seen = F.col("timestamp")
    return metrics.agg(F.count(F.lit(1)).alias("total_metrics"), F.min(seen).alias("time_range_start"),
                       F.max(seen).alias("time_range_end"), F.array_sort(F.collect_set("name")).alias("metric_types"))


def newest(metrics: DataFrame, k: int = 10) -> DataFrame:
    """The k newest values; equal times by name, then value."""
    return metrics.orderBy(F.desc("timestamp"), "name", "value").limit(k).select("name", "value", "unit", "timestamp")
