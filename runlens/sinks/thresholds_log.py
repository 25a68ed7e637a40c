"""Threshold upserts as a stored append-only log with a latest-wins current view."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens import schemas as S
from runlens.sources.dimensions import latest_thresholds

DEFAULT_UPDATER = "runlens-job"


def upsert_rows(log: DataFrame, updates: DataFrame, updated_by: str = DEFAULT_UPDATER,
                updated_at: dt.datetime | None = None) -> DataFrame:
    """Append ``updates`` (metric_name, critical_threshold, warning_threshold,
    experiment_id) stamped with ``updated_at`` / ``updated_by`` to ``log``."""
    return log.select(*[f.name for f in S.THRESHOLDS.fields]).unionByName(stamped(updates, updated_by, updated_at))


def stamped(updates: DataFrame, updated_by: str = DEFAULT_UPDATER, updated_at: dt.datetime | None = None) -> DataFrame:
    stamp = F.lit(updated_at) if updated_at is not None else F.current_timestamp()
    return updates.select(
        "metric_name", F.col("critical_threshold").cast("double"), F.col("warning_threshold").cast("double"),
        F.nullif(F.col("experiment_id"), F.lit("")).alias("experiment_id"),
        stamp.alias("updated_at"), F.lit(updated_by).alias("updated_by"),
    )


def current_thresholds(log: DataFrame) -> DataFrame:
    """Newest row per (metric_name, experiment_id), NULL ids grouped together."""
    return latest_thresholds(log)


def append(rows: DataFrame, path: str) -> None:
    """Add rows of the threshold columns to the stored log."""
    rows.select(*[f.name for f in S.THRESHOLDS.fields]).write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.THRESHOLDS).parquet(path)
