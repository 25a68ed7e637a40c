"""Metric rows -> enriched rows: metadata, two-level thresholds, health status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions.stats import nan_to_null
from runlens.functions.status import health_status, threshold_source
from runlens.operators.joins import sized_side
from runlens.sources.dimensions import dedupe_metadata, latest_thresholds

META_COLS = ["display_name", "description", "unit", "category", "higher_is_better"]


def _threshold_sides(thresholds: DataFrame):
    t = latest_thresholds(thresholds)
    overrides = t.where(F.col("experiment_id").isNotNull()).select(
        "metric_name", "experiment_id",
        F.col("critical_threshold").alias("_o_crit"),
        F.col("warning_threshold").alias("_o_warn"),
        F.lit(True).alias("_o_hit"),
    )
    platform = t.where(F.col("experiment_id").isNull()).select(
        "metric_name",
        F.col("critical_threshold").alias("_p_crit"),
        F.col("warning_threshold").alias("_p_warn"),
        F.lit(True).alias("_p_hit"),
    )
    return overrides, platform


def resolve_thresholds(rows: DataFrame, thresholds: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """(metric, experiment) override first, else the (metric, platform) default.

    The whole override row is taken when matched. Both sides are dimensions joined
    by broadcast after a size check. Rows with no threshold are dropped unless
    ``keep_unmatched`` (then ``threshold_source`` is NULL).
    """
    overrides, platform = _threshold_sides(thresholds)
    j = rows.join(sized_side(overrides), ["metric_name", "experiment_id"], "left").join(
        sized_side(platform), "metric_name", "left"
    )
    hit = F.coalesce(F.col("_o_hit"), F.lit(False))
    out = j.select(
        *[F.col(c) for c in rows.columns],
        F.when(hit, F.col("_o_crit")).otherwise(F.col("_p_crit")).alias("critical_threshold"),
        F.when(hit, F.col("_o_warn")).otherwise(F.col("_p_warn")).alias("warning_threshold"),
        F.when(hit | F.col("_p_hit").isNotNull(), threshold_source(hit)).alias("threshold_source"),
    )
    return out if keep_unmatched else out.where(F.col("threshold_source").isNotNull())


def attach_metadata(rows: DataFrame, metadata: DataFrame, how: str = "inner") -> DataFrame:
    meta = dedupe_metadata(metadata).select("metric_name", *META_COLS)
    return rows.join(sized_side(meta), "metric_name", how)


def enrich(metric_rows: DataFrame, metadata: DataFrame, thresholds: DataFrame,
           as_of: dt.datetime | None = None) -> DataFrame:
    """Attach metadata (inner) and thresholds (two-level, drop unmatched), classify.

    ``status`` becomes the health status as in the source model; the run's own
    state is kept as ``run_state``.
    """
    stamp = F.lit(as_of) if as_of is not None else F.current_timestamp()
    rows = metric_rows.withColumn("metric_value", nan_to_null(F.col("metric_value"))).withColumnRenamed(
        "status", "run_state"
    )
    rows = attach_metadata(rows, metadata)
    rows = resolve_thresholds(rows, thresholds)
    status = health_status(F.col("metric_value"), F.col("higher_is_better"),
                           F.col("critical_threshold"), F.col("warning_threshold"))
    return rows.withColumn("status", status).withColumn("enrichment_timestamp", stamp)


def unmatched_metrics(metric_rows: DataFrame, metadata: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Rows the enrichment drops, counted by (metric_name, experiment_id, reason)."""
    meta = dedupe_metadata(metadata).select("metric_name", F.lit(True).alias("_has_meta"))
    rows = metric_rows.select("metric_name", "experiment_id").join(sized_side(meta), "metric_name", "left")
    rows = resolve_thresholds(rows, thresholds, keep_unmatched=True)
    reason = (
        F.when(F.col("_has_meta").isNull(), F.lit("no_metadata"))
        .when(F.col("threshold_source").isNull(), F.lit("no_threshold"))
    )
    return (
        rows.select("metric_name", "experiment_id", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
        .groupBy("metric_name", "experiment_id", "reason")
        .agg(F.count(F.lit(1)).alias("dropped_rows"))
    )


def threshold_resolution(enriched: DataFrame) -> DataFrame:
    """Resolved limits per (experiment, metric) present in the batch."""
    return enriched.groupBy(
        "experiment_id", "metric_name", "critical_threshold", "warning_threshold", "threshold_source"
    ).agg(F.count(F.lit(1)).alias("rows"))
