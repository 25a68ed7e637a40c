"""Runs -> one row per (run, metric)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens import schemas as S
from runlens.functions.stats import nan_to_null
from runlens.operators.joins import join_dimension
from runlens.sources.runs import normalize_run_times


def flatten_runs(runs: DataFrame, experiments: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Explode the metrics map (runs without metrics vanish), attach the experiment
    name (inner: runs of unknown experiments are skipped), read user and run name
    from tags, stamp the extraction time. Output schema: ``METRIC_ROW``.
    """
    stamp = F.lit(as_of) if as_of is not None else F.current_timestamp()
    r = normalize_run_times(runs)
    exps = experiments.select("experiment_id", F.col("name").alias("experiment_name"))
    r = join_dimension(r, exps, "experiment_id", "inner")
    return r.select(
        "run_id",
        "experiment_id",
        "experiment_name",
        F.coalesce(F.try_element_at("tags", F.lit(S.TAG_USER)), F.lit("unknown")).alias("user_id"),
        F.coalesce(F.try_element_at("tags", F.lit(S.TAG_RUN_NAME)), F.substring("run_id", 1, 8)).alias("run_name"),
        "start_time",
        "end_time",
        "status",
        F.explode("metrics").alias("metric_name", "metric_value"),
        "params",
        "tags",
        stamp.alias("extraction_timestamp"),
    ).withColumn("metric_value", nan_to_null(F.col("metric_value")))
