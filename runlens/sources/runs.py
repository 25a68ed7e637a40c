"""Run and experiment scans (lookback window, experiment filter)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.operators.joins import join_dimension


def normalize_run_times(runs: DataFrame) -> DataFrame:
    """Epoch-millisecond or NTZ start/end columns -> session timestamps.

    A missing or zero end time is NULL.
    """
    out = runs
    types = dict(runs.dtypes)
    for c in ("start_time", "end_time"):
        if c not in types:
            continue
        t = types[c]
        if t in ("bigint", "int", "smallint"):
            col = F.col(c) if c == "start_time" else F.nullif(F.col(c), F.lit(0).cast(t))
            out = out.withColumn(c, F.timestamp_millis(col))
        elif t == "timestamp_ntz":
            out = out.withColumn(c, F.col(c).cast(T.TimestampType()))
    return out


def within_lookback(df: DataFrame, as_of: dt.datetime, lookback: str, col: str = "start_time",
                    inclusive: bool = False) -> DataFrame:
    """Rows with ``col`` after ``as_of - lookback`` (strict unless ``inclusive``).

    The bound is a literal, so the predicate reaches the Parquet scan.
    """
    bound = F.lit(as_of) - F.expr(f"INTERVAL {lookback}")
    return df.where(F.col(col) >= bound) if inclusive else df.where(F.col(col) > bound)


def read_experiments(df: DataFrame, filter_expr: str | None = None) -> DataFrame:
    """Experiment scan with an optional SQL filter string."""
    return df.where(F.expr(filter_expr)) if filter_expr else df


def scan_runs(runs: DataFrame, experiments: DataFrame, as_of: dt.datetime, lookback: str,
              experiment_filter: str | None = None) -> DataFrame:
    """Runs of the chosen experiments started strictly after ``as_of - lookback`` and not
    after ``as_of`` (the scan time: a replay for a past ``as_of`` sees what that run saw)."""
    exps = read_experiments(experiments, experiment_filter).select("experiment_id")
    recent = within_lookback(normalize_run_times(runs), as_of, lookback).where(F.col("start_time") <= F.lit(as_of))
    return join_dimension(recent, exps.distinct(), "experiment_id", "left_semi")
