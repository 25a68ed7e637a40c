"""Shared construction of the monitoring tables from one test-data directory."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators.enrich import enrich
from runlens.operators.flatten import flatten_runs
from runlens.operators.series import series_windows
from runlens.session import scratch_path
from runlens.sources import fixtures as fx

AS_OF = fx.AS_OF


@dataclass
class Tables:
    spark: SparkSession
    events: DataFrame
    runs: DataFrame
    experiments: DataFrame
    metadata: DataFrame
    thresholds: DataFrame
    metric_rows: DataFrame

    @cached_property
    def enriched_base(self) -> DataFrame:
        """The classified rows, materialised when first asked for."""
        return _by_day(enrich(self.metric_rows, self.metadata, self.thresholds, AS_OF), "classified")

    @cached_property
    def classified(self) -> DataFrame:
        """The rows series_windows keeps (non-NULL series key), for consumers that need only statuses: the same rows
        without the window work."""
        return self.enriched_base.where(F.col("experiment_id").isNotNull() & F.col("metric_name").isNotNull())

    @cached_property
    def enriched(self) -> DataFrame:
        return series_windows(self.enriched_base)


_BUILT: dict = {}


def build(spark: SparkSession, sf_dir: str) -> Tables:
    """The monitoring tables of one test-data directory, built once per session.

    The first call materialises the run table (see ``_build``), the first use of ``enriched_base`` the
    classified rows; everything else stays a lazy plan over them.
    """
    key = (spark, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = _build(spark, sf_dir)
    return _BUILT[key]


def _build(spark: SparkSession, sf_dir: str) -> Tables:
    """Tables in the shared folder (``spark.checkpoint.dir``), written once as Parquet by day of
    start_time: the run table (events -> two shuffles) and, for the queries that use them, the classified rows (dimension joins).
    Plans that use a table several times re-read its files, with only the columns and row groups they
    need (a day's files hold that day's start times, so time filters skip the others)."""
    events = fx.load_events(spark, sf_dir)
    runs = _by_day(fx.user_days(events), "runs", fx.runs_of)
    exps = fx.experiments(spark)
    return Tables(spark, events, runs, exps, fx.metric_metadata(spark), fx.thresholds(spark), flatten_runs(runs, exps, AS_OF))


def _by_day(df: DataFrame, name: str, derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """``derive(df)`` as files by day; its columns are made after the rows have been dealt out."""
    path = scratch_path(df.sparkSession, name)
    # Rows of a day together, in tasks of the session's advisory partition size: small days share a task, a large day has several tasks and files.
    day = F.to_date("start_time")
    rows = derive(df.withColumn("start_day", day).hint("rebalance", F.col("start_day")))
    rows.withColumn("start_day", day).write.partitionBy("start_day").parquet(path)
    return df.sparkSession.read.schema(rows.drop("start_day").schema).parquet(path)
