"""Batch monitoring jobs: delta (1 h), backup (6 h), historical (30 days).

One job = scan runs in the lookback window -> flatten -> enrich -> series windows
-> write ``enriched`` once (a lineage cut in the shared folder) -> derive the
three dashboard tables from the written copy -> write them. Re-running with the
same run key replaces the same snapshot partitions.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators import summaries as sm
from runlens.operators.enrich import enrich
from runlens.operators.flatten import flatten_runs
from runlens.operators.profiles import status_distribution
from runlens.operators.series import series_windows
from runlens.sinks import metric_log
from runlens.sinks.snapshots import compact_log, load_snapshot, run_key, snapshot_log, write_snapshot
from runlens.sources.runs import scan_runs

# Schedule presets (kind, lookback).
DELTA = ("delta", "1 HOURS")
BACKUP = ("backup", "6 HOURS")
HISTORICAL = ("historical", "720 HOURS")


def run_job(spark: SparkSession, runs: DataFrame, experiments: DataFrame, metadata: DataFrame,
            thresholds: DataFrame, out_base: str, as_of: dt.datetime, kind: str, lookback: str,
            experiment_filter: str | None = None) -> dict:
    """Run one job; ``metrics`` of the result is the stored metrics table of this folder."""
    key = run_key(kind, as_of)
    written, steps, began = {}, {}, dt.datetime.now()
    compact_log(spark, out_base)
    with _timed(steps, "ingest"):
        scanned = scan_runs(runs, experiments, as_of, lookback, experiment_filter)
        rows = flatten_runs(scanned, experiments, as_of)
        written["raw_metric_rows"] = write_snapshot(rows, out_base, "raw_metric_rows", key, as_of, infer=True)
    with _timed(steps, "enrich"):
        rows = load_snapshot(spark, out_base, "raw_metric_rows", key)
        enriched = series_windows(enrich(rows, metadata, thresholds, as_of))
        written["enriched_metrics"] = write_snapshot(enriched, out_base, "enriched_metrics", key, as_of)
    enriched = load_snapshot(spark, out_base, "enriched_metrics", key)
    outputs = {
        "platform_summary": sm.platform_summary(enriched, as_of),
        "application_summary": sm.application_summary(enriched, as_of).drop("metrics"),
        "metric_timeseries": sm.sort_timeseries(sm.metric_timeseries(enriched, as_of)),
    }
    for name, df in outputs.items():
        with _timed(steps, name):
            written[name] = write_snapshot(df, out_base, name, key, as_of, sort_by_time=False)
    now, path = dt.datetime.now(), f"{out_base.rstrip('/')}/_job_metrics"
    own = snapshot_log(spark, out_base).where((F.col("snapshot_id") == key) & (F.col("written_at") >= F.lit(began)))
    metric_log.append(
        metric_log.snapshot_volumes(own)
        .unionByName(metric_log.status_shares(status_distribution(enriched), now))
        .unionByName(metric_log.durations(spark, steps, now)).coalesce(1), path)   # a few dozen rows
    return {"run_key": key, "written": written, "metrics": metric_log.stored(spark, path)}


@contextlib.contextmanager
def _timed(steps: dict[str, float], name: str):
    start = time.perf_counter()
    try:
        yield
    finally:
        steps[name] = (time.perf_counter() - start) * 1000


def delta_job(spark, runs, experiments, metadata, thresholds, out_base, as_of, **kw) -> dict:
    return run_job(spark, runs, experiments, metadata, thresholds, out_base, as_of, *DELTA, **kw)


def backup_job(spark, runs, experiments, metadata, thresholds, out_base, as_of, **kw) -> dict:
    return run_job(spark, runs, experiments, metadata, thresholds, out_base, as_of, *BACKUP, **kw)


def historical_job(spark, runs, experiments, metadata, thresholds, out_base, as_of, **kw) -> dict:
    return run_job(spark, runs, experiments, metadata, thresholds, out_base, as_of, *HISTORICAL, **kw)
