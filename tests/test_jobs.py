"""Batch jobs end to end (JOB1-4) on the sf0.001 events fixture."""

import datetime as dt
import os

import pytest

from runlens.plans.context import build
from runlens.plans.jobs import backup_job, delta_job
from runlens.session import scratch_path
from runlens.sinks.snapshots import load_latest, snapshot_log
from runlens.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_delta_window_without_runs_writes_typed_empty_snapshots(spark):
    t = build(spark, SF)
    base = scratch_path(spark, "t-jobs")
    res = delta_job(spark, t.runs, t.experiments, t.metadata, t.thresholds, base, fx.AS_OF)
    assert set(res["written"]) == {"raw_metric_rows", "enriched_metrics", "platform_summary",
                                   "application_summary", "metric_timeseries"}
    assert all(w["rows"] == 0 for w in res["written"].values())
    p = load_latest(spark, base, "platform_summary")
    assert p.count() == 0 and "pass_rate" in p.columns


def test_backup_job_rerun_is_idempotent(spark):
    t = build(spark, SF)
    base = scratch_path(spark, "t-jobs")
    as_of = dt.datetime(2024, 1, 20, 12, 0)
    first = backup_job(spark, t.runs, t.experiments, t.metadata, t.thresholds, base, as_of)
    again = backup_job(spark, t.runs, t.experiments, t.metadata, t.thresholds, base, as_of)
    assert first["run_key"] == again["run_key"] == "backup_2024-01-20T12-00"
    n = first["written"]["enriched_metrics"]["rows"]
    assert n == again["written"]["enriched_metrics"]["rows"]
    assert load_latest(spark, base, "enriched_metrics").count() == n
    assert spark.read.parquet(f"{base}/enriched_metrics").count() == n      # overwritten, not appended
    assert snapshot_log(spark, base).where("table_name = 'enriched_metrics'").count() == 2
    # only runs started in the 6 hours before as_of
    starts = [r["start_time"] for r in load_latest(spark, base, "raw_metric_rows").collect()]
    assert starts and all(as_of - dt.timedelta(hours=6) < s <= as_of for s in starts)
    names = {r["name"] for r in first["metrics"].collect()}
    assert {"record_count_raw_metric_rows", "execution_time_enrich"} <= names


def test_job_metrics_summary_and_sizes(spark):
    from runlens.sinks import metric_log

    t = build(spark, SF)
    base = scratch_path(spark, "t-jobs")
    res = backup_job(spark, t.runs, t.experiments, t.metadata, t.thresholds, base,
                     dt.datetime(2024, 1, 20, 12, 0))
    assert res["written"]["enriched_metrics"]["size_mb"] > 0
    frame = res["metrics"]
    summ = metric_log.summary(frame).first()
    assert summ["total_metrics"] == frame.count() and "data_size_enriched_metrics" in summ["metric_types"]
    assert metric_log.newest(frame).count() == min(10, frame.count())


def test_emptied_snapshot_and_interleaved_jobs(spark):
    from runlens.sinks.snapshots import load_snapshot, write_snapshot

    base, at = scratch_path(spark, "t-snap"), dt.datetime(2024, 1, 20)
    a, b = spark.range(3).selectExpr("id", "'a' as job"), spark.range(2).selectExpr("id", "'b' as job")
    write_snapshot(a, base, "t", "delta_1", at)
    write_snapshot(b, base, "t", "backup_1", at)
    assert {r["job"] for r in load_snapshot(spark, base, "t", "delta_1").collect()} == {"a"}
    assert load_latest(spark, base, "t").count() == 2
    write_snapshot(a.where("id > 9"), base, "t", "delta_1", at)
    assert load_snapshot(spark, base, "t", "delta_1").count() == 0
    assert spark.read.parquet(f"{base}/t").where("snapshot_id = 'delta_1'").count() == 0
