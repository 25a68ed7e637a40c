"""Flattening edge cases (PRJ1-4) and stream revisions (ST1-2)."""

import datetime as dt

from pyspark.sql import functions as F

from runlens import schemas as S
from runlens.operators import summaries as sm
from runlens.operators.flatten import flatten_runs
from runlens.session import scratch_path
from runlens.sources import fixtures as fx
from runlens.streaming.incremental import land_extract, latest_wins, read_current, read_hourly, run_incremental
from tests.helpers import T0, metric_rows

MS = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def _raw(spark, rows):
    return spark.createDataFrame(rows, S.RUNS_RAW)


def test_run_without_metrics_vanishes_and_end_zero_is_null(spark):
    raw = _raw(spark, [
        ("run-a-0001", "1", MS, 0, "FINISHED", {"click": 1.0}, None, {"mlflow.user": "ann"}),
        ("run-b-0002", "1", MS, MS + 5000, "FINISHED", {}, None, {}),
        ("run-c-0003", "9", MS, MS + 5000, "FINISHED", {"click": 2.0}, None, {}),     # unknown experiment
    ])
    out = flatten_runs(raw, fx.experiments(spark), T0).collect()
    assert [(r["run_id"], r["end_time"], r["user_id"], r["run_name"]) for r in out] == [
        ("run-a-0001", None, "ann", "run-a-00")]
    assert out[0]["start_time"] == T0


def test_trend_null_for_single_row(spark):
    from runlens.operators.enrich import enrich

    e = enrich(metric_rows(spark, [("r1", "0", "click", 2.0, T0)]), fx.metric_metadata(spark), fx.thresholds(spark), T0)
    s = sm.app_metric_summary(e, T0 + dt.timedelta(days=1)).first()
    assert s["trend_correlation"] is None and s["stddev_value"] is None


def test_latest_wins_takes_newest_extraction(spark):
    rows = metric_rows(spark, [("r1", "0", "click", 30.0, T0), ("r1", "0", "click", 5.0, T0)])
    stamped = rows.withColumn("extraction_timestamp",
                              F.when(F.col("metric_value") == 5.0, F.lit(T0 + dt.timedelta(minutes=5)))
                              .otherwise(F.lit(T0)))
    assert [r["metric_value"] for r in latest_wins(stamped).collect()] == [5.0]


def test_stream_revision_changes_hour(spark):
    """A re-read run whose value changed: the hour is recomputed from the newest copy."""
    work = scratch_path(spark, "t-stream")
    landing = f"{work}/landing"
    meta, thr = fx.metric_metadata(spark), fx.thresholds(spark)
    first = metric_rows(spark, [("r1", "0", "click", 30.0, T0), ("r2", "0", "click", 30.0, T0)]).drop(
        "extraction_timestamp")
    land_extract(first, landing, T0 + dt.timedelta(minutes=1))
    history, hourly = run_incremental(spark, landing, work, meta, thr, T0)
    h = read_hourly(spark, hourly).collect()
    assert [(r["total_runs"], r["critical_runs"]) for r in h] == [(2, 0)]

    revised = metric_rows(spark, [("r1", "0", "click", 5.0, T0)]).drop("extraction_timestamp")
    land_extract(revised, landing, T0 + dt.timedelta(minutes=6))
    history, hourly = run_incremental(spark, landing, work, meta, thr, T0)
    h = read_hourly(spark, hourly).collect()
    assert [(r["total_runs"], r["critical_runs"], r["pass_rate"]) for r in h] == [(2, 1, 50.0)]
    cur = {r["run_id"]: r["metric_value"] for r in read_current(spark, history).collect()}
    assert cur == {"r1": 5.0, "r2": 30.0}


def _hours(spark, hourly):
    return {r["time_hour"]: r["total_runs"] for r in read_hourly(spark, hourly).collect()}


def test_moved_run_counts_once(spark):
    """A run moves to the next day, another run revives its old day, then the run moves back."""
    work = scratch_path(spark, "t-moved")
    landing = f"{work}/landing"
    meta, thr = fx.metric_metadata(spark), fx.thresholds(spark)
    day = dt.timedelta(days=1)

    def land(minute, *rows):
        land_extract(metric_rows(spark, list(rows)).drop("extraction_timestamp"), landing, T0 + dt.timedelta(minutes=minute))
        return run_incremental(spark, landing, work, meta, thr, T0)

    history, hourly = land(1, ("r1", "0", "click", 30.0, T0), ("r1", "0", "view", 30.0, T0))
    assert _hours(spark, hourly) == {T0: 1}
    land(2, ("r1", "0", "click", 30.0, T0 + day))
    assert _hours(spark, hourly) == {T0 + day: 1}                      # the emptied day is gone
    land(3, ("r2", "0", "click", 30.0, T0))
    assert _hours(spark, hourly) == {T0: 1, T0 + day: 1}               # r1 stays out of its old day
    land(1, ("r1", "0", "click", 30.0, T0))                            # an old extract comes in late
    assert _hours(spark, hourly) == {T0: 1, T0 + day: 1}
    land(4, ("r1", "0", "click", 30.0, T0))
    assert _hours(spark, hourly) == {T0: 2}
    assert sorted((r["run_id"], r["metric_name"], r["start_time"]) for r in read_current(spark, history).collect()) == [
        ("r1", "click", T0), ("r2", "click", T0)]


def test_two_months_in_order_lose_no_closed_hour(spark):
    from runlens.streaming.incremental import late_hours, run_watermarked

    work = scratch_path(spark, "t-months")
    landing = f"{work}/landing"
    meta, thr = fx.metric_metadata(spark), fx.thresholds(spark)
    starts = [T0 + dt.timedelta(days=i) for i in range(0, 59, 3)]
    for n, part in enumerate((starts[:10], starts[10:])):
        rows = metric_rows(spark, [(f"r{s:%m%d}", "0", "click", 30.0, s) for s in part]).drop("extraction_timestamp")
        land_extract(rows, landing, T0 + dt.timedelta(minutes=n))
        out = run_watermarked(spark, landing, work, meta, thr, T0)
    assert sorted(r["time_hour"] for r in spark.read.parquet(out).collect()) == starts[:-1]
    assert late_hours(spark, landing, out, meta, thr, T0).count() == 0


def test_late_rows_of_hours_never_emitted_are_reported(spark):
    from runlens.streaming.incremental import late_hours, run_watermarked

    work = scratch_path(spark, "t-late")
    landing = f"{work}/landing"
    meta, thr = fx.metric_metadata(spark), fx.thresholds(spark)
    reported = []
    for n, day in enumerate((5, 0, 10, 6)):      # day 0 comes late before any hour was emitted, day 6 after day 5 was
        rows = metric_rows(spark, [(f"r{day}", "0", "click", 30.0, T0 + dt.timedelta(days=day))]).drop("extraction_timestamp")
        land_extract(rows, landing, T0 + dt.timedelta(minutes=n))
        out = run_watermarked(spark, landing, work, meta, thr, T0)
        late = late_hours(spark, landing, out, meta, thr, T0).collect()
        reported.append(sorted(((r["time_hour"] - T0).days, r["missed_runs"]) for r in late))
    assert [(r["time_hour"] - T0).days for r in spark.read.parquet(out).collect()] == [5]
    assert reported == [[], [(0, 1)], [(0, 1)], [(0, 1), (6, 1)]]


def test_summaries_are_ordered(spark):
    from runlens.operators.enrich import enrich
    from runlens.operators.series import series_windows

    rows = [(f"r{i}", str(i % 3), "click", float(i), T0 + dt.timedelta(hours=i * 7 % 11)) for i in range(22)]
    e = series_windows(enrich(metric_rows(spark, rows), fx.metric_metadata(spark), fx.thresholds(spark), T0))
    stamps = [r["timestamp"] for r in sm.platform_summary(e, T0).collect()]
    assert stamps == sorted(stamps, reverse=True) and len(stamps) == 11
    apps = [(r["application"], -r["timestamp"].timestamp()) for r in sm.application_summary(e, T0).collect()]
    assert apps == sorted(apps)
    ts = sm.sort_timeseries(sm.metric_timeseries(e, T0 + dt.timedelta(days=1)))
    for part in ts.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
            F.collect_list(F.struct("application", "metric_name", "timestamp")).alias("l")).collect():
        assert part["l"] == sorted(part["l"])
