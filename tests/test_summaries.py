"""Run rollup, hourly summaries, lag, recent runs, application summary (AGG1-13, WIN1, JN4)."""

import datetime as dt
import json

from runlens.operators import summaries as sm
from runlens.operators.enrich import enrich
from runlens.operators.series import series_windows
from runlens.sources import fixtures as fx
from tests.helpers import T0, hours, metric_rows


def _enriched(spark, rows):
    base = enrich(metric_rows(spark, rows), fx.metric_metadata(spark), fx.thresholds(spark), T0)
    return series_windows(base)


def test_lag_is_rows_not_hours(spark):
    """26 hourly rows with one hour missing: the lag reaches 24 rows back."""
    times = [t for i, t in enumerate(hours(27)) if i != 5]
    rows = [(f"r{i:02d}", "0", "click", 5.0 if i % 2 else 30.0, t) for i, t in enumerate(times)]
    p = sm.platform_summary(_enriched(spark, rows), T0).orderBy("timestamp").collect()
    assert len(p) == 26
    assert all(r["pass_rate_trend"] == 0.0 for r in p[:24])
    assert p[24]["pass_rate_24h_ago"] == p[0]["pass_rate"]
    # the 24-hours-earlier variant is NULL where that hour has no runs
    by_hour = {r["timestamp"]: r for r in p}
    for r in p:
        prev = by_hour.get(r["timestamp"] - dt.timedelta(hours=24))
        assert r["pass_rate_trend_24h"] == (None if prev is None else r["pass_rate"] - prev["pass_rate"])


def test_recent_runs_five_newest(spark):
    rows = [(f"r{i}", "0", "click", 30.0, T0 + dt.timedelta(minutes=i)) for i in range(7)]
    p = sm.platform_summary(_enriched(spark, rows), T0).collect()
    assert p[0]["recent_run_ids"] == ["r6", "r5", "r4", "r3", "r2"]
    assert p[0]["total_runs"] == 7


def test_run_status_worst_metric(spark):
    rows = [("r1", "0", "click", 30.0, T0), ("r1", "0", "view", 1.0, T0), ("r2", "0", "click", 10.0, T0)]
    rs = {r["run_id"]: r["run_status"] for r in sm.run_status(_enriched(spark, rows)).collect()}
    assert rs == {"r1": "critical", "r2": "warning"}


def test_application_without_recent_metrics(spark):
    as_of = T0 + dt.timedelta(days=10)
    rows = [("r1", "0", "click", 30.0, T0), ("r2", "1", "click", 30.0, as_of - dt.timedelta(hours=1))]
    a = {r["application"]: json.loads(r["metrics_summary"])
         for r in sm.application_summary(_enriched(spark, rows), as_of).collect()}
    assert a["app-0"] == {"unknown": None} or set(a["app-0"]) == {"unknown"}
    assert set(a["app-1"]) == {"click"}
    assert a["app-1"]["click"]["latest_value"] == 30.0


def test_metric_summary_trend_constant_is_null(spark):
    rows = [("r1", "0", "click", 2.0, T0), ("r2", "0", "click", 2.0, T0 + dt.timedelta(hours=1))]
    s = sm.app_metric_summary(_enriched(spark, rows), T0 + dt.timedelta(days=1)).collect()[0]
    assert s["trend_correlation"] is None and s["stddev_value"] == 0.0


def test_latest_skips_missing_values(spark):
    rows = [("r1", "0", "click", 3.0, T0), ("r2", "0", "click", None, T0 + dt.timedelta(hours=1))]
    s = sm.app_metric_summary(_enriched(spark, rows), T0 + dt.timedelta(days=1)).collect()[0]
    assert s["latest_value"] == 3.0 and s["latest_status"] == "healthy"


def test_timeseries_hover_context(spark):
    rows = [("r1", "0", "click", 30.0, T0, {"model": "b"}), ("r1", "0", "view", 20.0, T0, None)]
    ts = sm.metric_timeseries(_enriched(spark, rows), T0 + dt.timedelta(days=1)).collect()
    assert len(ts) == 2
    for r in ts:
        assert json.loads(r["run_summary_metrics"]) == {"click": 30.0, "view": 20.0}
    kp = {r["metric_name"]: r["key_params"] for r in ts}
    assert kp == {"click": '{"model":"b"}', "view": "{}"}


def test_value_types_of_params(spark):
    from pyspark.sql import functions as F

    from runlens.operators.profiles import param_profile

    want = {"7": "int", "-3": "int", "99999999999999999999": "int", "2.5": "float", ".5": "float", "1e-3": "float", "5.": "float", "TRUE": "bool",
            "1d": "str", "2f": "str", "Infinity": "str", "NaN": "str", " 5 ": "str", "1e400": "str", "": "str", "0x1": "str"}
    df = spark.createDataFrame([({f"k{i}": v},) for i, v in enumerate(want)], "params map<string,string>")
    got = {r["param_key"]: r["value_types"] for r in param_profile(df).collect()}
    assert got == {f"k{i}": t for i, t in enumerate(want.values())}
    assert param_profile(df.where(F.lit(False))).count() == 0


def test_distinct_counts_without_expand(spark):
    from runlens.operators.profiles import extraction_profile

    rows = [(f"r{i % 4}", str(i % 3), None if i % 5 == 0 else "click", float(i), T0) for i in range(20)]
    df = metric_rows(spark, rows)
    out = extraction_profile(df)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    r, a = out.first(), extraction_profile(df, approx=True).first()
    assert (r["total_records"], r["unique_runs"], r["unique_experiments"], r["unique_metrics"], r["unique_users"]) == (20, 4, 3, 1, 1)
    assert r == a
    empty = extraction_profile(df.limit(0)).first()
    assert (empty["total_records"], empty["unique_runs"], empty["time_range_start"]) == (0, 0, None)
