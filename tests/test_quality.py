"""Data-quality checks at their limits (DQ1-7)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from runlens.operators.quality import (DEFAULT_CHECKS, Measured, QualityCheck, alerts_from_checks, check_duplicates, check_freshness, check_nulls, check_ranges,
                                       quality_report, run_checks, store_checks)
from tests.helpers import T0, metric_rows


def _rows(spark, n, value=lambda i: 1.0, run=lambda i: f"r{i}"):
    return metric_rows(spark, [(run(i), "0", "click", value(i), T0) for i in range(n)])


def test_nulls_exactly_ten_percent_pass(spark):
    df = _rows(spark, 10, value=lambda i: None if i == 0 else 1.0).select("run_id", "metric_value")
    assert check_nulls(df).first()["status"] == "passed"
    df = _rows(spark, 10, value=lambda i: None if i < 2 else 1.0).select("run_id", "metric_value")
    r = check_nulls(df).first()
    assert r["status"] == "failed" and json.loads(r["details"])["excessive_null_columns"] == ["metric_value"]


def test_duplicates_exactly_one_percent_fail(spark):
    df = _rows(spark, 100, run=lambda i: "r0" if i in (0, 1) else f"r{i}")
    r = check_duplicates(df).first()
    assert r["status"] == "failed" and json.loads(r["details"])["duplicate_count"] == 1


def test_duplicate_null_keys_equal(spark):
    df = _rows(spark, 3).withColumn("run_id", F.lit(None).cast("string"))
    assert json.loads(check_duplicates(df).first()["details"])["duplicate_count"] == 2


def test_freshness_exactly_24h_fails(spark):
    df = _rows(spark, 1)
    assert check_freshness(df, T0 + dt.timedelta(hours=24)).first()["status"] == "failed"
    assert check_freshness(df, T0 + dt.timedelta(hours=23)).first()["status"] == "passed"


def test_ranges_outliers_and_empty(spark):
    df = _rows(spark, 100, value=lambda i: 1000.0 if i == 0 else float(i % 5))
    r = check_ranges(df).first()
    assert r["status"] == "passed" and json.loads(r["details"])["outlier_count"] == 1
    assert check_ranges(df.limit(0)).first()["status"] == "error"


def test_report_counts_every_severity(spark):
    df = _rows(spark, 5)
    alerts, counts = quality_report(spark, {"a": df}, T0 + dt.timedelta(days=3))
    got = {r["severity"]: r["alerts"] for r in counts.collect()}
    assert set(got) == {"low", "medium", "high", "critical"}
    assert got["high"] == 1      # stale data
    assert got["medium"] == 1    # end_time is NULL on every hand-written row
    titles = {r["title"] for r in alerts.collect()}
    assert titles == {"Data Quality Issue: data_freshness", "Data Quality Issue: null_values"}


def test_missing_schema_columns(spark):
    df = _rows(spark, 2).drop("experiment_name")
    res = {r["check_name"]: r["status"] for r in run_checks(df, "x", T0).collect()}
    assert res["schema_validation"] == "failed"


def test_stored_and_lazy_results_agree(spark):
    df = _rows(spark, 30, value=lambda i: float(i % 7), run=lambda i: f"r{i // 2}")
    lazy, stored = run_checks(df, "x", T0), store_checks(df, "x", T0)
    assert sorted(lazy.collect()) == sorted(stored.collect())
    assert {r["record_count"] for r in lazy.collect()} == {30}
    alone = {r["check_name"]: (r["status"], r["details"]) for c in (check_duplicates, check_nulls, check_ranges) for r in c(df).collect()}
    together = {r["check_name"]: (r["status"], r["details"]) for r in lazy.collect()}
    assert alone == {k: together[k] for k in alone}


def test_empty_dataset_gives_one_alert(spark):
    alerts, counts = quality_report(spark, {"a": _rows(spark, 3).limit(0)}, T0)
    assert [(r["title"], r["severity"], r["record_count"]) for r in alerts.collect()] == \
        [("Data Quality Issue: empty_dataset", "high", 0)]
    assert {r["severity"]: r["alerts"] for r in counts.collect()} == {"low": 0, "medium": 0, "high": 1, "critical": 0}


def test_failing_checks_become_high_alerts(spark):
    def at_run_time(df, _):
        boom = F.max(F.raise_error(F.lit("x" * 900)).cast("string"))
        return Measured(F.col("_boom"), F.lit("{}"), {"_boom": boom})

    def at_planning(df, _):
        raise ValueError("no plan")

    checks = [*DEFAULT_CHECKS, QualityCheck("late", "d", "low", at_run_time), QualityCheck("early", "d", "low", at_planning)]
    got = store_checks(_rows(spark, 3), "x", T0, checks)
    errors = {r["check_name"]: r["details"] for r in got.where("status = 'error'").collect()}
    assert set(errors) == {"late", "early"} and "x" * 900 in errors["late"] and "no plan" in errors["early"]
    assert got.count() == len(checks)
    assert {r["severity"] for r in alerts_from_checks(got, T0).where("check_name in ('late', 'early')").collect()} == {"high"}
