"""Alert rules (ALR1-3, WIN5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.operators.alerts import alert_report, critical_rate_alerts, latest_row
from tests.helpers import T0

SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()), T.StructField("total_runs", T.LongType()),
    T.StructField("critical_runs", T.LongType()), T.StructField("pass_rate", T.DoubleType()),
])


def _platform(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("critical,expected", [
    (1, []),
    (2, [("Elevated Critical Run Rate", "high")]),          # 20 % is not above 20; 80 % is not below 80
    (3, [("High Critical Run Rate", "critical"), ("Low Pass Rate", "high")]),
])
def test_latest_hour_rules(spark, critical, expected):
    pr = 100.0 * (10 - critical) / 10
    p = _platform(spark, [(T0, 10, 0, 100.0), (T0 + dt.timedelta(hours=1), 10, critical, pr)])
    rep = alert_report(p, T0).collect()
    got = sorted((r["title"], r["severity"]) for r in rep if r["title"] is not None)
    assert got == sorted(expected)
    assert {r["report_status"] for r in rep} == ({"alerts"} if expected else {"ok"})


def test_zero_runs_no_rate_alert(spark):
    p = _platform(spark, [(T0, 0, 0, None)])
    assert critical_rate_alerts(p).count() == 0
    rep = alert_report(p, T0).collect()
    assert [r["report_status"] for r in rep] == ["ok"]


def test_empty_summary_no_data(spark):
    rep = alert_report(_platform(spark, []), T0).collect()
    assert [r["report_status"] for r in rep] == ["no_data"]


def test_latest_by_value_not_position(spark):
    p = _platform(spark, [(T0 + dt.timedelta(hours=2), 5, 0, 100.0), (T0, 9, 9, 0.0)])
    assert latest_row(p).first()["total_runs"] == 5


def test_message_rounds_the_exact_value(spark):
    from runlens.functions.stats import one_decimal

    xs = [0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 0.75, 0.95, 9.95, 12.25, 12.35, 33.333333, 66.65, 79.95, 99.95, 100.0]
    xs += [100.0 * a / b for b in range(1, 60) for a in range(b + 1)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").withColumn("t", one_decimal(F.col("x")))
    assert {r["x"]: "%.1f" % r["t"] for r in df.collect()} == {x: "%.1f" % x for x in xs}
