"""Alert rules over the hourly platform summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.stats import one_decimal
from runlens.schemas import SEV_CRITICAL, SEV_HIGH

# Alert limits of the source model.
CRITICAL_RATE_CRITICAL = 20.0   # critical-run share above 20 % -> critical
CRITICAL_RATE_HIGH = 10.0       # above 10 % -> high
PASS_RATE_FLOOR = 80.0          # pass rate below 80 % -> high

# Titles and messages of the alerts.
TITLE_CRITICAL, TITLE_HIGH, TITLE_PASS = "High Critical Run Rate", "Elevated Critical Run Rate", "Low Pass Rate"
CRITICAL_MESSAGE = "%.1f%% of runs are critical (%d/%d)"
PASS_MESSAGE = "Pass rate dropped to %.1f%%"


def _critical_rate() -> Column:
    return F.try_divide(F.col("critical_runs") * F.lit(100.0), F.col("total_runs"))


def _critical_rate_alert() -> Column:
    rate = _critical_rate()
    msg = F.format_string(CRITICAL_MESSAGE, one_decimal(rate), F.col("critical_runs"),
                          F.col("total_runs"))
    return (
        F.when((F.col("total_runs") > 0) & (rate > CRITICAL_RATE_CRITICAL),
               F.struct(F.lit(TITLE_CRITICAL).alias("title"), msg.alias("message"),
                        F.lit(SEV_CRITICAL).alias("severity")))
        .when((F.col("total_runs") > 0) & (rate > CRITICAL_RATE_HIGH),
              F.struct(F.lit(TITLE_HIGH).alias("title"), msg.alias("message"),
                       F.lit(SEV_HIGH).alias("severity")))
    )


def _pass_rate_alert() -> Column:
    pr = F.coalesce(F.col("pass_rate"), F.lit(100.0))
    return F.when(
        pr < PASS_RATE_FLOOR,
        F.struct(F.lit(TITLE_PASS).alias("title"),
                 F.format_string(PASS_MESSAGE, one_decimal(pr)).alias("message"),
                 F.lit(SEV_HIGH).alias("severity")),
    )


def critical_rate_alerts(platform: DataFrame) -> DataFrame:
    """Critical-run-rate rule on every hour (superset of the latest-hour check)."""
    return platform.select("timestamp", _critical_rate().alias("critical_rate"),
                           _critical_rate_alert().alias("a")).where(F.col("a").isNotNull()).select(
        "timestamp", "critical_rate", "a.title", "a.severity", "a.message")


def pass_rate_alerts(platform: DataFrame) -> DataFrame:
    return platform.select("timestamp", "pass_rate", _pass_rate_alert().alias("a")).where(
        F.col("a").isNotNull()).select("timestamp", "pass_rate", "a.title", "a.severity", "a.message")


def latest_row(platform: DataFrame) -> DataFrame:
    """The row with the greatest timestamp (by value, not by position)."""
    cols = platform.columns
    return platform.agg(F.max_by(F.struct(*cols), F.col("timestamp")).alias("_l")).select("_l.*").where(
        F.col("timestamp").isNotNull())


def alert_report(platform: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Latest-hour alert report in one aggregate pass: one row per alert, one ``ok``
    row without alerts, one ``no_data`` row for an empty summary."""
    stamp = F.lit(as_of) if as_of is not None else F.current_timestamp()
    cols = ["timestamp", "critical_runs", "total_runs", "pass_rate"]
    agg = platform.agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(F.struct(*cols), F.col("timestamp")).alias("_l"),
    ).select("_n", "_l.*")
    alerts = F.array_compact(F.array(_critical_rate_alert(), _pass_rate_alert()))
    status = (
        F.when(F.col("_n") == 0, F.lit("no_data"))
        .when(F.size("_alerts") > 0, F.lit("alerts"))
        .otherwise(F.lit("ok"))
    )
    return (
        agg.withColumn("_alerts", F.when(F.col("_n") > 0, alerts).otherwise(F.array()))
        .select(*cols, status.alias("report_status"), F.explode_outer("_alerts").alias("a"))
        .select(*cols, "report_status", "a.title", "a.severity", "a.message")
        .withColumn("check_timestamp", stamp)
    )
