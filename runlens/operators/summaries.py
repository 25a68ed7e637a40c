"""Dashboard tables derived from the enriched rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.maps import key_params_json, lower_keys
from runlens.functions.stats import epoch_seconds, latest_non_null, safe_corr
from runlens.functions.status import run_status as worst_status
from runlens.schemas import CRITICAL, HEALTHY, WARNING
from runlens.sources.runs import within_lookback

RECENT_RUNS = 5


def _stamp(as_of: dt.datetime | None) -> Column:
    return F.lit(as_of) if as_of is not None else F.current_timestamp()


def _status_counts(col: str) -> list[Column]:
    return [
        F.count_if(F.col(col) == CRITICAL).alias("critical_" + ("metrics" if col == "status" else "runs")),
        F.count_if(F.col(col) == WARNING).alias("warning_" + ("metrics" if col == "status" else "runs")),
    ]


def run_status(enriched: DataFrame) -> DataFrame:
    """One row per run: worst metric status and per-status metric counts."""
    return (
        enriched.groupBy("run_id", "experiment_name", "user_id", "start_time")
        .agg(F.count(F.lit(1)).alias("total_metrics"), *_status_counts("status"))
        .withColumn("run_status", worst_status(F.col("critical_metrics"), F.col("warning_metrics")))
    )


def hourly_counts() -> list[Column]:
    """Runs, runs per status and pass rate (healthy + warning share, in percent)."""
    return _hourly_counts()


def run_status_of(critical_count: Column, warning_count: Column) -> Column:
    return worst_status(critical_count, warning_count)


def _hourly_counts() -> list[Column]:
    passed = F.count_if(F.col("run_status").isin(HEALTHY, WARNING))
    return [
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("run_status") == CRITICAL).alias("critical_runs"),
        F.count_if(F.col("run_status") == WARNING).alias("warning_runs"),
        F.count_if(F.col("run_status") == HEALTHY).alias("healthy_runs"),
        (F.lit(100.0) * passed / F.count(F.lit(1))).alias("pass_rate"),
    ]


def platform_hourly(runs: DataFrame) -> DataFrame:
    """Runs per hour of start_time with per-status counts and pass rate."""
    return (
        runs.groupBy(F.date_trunc("hour", "start_time").alias("time_hour"))
        .agg(*_hourly_counts(), F.array_sort(F.collect_set("experiment_name")).alias("active_applications"))
    )


def recent_runs_per_hour(runs: DataFrame, k: int = RECENT_RUNS) -> DataFrame:
    """The k newest runs of each hour (newest first), as (time_hour, position, run_id).

    ``row_number() <= k`` is planned as a map-side group limit, so a busy hour
    never ships more than k rows per task.
    """
    hour = F.date_trunc("hour", "start_time")
    w = Window.partitionBy("time_hour").orderBy(F.desc("start_time"), F.desc("run_id"))
    return (
        runs.select(hour.alias("time_hour"), "start_time", "run_id")
        .withColumn("position", F.row_number().over(w))
        .where(F.col("position") <= k)
        .select("time_hour", "position", "run_id")
    )


def pass_rate_lag(hourly: DataFrame, lag_rows: int = 24) -> DataFrame:
    """pass_rate_24h_ago = pass rate ``lag_rows`` rows earlier (rows, not hours);
    ``pass_rate_trend`` = difference, 0 when absent. ``pass_rate_trend_24h`` uses
    the hour exactly 24 hours earlier instead (NULL when that hour has no runs).

    The unpartitioned lag window sees one row per hour, never raw rows.
    """
    w = Window.orderBy("time_hour")
    # A range frame of exactly [-24 h, -24 h] finds the hour one day earlier, if present,
    # in the same single-partition pass as the lag (no self-join).
    day_back = Window.orderBy(F.unix_seconds("time_hour")).rangeBetween(-86400, -86400)
    return (
        hourly.withColumn("pass_rate_24h_ago", F.lag("pass_rate", lag_rows).over(w))
        .withColumn("_pr_prev_day", F.first("pass_rate").over(day_back))
        .withColumn("pass_rate_trend", F.coalesce(F.col("pass_rate") - F.col("pass_rate_24h_ago"), F.lit(0.0)))
        .withColumn("pass_rate_trend_24h", F.col("pass_rate") - F.col("_pr_prev_day"))
        .drop("_pr_prev_day")
    )


def platform_summary(enriched: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Hourly platform summary, newest hour first."""
    runs = run_status(enriched)
    hourly = pass_rate_lag(platform_hourly(runs))
    recent = (
        recent_runs_per_hour(runs)
        .groupBy("time_hour")
        .agg(F.array_sort(F.collect_list(F.struct("position", "run_id"))).alias("_r"))
        .select("time_hour", F.transform("_r", lambda x: x["run_id"]).alias("recent_run_ids"))
    )
    return (
        hourly.join(recent, "time_hour", "left")
        .select(
            F.col("time_hour").alias("timestamp"),
            "total_runs", "critical_runs", "warning_runs", "healthy_runs", "pass_rate",
            "pass_rate_trend", "pass_rate_24h_ago", "pass_rate_trend_24h",
            "recent_run_ids", "active_applications",
            _stamp(as_of).alias("aggregation_timestamp"),
        )
        .orderBy(F.desc("timestamp"))
    )


def app_run_status(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy(F.col("experiment_name").alias("application"), "run_id", "user_id", "start_time")
        .agg(*_status_counts("status"))
        .withColumn("run_status", worst_status(F.col("critical_metrics"), F.col("warning_metrics")))
        .drop("critical_metrics", "warning_metrics")
    )


def app_hourly(app_runs: DataFrame) -> DataFrame:
    return app_runs.groupBy("application", F.date_trunc("hour", "start_time").alias("time_hour")).agg(
        *_hourly_counts()
    )


def app_metric_summary(enriched: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Per (application, metric) over the last ``days`` days (inclusive bound).

    ``latest_moving_avg`` is included when the input carries ``moving_avg_24h``.
    """
    recent = within_lookback(enriched, as_of, f"{days} DAYS", inclusive=True)
    order = (F.col("start_time"), F.col("run_id"))
    moving = ([latest_non_null(F.col("moving_avg_24h"), *order).alias("latest_moving_avg")]
              if "moving_avg_24h" in enriched.columns else [])
    return recent.groupBy(
        F.col("experiment_name").alias("application"), "metric_name", "display_name", "category", "unit"
    ).agg(
        F.count(F.lit(1)).alias("total_measurements"),
        F.avg("metric_value").alias("avg_value"),
        F.stddev_samp("metric_value").alias("stddev_value"),
        F.min("metric_value").alias("min_value"),
        F.max("metric_value").alias("max_value"),
        latest_non_null(F.col("metric_value"), *order).alias("latest_value"),
        latest_non_null(F.col("status"), *order).alias("latest_status"),
        *moving,
        safe_corr(F.col("metric_value"), epoch_seconds(F.col("start_time"))).alias("trend_correlation"),
    )


_SUMMARY_FIELDS = ["latest_value", "latest_status", "avg_value", "trend", "display_name", "unit"]
METRIC_SUMMARY = T.StructType([
    T.StructField("latest_value", T.DoubleType()),
    T.StructField("latest_status", T.StringType()),
    T.StructField("avg_value", T.DoubleType()),
    T.StructField("trend", T.DoubleType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("unit", T.StringType()),
])


def metrics_summary_by_app(metric_summary: DataFrame) -> DataFrame:
    """One row per application: metric -> summary struct.

    A metric that carries several names or units in the period has several summary rows; the one
    with most measurements stands for it, so keys are unique.
    """
    fields = F.struct("latest_value", "latest_status", "avg_value", F.col("trend_correlation").alias("trend"), "display_name", "unit")
    place = F.struct("total_measurements", "display_name", "category", "unit")
    one = (metric_summary.where(F.col("metric_name").isNotNull())
           .groupBy("application", "metric_name").agg(F.max_by(fields, place).alias("value")))
    entry = F.struct(F.col("metric_name").alias("key"), "value")
    return one.groupBy("application").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("metrics"))


def application_summary(enriched: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Hourly application summary with the 7-day metric summary of the application.

    The metric side is reduced to one map per application before the join, so the join
    never fans out hours x metrics; AQE picks the join from the map table's size. An application without recent metrics
    gets ``{"unknown": {all fields null}}``.
    """
    hourly = app_hourly(app_run_status(enriched))
    per_app = metrics_summary_by_app(app_metric_summary(enriched, as_of, days))
    unknown = F.create_map(F.lit("unknown"), F.lit(None).cast(METRIC_SUMMARY))
    metrics = F.coalesce(F.col("metrics"), unknown)
    return (
        hourly.join(per_app, "application", "left")
        .select(
            F.col("time_hour").alias("timestamp"), "application",
            "total_runs", "critical_runs", "warning_runs", "healthy_runs", "pass_rate",
            metrics.alias("metrics"),
            F.to_json(F.transform_values(metrics, lambda _, v: F.struct(*[v[f].alias(f) for f in _SUMMARY_FIELDS])),
                      {"ignoreNullFields": "false"}).alias("metrics_summary"),
            _stamp(as_of).alias("aggregation_timestamp"),
        )
        .orderBy("application", F.desc("timestamp"))
    )


def run_summary_metrics(enriched: DataFrame) -> DataFrame:
    """metric -> value per run (latest extraction per (run, metric) first, then the largest value)."""
    w = Window.partitionBy("run_id", "metric_name").orderBy(F.desc("extraction_timestamp"), F.desc("metric_value"))
    latest = (
        enriched.where(F.col("metric_name").isNotNull())
        .select("run_id", "metric_name", "metric_value", "extraction_timestamp")
        .withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    )
    return latest.groupBy("run_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric_name", "metric_value")))).alias(
            "run_metrics"
        )
    )


TIMESERIES_GROUP = [
    "start_time", "run_id", "run_name", "user_id", "experiment_name", "metric_name", "display_name",
    "metric_value", "status", "moving_avg_24h", "forecast_next", "critical_threshold", "warning_threshold",
    "unit", "description", "params", "extraction_timestamp", "enrichment_timestamp",
]


def metric_timeseries(enriched: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """Plot points of the last ``days`` days with hover context.

    ``run_summary_metrics`` holds all metrics of the run: one map per run, joined to its
    rows. start_time is a run attribute, so the day filter keeps or drops whole runs and
    can run first (it reaches the scan). Full-row duplicates are removed before.
    """
    recent = within_lookback(enriched, as_of, f"{days} DAYS", inclusive=True)
    rows = recent.withColumn("params", F.to_json(lower_keys(F.col("params")))).select(*TIMESERIES_GROUP).distinct()
    rows = rows.withColumn("params", F.from_json("params", "map<string,string>"))
    grouped = rows.join(run_summary_metrics(recent), "run_id", "left")
    run_json = F.to_json(F.coalesce(F.col("run_metrics"), F.lit(None).cast("map<string,double>")))
    return grouped.select(
        F.col("start_time").alias("timestamp"),
        "run_id", "run_name", "user_id",
        F.col("experiment_name").alias("application"),
        "metric_name", "display_name",
        F.col("metric_value").alias("value"),
        "status",
        F.col("moving_avg_24h").alias("moving_avg"),
        F.col("forecast_next").alias("forecast"),
        "critical_threshold", "warning_threshold", "unit", "description",
        key_params_json(F.col("params")).alias("key_params"),
        run_json.alias("run_summary_metrics"),
        "extraction_timestamp", "enrichment_timestamp",
    )


def sort_timeseries(ts: DataFrame) -> DataFrame:
    """Sink layout: ranges of (application, metric) per file, time-sorted inside."""
    return ts.repartitionByRange("application", "metric_name").sortWithinPartitions(
        "application", "metric_name", "timestamp"
    )
