"""Monitoring inputs derived from the driver's ``events`` table.

A run is one user's day; its metrics are the largest value per event type.
Experiments, metric metadata and thresholds are small fixed dimensions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens import schemas as S
from runlens.session import local_table, sf_path

AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
N_EXPERIMENTS = 5

# Metric metadata dimension (metric_name, display_name, description,
# unit, category, higher_is_better). 'signup' is deliberately absent.
METADATA_ROWS = [
    ("click", "Clicks", "max click value", "n", "engagement", True),
    ("view", "Views", "max view value", "s", "engagement", True),
    ("purchase", "Purchases", "max purchase value", "usd", "revenue", True),
    ("error", "Errors", "max error value", None, "reliability", False),
]

# Thresholds (metric_name, critical, warning, experiment_id or None for
# the platform default). 'error' has experiment overrides only.
THRESHOLD_ROWS = [
    ("click", 8.0, 20.0, None),
    ("click", 30.0, 60.0, "1"),
    ("view", 3.0, 15.0, None),
    ("purchase", 2.0, 10.0, None),
    ("error", 150.0, 90.0, "1"),
    ("error", 120.0, 60.0, "2"),
]
THRESHOLDS_UPDATED_AT = dt.datetime(2024, 1, 1, 0, 0, 0)


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the columns the monitoring model uses; ``ts`` as a session timestamp."""
    ev = spark.read.parquet(sf_path(sf_dir, "events"))
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
    )


def _run_id(user_id: Column, d: Column) -> Column:
    return F.concat(F.lit("r-"), user_id.cast("string"), F.lit("-"), d.cast("string"))


def _tags(user_id: Column, run_id: Column) -> Column:
    user = F.when(user_id % 7 != 0, F.concat(F.lit("u"), user_id.cast("string")))
    name = F.when(user_id % 3 == 0, F.concat(F.lit("run-"), run_id))
    entries = F.array(
        F.struct(F.lit("source").alias("key"), F.lit("events").alias("value")),
        F.struct(F.lit(S.TAG_USER).alias("key"), user.alias("value")),
        F.struct(F.lit(S.TAG_RUN_NAME).alias("key"), name.alias("value")),
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def _params(user_id: Column) -> Column:
    model = F.concat(F.lit("m"), (user_id % 4).cast("string"))
    return (
        F.when(user_id % 11 == 0, F.lit(None).cast(S.STR_MAP))
        .when(user_id % 13 == 0, F.create_map(F.lit("Model"), F.lit("gbm"), F.lit("model"), model))
        .when(user_id % 4 == 1, F.create_map(F.lit("lr"), F.lit("0.01")))
        .otherwise(
            F.create_map(
                F.lit("model"), model,
                F.lit("lr"), F.lit("0.1"),
                F.lit("epochs"), (user_id % 50).cast("string"),
            )
        )
    )


def runs_from_events(events: DataFrame) -> DataFrame:
    """One row per run with a ``metrics`` map (schema ``RUNS``)."""
    return runs_of(user_days(events))


def user_days(events: DataFrame) -> DataFrame:
    """(user_id, d, start_time, end_time, metrics): what of a run does not follow from its user and day.

    Two aggregations: (user, day, event_type) first, which partially aggregates
    map-side so even a user-day holding a large share of all events shuffles one
    row per map task; then (user, day), whose groups hold one row per metric.
    """
    cells = events.groupBy("user_id", F.to_date("ts").alias("d"), "event_type").agg(
        F.max("value").alias("v"),
        F.min("ts").alias("t0"),
        F.max("ts").alias("t1"),
        F.count(F.lit(1)).alias("n"),
    )
    return cells.groupBy("user_id", "d").agg(
        F.min("t0").alias("start_time"),
        F.when(F.sum("n") > 1, F.max("t1")).alias("end_time"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "v")))).alias("metrics"),
    )


def runs_of(days: DataFrame) -> DataFrame:
    """The runs (schema ``RUNS``) of ``user_days``; their texts and maps are made here, so no shuffle need carry them."""
    run_id = _run_id(F.col("user_id"), F.col("d"))
    return days.select(
        run_id.alias("run_id"),
        (F.col("user_id") % N_EXPERIMENTS).cast("string").alias("experiment_id"),
        "start_time",
        "end_time",
        F.lit("FINISHED").alias("status"),
        "metrics",
        _params(F.col("user_id")).alias("params"),
        _tags(F.col("user_id"), run_id).alias("tags"),
    )


def runs_raw_from_runs(runs: DataFrame) -> DataFrame:
    """The tracking-server shape: epoch milliseconds, end 0 when unset."""
    return runs.select(
        "run_id",
        "experiment_id",
        F.unix_millis("start_time").alias("start_time"),
        F.coalesce(F.unix_millis("end_time"), F.lit(0).cast("bigint")).alias("end_time"),
        "status",
        "metrics",
        "params",
        "tags",
    )


def experiments(spark: SparkSession) -> DataFrame:
    rows = [(str(i), f"app-{i}") for i in range(N_EXPERIMENTS)]
    return local_table(spark, rows, S.EXPERIMENTS)


def metric_metadata(spark: SparkSession) -> DataFrame:
    return local_table(spark, METADATA_ROWS, S.METRIC_METADATA)


def thresholds(spark: SparkSession) -> DataFrame:
    rows = [(m, c, w, e, THRESHOLDS_UPDATED_AT, "fixture") for (m, c, w, e) in THRESHOLD_ROWS]
    return local_table(spark, rows, S.THRESHOLDS)


def metadata_payloads(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Metadata API responses for the metric names present in ``events``.

    One response per requested name, ``{"metrics":[item]}``; a name without
    metadata gets an item lacking the required ``unit`` key (dropped by the parser).
    """
    names = events.select(F.col("event_type").alias("metric_name")).distinct()
    meta = metric_metadata(spark)
    joined = names.join(F.broadcast(meta), "metric_name", "left")   # literal table: size fixed above
    item = F.when(
        F.col("display_name").isNotNull(),
        F.to_json(
            F.struct("metric_name", "display_name", "description", "unit", "category", "higher_is_better"),
            {"ignoreNullFields": "false"},
        ),
    ).otherwise(F.to_json(F.struct("metric_name", F.lit("n/a").alias("display_name"))))
    return joined.select(
        F.col("metric_name").alias("requested"),
        F.concat(F.lit('{"metrics":['), item, F.lit("]}")).alias("payload"),
    )


def threshold_payloads(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Threshold API responses for metric names present in ``events``.

    ``updated_at`` is ISO-8601 text with a ``Z`` suffix; metrics without any
    threshold get an item with an unparsable timestamp (dropped by the parser).
    """
    names = events.select(F.col("event_type").alias("metric_name")).distinct()
    thr = thresholds(spark).withColumn(
        "updated_at", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    joined = names.join(F.broadcast(thr), "metric_name", "left")    # literal table: size fixed above
    item = F.when(
        F.col("critical_threshold").isNotNull(),
        F.to_json(
            F.struct("metric_name", "critical_threshold", "warning_threshold", "experiment_id",
                     "updated_at", "updated_by"),
            {"ignoreNullFields": "false"},
        ),
    ).otherwise(
        F.to_json(F.struct("metric_name", F.lit(1.0).alias("critical_threshold"),
                           F.lit(2.0).alias("warning_threshold"),
                           F.lit("not-a-time").alias("updated_at"), F.lit("x").alias("updated_by")))
    )
    return joined.select(
        F.col("metric_name").alias("requested"),
        F.concat(F.lit('{"thresholds":['), item, F.lit("]}")).alias("payload"),
    )
