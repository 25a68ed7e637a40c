"""Batch profiles: extraction, enrichment, outputs, params, status distribution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.functions.maps import lower_keys
from runlens.schemas import CRITICAL


def with_distinct(base: DataFrame, df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The one row of ``base`` with exact distinct counts (name -> column of ``df``; nulls do not count).

    Each column is counted on its own: its scan reads that column alone, and tasks ship their distinct values. Several distinct
    counts in one aggregate would copy every row once per column (Expand) first.
    """
    parts = [base, *[df.select(c).distinct().agg(F.count(c).alias(name)) for name, c in columns.items()]]
    row = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return row.agg(*[F.max(c).alias(c) for c in row.columns])     # one row per part


def extraction_profile(metric_rows: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, distinct runs / experiments / metrics / users, start-time range, null values.

    ``approx=True`` counts distinct values by HyperLogLog sketches in the same pass as the rest.
    """
    columns = {"unique_runs": "run_id", "unique_experiments": "experiment_id", "unique_metrics": "metric_name", "unique_users": "user_id"}
    base = metric_rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("start_time").alias("time_range_start"),
        F.max("start_time").alias("time_range_end"),
        F.count_if(F.col("metric_value").isNull() | F.isnan("metric_value")).alias("null_metric_values"),
        *[F.approx_count_distinct(c).alias(name) for name, c in columns.items() if approx],
    )
    found = base if approx else with_distinct(base, metric_rows, columns)
    return found.select("total_records", *columns, "time_range_start", "time_range_end", "null_metric_values")


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """Value counts, the k most frequent (ties by value); a partial aggregate + TakeOrdered."""
    return (
        df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(col))
        .limit(k)
    )


def top_experiments(metric_rows: DataFrame, k: int = 5) -> DataFrame:
    return top_values(metric_rows, "experiment_name", k)


def top_metrics(metric_rows: DataFrame, k: int = 10) -> DataFrame:
    return top_values(metric_rows, "metric_name", k)


def preview(df: DataFrame, k: int = 5) -> DataFrame:
    return df.limit(k)


def enrichment_profile(enriched: DataFrame, metric_rows: DataFrame) -> DataFrame:
    """Enriched rows, distinct metrics / experiments, batch metrics having metadata,
    mean moving average."""
    batch_metrics = metric_rows.select("metric_name").distinct()
    with_meta = enriched.select("metric_name").distinct()
    covered = batch_metrics.join(with_meta, "metric_name", "left_semi").agg(
        F.count(F.lit(1)).alias("metrics_with_metadata")
    )
    stats = with_distinct(
        enriched.agg(F.count(F.lit(1)).alias("total_enriched_records"), F.avg("moving_avg_24h").alias("avg_moving_avg")),
        enriched, {"unique_metrics": "metric_name", "unique_experiments": "experiment_id"},
    ).select("total_enriched_records", "unique_metrics", "unique_experiments", "avg_moving_avg")
    return stats.select("*", covered.scalar().alias("metrics_with_metadata"))


def sample_critical_metrics(enriched: DataFrame, k: int = 5) -> DataFrame:
    """Up to k distinct metric names with a critical measurement (alphabetical)."""
    return (
        enriched.where(F.col("status") == CRITICAL).select("metric_name").distinct()
        .orderBy("metric_name").limit(k)
    )


def status_distribution(enriched: DataFrame) -> DataFrame:
    """Rows per status and their share in percent (the window sees <= 3 rows)."""
    counts = enriched.groupBy("status").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("percentage", F.lit(100.0) * F.col("count") / total)


# A number as written: digits with an optional point and exponent; no suffix letters, blanks, NaN or Infinity.
INT_VALUE = r"^[+-]?[0-9]+$"
FLOAT_VALUE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _value_type(v: Column) -> Column:
    """int, float (a finite number as written), bool or str."""
    finite = F.abs(v.try_cast("double")) < F.lit(float("inf"))
    return (
        F.when(v.rlike(INT_VALUE), F.lit("int"))
        .when(v.rlike(FLOAT_VALUE) & finite, F.lit("float"))
        .when(F.lower(v).isin("true", "false"), F.lit("bool"))
        .otherwise(F.lit("str"))
    )


def param_profile(df: DataFrame, samples: int = 3) -> DataFrame:
    """Per params key (lower-cased): rows carrying it, value types seen, and the
    ``samples`` smallest distinct values. Values are bounded per key by a map-side
    group limit, never collected whole.
    """
    kv = df.select(F.explode(lower_keys(F.col("params"))).alias("param_key", "value"))
    per_key = kv.groupBy("param_key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array_join(F.array_sort(F.collect_set(_value_type(F.col("value")))), ",").alias("value_types"),
    )
    w = Window.partitionBy("param_key").orderBy("value")
    samples_df = (
        kv.where(F.col("value").isNotNull()).select("param_key", "value").distinct()
        .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= samples)
        .groupBy("param_key")
        .agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("sample_values"))
    )
    return per_key.join(samples_df, "param_key", "left")   # one row per key


def params_null_share(df: DataFrame) -> DataFrame:
    """Share of rows whose params is NULL, in percent (typed maps are never non-maps)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("params").isNull()).alias("null_params"),
    ).withColumn("null_params_pct", F.try_divide(F.lit(100.0) * F.col("null_params"), F.col("rows")))


def output_profile(platform: DataFrame, application: DataFrame, timeseries: DataFrame) -> DataFrame:
    """Profiles of the three dashboard tables in long form (table, stat, value).

    "Latest" is the row with the greatest timestamp, not a position.
    """
    p = platform.agg(
        F.count(F.lit(1)).cast("double").alias("records_generated"),
        F.max_by("pass_rate", "timestamp").alias("latest_pass_rate"),
        F.max_by("critical_runs", "timestamp").cast("double").alias("latest_critical_runs"),
    )
    a = with_distinct(
        application.agg(F.count(F.lit(1)).cast("double").alias("records_generated"), F.avg("pass_rate").alias("avg_pass_rate")),
        application, {"applications_covered": "application"})
    t = with_distinct(
        timeseries.agg(F.count(F.lit(1)).cast("double").alias("timeseries_points"),
                       F.min("timestamp").alias("date_range_start"), F.max("timestamp").alias("date_range_end")),
        timeseries, {"applications": "application", "metrics": "metric_name"})

    def longform(df: DataFrame, table: str, nums: list[str], times: list[str] = ()) -> DataFrame:
        entries = [F.struct(F.lit(c).alias("stat"), F.col(c).cast("double").alias("num_value"),
                            F.lit(None).cast("string").alias("text_value")) for c in nums]
        entries += [F.struct(F.lit(c).alias("stat"), F.lit(None).cast("double").alias("num_value"),
                             F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias("text_value")) for c in times]
        return df.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries)))

    return (
        longform(p, "platform_summary", ["records_generated", "latest_pass_rate", "latest_critical_runs"])
        .unionByName(longform(a, "application_summary", ["records_generated", "applications_covered", "avg_pass_rate"]))
        .unionByName(longform(t, "metric_timeseries", ["timeseries_points", "applications", "metrics"],
                              ["date_range_start", "date_range_end"]))
    )
