"""Data-quality checks as aggregates, and alerts from failed checks.

A check names its aggregates over the rows and states its status (``passed`` / ``failed`` / ``error`` / ``skipped``)
and ``details`` (a JSON text) as expressions over them. All checks of a dataset that read plain rows
share one aggregate, so one pass serves them; a check over groups of rows brings its own source. Checks are data:
``(name, description, severity, measure, enabled)``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.schemas import SEV_HIGH, SEV_LOW, SEV_MEDIUM, SEVERITIES
from runlens.session import local_table, scratch_path

# Check limits of the source model.
NULL_PCT_LIMIT = 10.0        # fail when any column has more than 10 % nulls
DUPLICATE_PCT_LIMIT = 1.0    # pass only below 1 % duplicate (run_id, metric_name)
FRESHNESS_HOURS = 24.0       # pass only when the newest start_time is younger than 24 h
OUTLIER_SIGMAS = 3.0         # outlier: beyond mean +- 3 sample standard deviations
OUTLIER_PCT_LIMIT = 5.0      # pass only below 5 % outliers
REQUIRED_COLUMNS = ["run_id", "experiment_name", "metric_name", "metric_value", "start_time"]


@dataclass
class Measured:
    """Aggregates of a check (by name, unique among the checks of a dataset) and its verdict over them.

    ``source`` replaces the dataset's rows where the check needs groups of them; ``rows`` counts the dataset's
    rows over it. Verdicts may use that count as ``_n``.
    """
    status: Column
    details: Column
    aggs: dict[str, Column] = field(default_factory=dict)
    source: DataFrame | None = None
    rows: Column = field(default_factory=lambda: F.count(F.lit(1)))


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _grade(passed: Column) -> Column:
    return F.when(passed, F.lit("passed")).otherwise(F.lit("failed"))


def _nothing_to_check(message: str) -> Measured:
    return Measured(F.lit("passed"), _json(F.lit(message).alias("message")))


def _aggregate(df: DataFrame, measured: list[Measured]) -> DataFrame:
    """One row: ``_n`` and the aggregates of checks that share a source."""
    first = measured[0]
    source = df if first.source is None else first.source
    return source.agg(first.rows.cast("bigint").alias("_n"), *[c.alias(n) for m in measured for n, c in m.aggs.items()])


def _alone(df: DataFrame, name: str, m: Measured) -> DataFrame:
    """(check_name, status, details) of one check."""
    return _aggregate(df, [m]).select(F.lit(name).alias("check_name"), m.status.alias("status"), m.details.alias("details"))


def _is_missing(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    col = F.col(f"`{c}`")
    return (col.isNull() | F.isnan(col)) if t in ("double", "float") else col.isNull()


def null_percentages(df: DataFrame) -> DataFrame:
    """(column_name, null_count, total, null_pct): NaN counts as missing. One pass."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.count_if(_is_missing(df, c)).alias(f"_n{i}") for i, c in enumerate(df.columns)
    ]
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
               for i, c in enumerate(df.columns)]
    return df.agg(*aggs).select(F.col("_total").alias("total"), F.inline(F.array(*entries))).select(
        "column_name", "null_count", "total",
        F.try_divide(F.lit(100.0) * F.col("null_count"), F.col("total")).alias("null_pct"),
    )


def measure_nulls(df: DataFrame) -> Measured:
    names = {c: f"_nulls{i}" for i, c in enumerate(sorted(df.columns))}
    shares = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                F.try_divide(F.lit(100.0) * F.col(a), F.col("_n")).alias("null_pct"))
                       for c, a in names.items()])
    over = F.filter(shares, lambda c: c["null_pct"] > NULL_PCT_LIMIT)
    details = _json(F.map_from_entries(shares).alias("null_percentages"),
                    F.transform(over, lambda c: c["column_name"]).alias("excessive_null_columns"))
    return Measured(_grade(F.size(over) == 0), details, {a: F.count_if(_is_missing(df, c)) for c, a in names.items()})


def check_nulls(df: DataFrame) -> DataFrame:
    return _alone(df, "null_values", measure_nulls(df))


def measure_duplicates(df: DataFrame) -> Measured:
    """Rows beyond the first per (run_id, metric_name); NULL keys equal each other."""
    if not {"run_id", "metric_name"} <= set(df.columns):
        return _nothing_to_check("No unique identifier columns found")
    dup = F.col("_n") - F.col("_keys")
    rate = F.try_divide(F.lit(100.0) * dup, F.col("_n"))
    return Measured(_grade(F.coalesce(rate < DUPLICATE_PCT_LIMIT, F.lit(False))),
                    _json(dup.alias("duplicate_count"), rate.alias("duplicate_rate")),
                    {"_keys": F.count(F.lit(1))},
                    source=df.groupBy("run_id", "metric_name").agg(F.count(F.lit(1)).alias("_rows")),
                    rows=F.coalesce(F.sum("_rows"), F.lit(0)))


def check_duplicates(df: DataFrame) -> DataFrame:
    return _alone(df, "duplicate_records", measure_duplicates(df))


def measure_freshness(df: DataFrame, as_of: dt.datetime) -> Measured:
    if "start_time" not in df.columns:
        return _nothing_to_check("No timestamp column found")
    age = (F.unix_micros(F.lit(as_of)) - F.unix_micros("_latest")) / F.lit(3.6e9)
    return Measured(_grade(F.coalesce(age < FRESHNESS_HOURS, F.lit(False))),
                    _json(F.date_format("_latest", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("latest_timestamp"),
                          age.alias("age_hours")),
                    {"_latest": F.max("start_time")})


def check_freshness(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    return _alone(df, "data_freshness", measure_freshness(df, as_of))


def measure_ranges(df: DataFrame) -> Measured:
    """Share of values outside mean +- 3 sample std, in two passes: one aggregate for the
    statistics (a single row, read as two numbers), then the outlier count against
    literal bounds. No cross join, and no repeated scalar subquery (which would be
    planned once per reference). No values at all is an error, as the source's
    division by zero would be."""
    if "metric_value" not in df.columns:
        return _nothing_to_check("No metric_value column found")
    v = F.nanvl(F.col("metric_value"), F.lit(None).cast("double"))
    st = df.agg(F.avg(v).alias("m"), F.stddev_samp(v).alias("s")).first()
    if st["s"] is None:
        outside = F.lit(False)          # at most one value: no spread, no outlier
    else:
        lo, hi = st["m"] - OUTLIER_SIGMAS * st["s"], st["m"] + OUTLIER_SIGMAS * st["s"]
        outside = (v < F.lit(lo)) | (v > F.lit(hi))
    rate = F.try_divide(F.lit(100.0) * F.col("_out"), F.col("_values"))
    details = _json(F.col("_out").alias("outlier_count"), rate.alias("outlier_rate"),
                    F.struct(F.col("_mean").alias("mean"), F.col("_std").alias("std"),
                             F.col("_min").alias("min"), F.col("_max").alias("max")).alias("value_stats"))
    none = F.col("_values") == 0
    return Measured(
        F.when(none, F.lit("error")).otherwise(_grade(rate < OUTLIER_PCT_LIMIT)),
        F.when(none, _json(F.lit("division by zero: no metric values").alias("error"))).otherwise(details),
        {"_values": F.count(v), "_out": F.count_if(outside), "_mean": F.avg(v), "_std": F.stddev_samp(v),
         "_min": F.min(v), "_max": F.max(v)})


def check_ranges(df: DataFrame) -> DataFrame:
    return _alone(df, "metric_ranges", measure_ranges(df))


def measure_schema(df: DataFrame) -> Measured:
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    return Measured(_grade(F.lit(not missing)), _json(
        F.array(*[F.lit(c) for c in REQUIRED_COLUMNS]).alias("required_columns"),
        F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing_columns"),
        F.array(*[F.lit(c) for c in df.columns]).alias("actual_columns")))


def check_schema(df: DataFrame) -> DataFrame:
    return _alone(df, "schema_validation", measure_schema(df))


def measure_empty(df: DataFrame) -> Measured:
    return Measured(_grade(F.col("_n") > 0), _json(F.col("_n").alias("rows")))


def schema_columns(df: DataFrame) -> DataFrame:
    """(column_name, present, non_null_rows) for each required column: presence from the
    schema, non-null rows from one aggregate over the present ones (0 when absent)."""
    present = [c for c in REQUIRED_COLUMNS if c in df.columns]
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(present)]) if present \
        else df.sparkSession.range(1)
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(c in present).alias("present"),
                 (F.col(f"_n{present.index(c)}") if c in present else F.lit(0).cast("bigint")).alias("non_null_rows"))
        for c in REQUIRED_COLUMNS
    ]
    return counts.select(F.inline(F.array(*entries)))


@dataclass
class QualityCheck:
    name: str
    description: str
    severity: str
    measure: Callable[[DataFrame, dt.datetime], Measured]
    enabled: bool = True
    needs_rows: bool = True      # skipped on an empty dataset


# The check catalogue (name, description, severity). The empty-dataset check is an addition: an
# empty dataset gives this one alert, and the checks that need rows are skipped.
DEFAULT_CHECKS = [
    QualityCheck("null_values", "Check for excessive null values", SEV_MEDIUM, lambda d, _: measure_nulls(d)),
    QualityCheck("duplicate_records", "Check for duplicate records", SEV_LOW, lambda d, _: measure_duplicates(d)),
    QualityCheck("data_freshness", "Check data freshness", SEV_HIGH, measure_freshness),
    QualityCheck("metric_ranges", "Check metric values are in expected ranges", SEV_MEDIUM,
                 lambda d, _: measure_ranges(d)),
    QualityCheck("schema_validation", "Validate expected columns exist", SEV_HIGH, lambda d, _: measure_schema(d),
                 needs_rows=False),
    QualityCheck("empty_dataset", "Check the dataset has rows", SEV_HIGH, lambda d, _: measure_empty(d),
                 needs_rows=False),
]

RESULT_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("check_name", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("details", T.StringType()),
    T.StructField("record_count", T.LongType()),
])


def _failed_measure(exc: Exception) -> Measured:
    return Measured(F.lit("error"), _json(F.lit(str(exc)).alias("error")))


def _result(dataset: str, check: QualityCheck, m: Measured) -> Column:
    skip = (F.col("_n") == 0) & F.lit(check.needs_rows)
    values = (F.lit(dataset), F.lit(check.name), F.lit(check.description), F.lit(check.severity),
              F.when(skip, F.lit("skipped")).otherwise(m.status),
              F.when(skip, _json(F.lit("dataset has no rows").alias("message"))).otherwise(m.details), F.col("_n"))
    return F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, RESULT_SCHEMA.fields)])


def run_checks(df: DataFrame, dataset: str, as_of: dt.datetime,
               checks: list[QualityCheck] | None = None) -> DataFrame:
    """All enabled checks on one dataset -> (dataset, check_name, description, severity,
    status, details, record_count), as a lazy plan: one aggregate over the rows and one per check with a
    source of its own. A check that fails to plan is an error row (see ``store_checks`` for failures at run time).
    """
    shared, own = [], []
    for check in DEFAULT_CHECKS if checks is None else checks:
        if check.enabled:
            try:
                m = check.measure(df, as_of)
            except Exception as exc:  # noqa: BLE001 - a failing check becomes a HIGH alert row
                m = _failed_measure(exc)
            (shared if m.source is None else own).append((check, m))
    groups = ([shared] if shared else []) + [[one] for one in own]
    out = None
    for group in groups:
        graded = _aggregate(df, [m for _, m in group]).select(F.inline(F.array(*[_result(dataset, c, m) for c, m in group])))
        out = graded if out is None else out.unionByName(graded)
    return df.sparkSession.createDataFrame([], RESULT_SCHEMA) if out is None else out


def store_checks(df: DataFrame, dataset: str, as_of: dt.datetime, checks: list[QualityCheck] | None = None) -> DataFrame:
    """``run_checks``, written as a table in the shared folder and read back. Should that job fail, the checks
    are written one by one, so that one that fails at run time is one error row with the whole error text."""
    spark = df.sparkSession
    path = scratch_path(spark, "quality-checks")
    try:
        run_checks(df, dataset, as_of, checks).write.parquet(path)
    except Exception:  # noqa: BLE001
        path = scratch_path(spark, "quality-checks-single")
        for check in DEFAULT_CHECKS if checks is None else checks:
            try:
                run_checks(df, dataset, as_of, [check]).write.mode("append").parquet(path)
            except Exception as exc:  # noqa: BLE001 - a failing check becomes a HIGH alert row
                unknown = spark.range(1).select(F.lit(None).cast("bigint").alias("_n"))
                unknown.select(F.inline(F.array(_result(dataset, check, _failed_measure(exc))))) \
                    .write.mode("append").parquet(path)
    return spark.read.schema(RESULT_SCHEMA).parquet(path)


def alerts_from_checks(results: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Failed checks -> alerts at the check's severity; errored checks -> HIGH alerts; skipped checks -> none."""
    stamp = F.lit(as_of) if as_of is not None else F.current_timestamp()
    failed = F.col("status") == "failed"
    return results.where(F.col("status").isin("failed", "error")).select(
        F.when(failed, F.concat(F.lit("Data Quality Issue: "), "check_name"))
        .otherwise(F.concat(F.lit("Data Quality Check Error: "), "check_name")).alias("title"),
        F.when(failed, F.concat("description", F.lit(" failed for "), "dataset"))
        .otherwise(F.concat(F.lit("Error running "), "check_name", F.lit(" on "), "dataset")).alias("message"),
        F.when(failed, F.col("severity")).otherwise(F.lit(SEV_HIGH)).alias("severity"),
        stamp.alias("timestamp"),
        "dataset", "check_name", "details", "record_count",
    )


def quality_report(spark: SparkSession, datasets: dict[str, DataFrame], as_of: dt.datetime,
                   stored: bool = True) -> tuple[DataFrame, DataFrame]:
    """Validate several datasets: (alerts, counts by severity incl. zero rows).

    Both results read the stored check results, so the checks run once; with ``stored=False`` they stay
    lazy plans over the data."""
    checked = store_checks if stored else run_checks
    alerts = None
    for name, df in datasets.items():
        a = alerts_from_checks(checked(df, name, as_of), as_of)
        alerts = a if alerts is None else alerts.unionByName(a)
    sev = local_table(spark, [(s,) for s in SEVERITIES], T.StructType([T.StructField("severity", T.StringType())]))
    counts = sev.join(alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("alerts")), "severity", "left").select(
        "severity", F.coalesce(F.col("alerts"), F.lit(0)).cast("bigint").alias("alerts")
    )
    return alerts, counts


__all__ = ["DEFAULT_CHECKS", "Measured", "QualityCheck", "alerts_from_checks", "check_duplicates",
           "check_freshness", "check_nulls", "check_ranges", "check_schema", "null_percentages",
           "quality_report", "run_checks", "schema_columns", "store_checks"]
