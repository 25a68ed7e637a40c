"""Table schemas and fixed vocabulary of the monitoring model."""

from __future__ import annotations

from pyspark.sql import types as T

# Health status and alert severity vocabularies.
CRITICAL = "critical"
WARNING = "warning"
HEALTHY = "healthy"
STATUSES = [CRITICAL, WARNING, HEALTHY]

SEV_LOW = "low"
SEV_MEDIUM = "medium"
SEV_HIGH = "high"
SEV_CRITICAL = "critical"
SEVERITIES = [SEV_LOW, SEV_MEDIUM, SEV_HIGH, SEV_CRITICAL]

# Tag keys read from a run.
TAG_USER = "mlflow.user"
TAG_RUN_NAME = "mlflow.runName"

STR_MAP = T.MapType(T.StringType(), T.StringType())

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("params", STR_MAP),
    T.StructField("tags", STR_MAP),
])

RUNS_RAW = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment_id", T.StringType()),
    T.StructField("start_time", T.LongType()),
    T.StructField("end_time", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("params", STR_MAP),
    T.StructField("tags", STR_MAP),
])

EXPERIMENTS = T.StructType([
    T.StructField("experiment_id", T.StringType()),
    T.StructField("name", T.StringType()),
])

METRIC_METADATA = T.StructType([
    T.StructField("metric_name", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("higher_is_better", T.BooleanType()),
])

THRESHOLDS = T.StructType([
    T.StructField("metric_name", T.StringType()),
    T.StructField("critical_threshold", T.DoubleType()),
    T.StructField("warning_threshold", T.DoubleType()),
    T.StructField("experiment_id", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("updated_by", T.StringType()),
])

METRIC_ROW = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment_id", T.StringType()),
    T.StructField("experiment_name", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("params", STR_MAP),
    T.StructField("tags", STR_MAP),
    T.StructField("extraction_timestamp", T.TimestampType()),
])

PIPELINE_METRIC = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("tags", STR_MAP),
])
