"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Each query builds the monitoring tables from the test data directory and
applies one operator; the final projection flattens nested values (arrays as
joined text, maps as rows) and rounds derived doubles so the result can be
compared with the DuckDB oracle in ``runlens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.stats import round6
from runlens.operators import summaries as sm
from runlens.plans.context import AS_OF, build

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@query("enrich_status")
def q_enrich_status(spark, sf_dir):
    e = build(spark, sf_dir).enriched_base
    return e.select(
        "run_id", "experiment_id", "metric_name", round6(F.col("metric_value")).alias("metric_value"), "status",
        "critical_threshold", "warning_threshold", "threshold_source", "display_name", "unit", "category",
        "higher_is_better", "run_state",
    )


@query("moving_avg_rows")
def q_moving_avg_rows(spark, sf_dir):
    e = build(spark, sf_dir).enriched
    return e.select(
        "run_id", "experiment_id", "metric_name", "start_time",
        round6(F.col("metric_value")).alias("metric_value"),
        round6(F.col("moving_avg_24h")).alias("moving_avg_24h"),
    )


@query("forecast_next")
def q_forecast_next(spark, sf_dir):
    from runlens.operators.series import series_forecast

    e = series_forecast(build(spark, sf_dir).enriched_base)
    return e.select("run_id", "experiment_id", "metric_name", round6(F.col("forecast_next")).alias("forecast_next"))


@query("run_status")
def q_run_status(spark, sf_dir):
    return sm.run_status(build(spark, sf_dir).classified).select(
        "run_id", "experiment_name", "user_id", "start_time", "run_status",
        "total_metrics", "critical_metrics", "warning_metrics",
    )


@query("platform_hourly")
def q_platform_hourly(spark, sf_dir):
    h = sm.platform_hourly(sm.run_status(build(spark, sf_dir).classified))
    return h.select(
        F.col("time_hour").alias("timestamp"), "total_runs", "critical_runs", "warning_runs", "healthy_runs",
        round6(F.col("pass_rate")).alias("pass_rate"),
    )


@query("platform_summary")
def q_platform_summary(spark, sf_dir):
    p = sm.platform_summary(build(spark, sf_dir).classified, AS_OF)
    return p.select(
        "timestamp", "total_runs", "critical_runs", "warning_runs", "healthy_runs",
        round6(F.col("pass_rate")).alias("pass_rate"),
        round6(F.col("pass_rate_trend")).alias("pass_rate_trend"),
        F.array_join("recent_run_ids", ",").alias("recent_run_ids"),
        F.array_join("active_applications", ",").alias("active_applications"),
        "aggregation_timestamp",
    )


# ---------------------------------------------------------------- ingestion (PRJ1-5, JN1, SRC1-2)

@query("flatten_runs")
def q_flatten_runs(spark, sf_dir):
    from runlens.operators.flatten import flatten_runs
    from runlens.sources.fixtures import runs_raw_from_runs

    t = build(spark, sf_dir)
    rows = flatten_runs(runs_raw_from_runs(t.runs), t.experiments, AS_OF)
    return rows.select(
        "run_id", "experiment_id", "experiment_name", "user_id", "run_name", "start_time", "end_time",
        "status", "metric_name", round6(F.col("metric_value")).alias("metric_value"), "extraction_timestamp",
    )


@query("lookback_runs")
def q_lookback_runs(spark, sf_dir):
    from runlens.sources.runs import scan_runs

    t = build(spark, sf_dir)
    r = scan_runs(t.runs, t.experiments, AS_OF, "168 HOURS", "name IN ('app-1', 'app-2', 'app-3')")
    return r.select("run_id", "experiment_id", "start_time")


@query("landed_lookback")
def q_landed_lookback(spark, sf_dir):
    """The run table lands in three extracts; the lookback scan opens only the files whose zones meet its window."""
    from runlens.session import scratch_path
    from runlens.sources.landing import files_between, land_runs, scan_landed

    t, folder = build(spark, sf_dir), scratch_path(spark, "landed-runs")
    day = F.dayofmonth("start_time")
    for low, high in ((1, 10), (11, 20), (21, 31)):
        land_runs(t.runs.where(day.between(low, high)), folder)
    r = scan_landed(spark, folder, t.experiments, AS_OF, 168, "name IN ('app-1', 'app-2', 'app-3')")
    fewer = len({*r.inputFiles()} & {*t.runs.inputFiles()}) == 0 and len(r.inputFiles()) < len(files_between(spark, folder))
    return r.select("run_id", "experiment_id", "start_time", F.lit(fewer).alias("fewer_files"))


# ---------------------------------------------------------------- enrichment (JN2-3, CLS1-2, FLT3, WIN3)

@query("threshold_resolution")
def q_threshold_resolution(spark, sf_dir):
    from runlens.operators.enrich import threshold_resolution

    return threshold_resolution(build(spark, sf_dir).enriched_base)


@query("unmatched_metrics")
def q_unmatched_metrics(spark, sf_dir):
    from runlens.operators.enrich import unmatched_metrics

    t = build(spark, sf_dir)
    return unmatched_metrics(t.metric_rows, t.metadata, t.thresholds)


@query("moving_avg_time")
def q_moving_avg_time(spark, sf_dir):
    from runlens.operators.series import moving_average_time

    from runlens.sources import fixtures as fx

    e = moving_average_time(build(spark, sf_dir).enriched_base, window_hours=24)
    return e.select("run_id", "metric_name", "start_time", round6(F.col("moving_avg_time")).alias("moving_avg_time"))


# ---------------------------------------------------------------- platform (AGG1-2, 5-6, 11-12, WIN1)

@query("pass_rate_trend")
def q_pass_rate_trend(spark, sf_dir):
    h = sm.pass_rate_lag(sm.platform_hourly(sm.run_status(build(spark, sf_dir).classified)))
    return h.select(
        F.col("time_hour").alias("timestamp"), round6(F.col("pass_rate")).alias("pass_rate"),
        round6(F.col("pass_rate_24h_ago")).alias("pass_rate_24h_ago"),
        round6(F.col("pass_rate_trend")).alias("pass_rate_trend"),
        round6(F.col("pass_rate_trend_24h")).alias("pass_rate_trend_24h"),
    )


@query("recent_runs_per_hour")
def q_recent_runs(spark, sf_dir):
    r = sm.recent_runs_per_hour(sm.run_status(build(spark, sf_dir).classified))
    return r.select(F.col("time_hour").alias("timestamp"), F.col("position").cast("bigint").alias("position"), "run_id")


@query("active_applications")
def q_active_applications(spark, sf_dir):
    h = sm.platform_hourly(sm.run_status(build(spark, sf_dir).classified))
    return h.select(F.col("time_hour").alias("timestamp"), F.explode("active_applications").alias("application"))


# ---------------------------------------------------------------- applications (AGG3-4, 7-10, 13, JN4)

@query("app_run_status")
def q_app_run_status(spark, sf_dir):
    return sm.app_run_status(build(spark, sf_dir).classified).select(
        "application", "run_id", "user_id", "start_time", "run_status")


@query("app_hourly")
def q_app_hourly(spark, sf_dir):
    h = sm.app_hourly(sm.app_run_status(build(spark, sf_dir).classified))
    return h.select(
        F.col("time_hour").alias("timestamp"), "application", "total_runs", "critical_runs", "warning_runs",
        "healthy_runs", round6(F.col("pass_rate")).alias("pass_rate"),
    )


@query("app_metric_summary")
def q_app_metric_summary(spark, sf_dir):
    s = sm.app_metric_summary(build(spark, sf_dir).enriched, AS_OF)
    dbl = ["avg_value", "stddev_value", "min_value", "max_value", "latest_value", "latest_moving_avg",
           "trend_correlation"]
    return s.select(
        "application", "metric_name", "display_name", "category", "unit", "total_measurements", "latest_status",
        *[round6(F.col(c)).alias(c) for c in dbl],
    )


@query("application_summary")
def q_application_summary(spark, sf_dir):
    a = sm.application_summary(build(spark, sf_dir).classified, AS_OF)
    x = a.select("*", F.explode("metrics").alias("metric_key", "m"))
    return x.select(
        "timestamp", "application", "total_runs", "critical_runs", "warning_runs", "healthy_runs",
        round6(F.col("pass_rate")).alias("pass_rate"), "metric_key",
        round6(F.col("m.latest_value")).alias("latest_value"), F.col("m.latest_status").alias("latest_status"),
        round6(F.col("m.avg_value")).alias("avg_value"), round6(F.col("m.trend")).alias("trend"),
        F.col("m.display_name").alias("display_name"), F.col("m.unit").alias("unit"), "aggregation_timestamp",
    )


# ---------------------------------------------------------------- time series (JN5, AGG14-15, PRJ6-8)

@query("run_summary_metrics")
def q_run_summary_metrics(spark, sf_dir):
    r = sm.run_summary_metrics(build(spark, sf_dir).enriched)
    return r.select("run_id", F.explode("run_metrics").alias("metric_name", "metric_value")).select(
        "run_id", "metric_name", round6(F.col("metric_value")).alias("metric_value"))


@query("metric_timeseries")
def q_metric_timeseries(spark, sf_dir):
    ts = sm.metric_timeseries(build(spark, sf_dir).enriched, AS_OF)
    return ts.select(
        "timestamp", "run_id", "run_name", "user_id", "application", "metric_name", "display_name",
        round6(F.col("value")).alias("value"), "status", round6(F.col("moving_avg")).alias("moving_avg"),
        round6(F.col("forecast")).alias("forecast"), "critical_threshold", "warning_threshold", "unit",
        "description", "key_params",
        F.size(F.from_json("run_summary_metrics", "map<string,double>")).cast("bigint").alias("run_metric_count"),
        "extraction_timestamp", "enrichment_timestamp",
    )


@query("key_params")
def q_key_params(spark, sf_dir):
    from runlens.functions.maps import key_params_json, lower_keys

    rows = build(spark, sf_dir).metric_rows
    return rows.select("run_id", key_params_json(lower_keys(F.col("params"))).alias("key_params")).distinct()


# ---------------------------------------------------------------- data quality (DQ1-7)

def _quality_input(spark, sf_dir):
    """metric rows plus a re-read of the first day's runs (duplicates by (run, metric))."""
    rows = build(spark, sf_dir).metric_rows
    reread = rows.where(F.col("start_time") < F.lit("2024-01-02 00:00:00").cast("timestamp"))
    return rows.unionByName(reread)


_DQ_COLUMNS = ["run_id", "experiment_id", "experiment_name", "user_id", "run_name", "start_time", "end_time",
               "metric_name", "metric_value", "params", "unit", "moving_avg_24h", "forecast_next"]


@query("dq_nulls")
def q_dq_nulls(spark, sf_dir):
    from runlens.operators.quality import null_percentages

    e = build(spark, sf_dir).enriched.select(*_DQ_COLUMNS)
    p = null_percentages(e)
    return p.select("column_name", "null_count", "total", round6(F.col("null_pct")).alias("null_pct"),
                    (F.col("null_pct") <= F.lit(10.0)).alias("within_limit"))


def _detail(name: str, typ: str = "double"):
    c = F.get_json_object("details", f"$.{name}").cast(typ)
    return (round6(c) if typ == "double" else c).alias(name.split(".")[-1])


@query("dq_duplicates")
def q_dq_duplicates(spark, sf_dir):
    from runlens.operators.quality import check_duplicates

    r = check_duplicates(_quality_input(spark, sf_dir))
    return r.select("check_name", "status", _detail("duplicate_count", "bigint"), _detail("duplicate_rate"))


@query("dq_freshness")
def q_dq_freshness(spark, sf_dir):
    from runlens.operators.quality import check_freshness

    r = check_freshness(build(spark, sf_dir).classified, AS_OF)
    return r.select("check_name", "status", _detail("latest_timestamp", "string"), _detail("age_hours"))


@query("dq_ranges")
def q_dq_ranges(spark, sf_dir):
    from runlens.operators.quality import check_ranges

    r = check_ranges(build(spark, sf_dir).classified)
    return r.select("check_name", "status", _detail("outlier_count", "bigint"), _detail("outlier_rate"),
                    _detail("value_stats.mean"), _detail("value_stats.std"), _detail("value_stats.min"),
                    _detail("value_stats.max"))


@query("dq_schema")
def q_dq_schema(spark, sf_dir):
    from runlens.operators.quality import schema_columns

    return schema_columns(build(spark, sf_dir).enriched.drop("experiment_name"))


def _dq_datasets(spark, sf_dir):
    t = build(spark, sf_dir)
    return {"raw_metric_rows": _quality_input(spark, sf_dir), "enriched_metrics": t.enriched}


@query("dq_alerts")
def q_dq_alerts(spark, sf_dir):
    from runlens.operators.quality import quality_report

    alerts, _ = quality_report(spark, _dq_datasets(spark, sf_dir), AS_OF, stored=False)
    return alerts.select("dataset", "check_name", "severity", "title", "message", "record_count")


@query("dq_report")
def q_dq_report(spark, sf_dir):
    from runlens.operators.quality import quality_report

    _, counts = quality_report(spark, _dq_datasets(spark, sf_dir), AS_OF, stored=False)
    return counts


# ---------------------------------------------------------------- alerts (ALR1-3, WIN5)

def _platform(spark, sf_dir):
    return sm.platform_summary(build(spark, sf_dir).classified, AS_OF)


@query("critical_rate_alerts")
def q_critical_rate_alerts(spark, sf_dir):
    from runlens.operators.alerts import critical_rate_alerts

    a = critical_rate_alerts(_platform(spark, sf_dir))
    return a.select("timestamp", round6(F.col("critical_rate")).alias("critical_rate"), "title", "severity", "message")


@query("pass_rate_alerts")
def q_pass_rate_alerts(spark, sf_dir):
    from runlens.operators.alerts import pass_rate_alerts

    a = pass_rate_alerts(_platform(spark, sf_dir))
    return a.select("timestamp", round6(F.col("pass_rate")).alias("pass_rate"), "title", "severity", "message")


@query("alert_report")
def q_alert_report(spark, sf_dir):
    from runlens.operators.alerts import alert_report

    a = alert_report(_platform(spark, sf_dir), AS_OF)
    return a.select("timestamp", "critical_runs", "total_runs", round6(F.col("pass_rate")).alias("pass_rate"),
                    "report_status", "title", "severity", "message", "check_timestamp")


# ---------------------------------------------------------------- profiles (AGG16-22, SRT5)

@query("extraction_profile")
def q_extraction_profile(spark, sf_dir):
    from runlens.operators.profiles import extraction_profile

    return extraction_profile(build(spark, sf_dir).metric_rows)


@query("enrichment_profile")
def q_enrichment_profile(spark, sf_dir):
    from runlens.operators.profiles import enrichment_profile

    t = build(spark, sf_dir)
    p = enrichment_profile(t.enriched, t.metric_rows)
    return p.select("total_enriched_records", "unique_metrics", "unique_experiments",
                    round6(F.col("avg_moving_avg")).alias("avg_moving_avg"), "metrics_with_metadata")


@query("sample_critical_metrics")
def q_sample_critical_metrics(spark, sf_dir):
    from runlens.operators.profiles import sample_critical_metrics

    return sample_critical_metrics(build(spark, sf_dir).enriched)


@query("output_profile")
def q_output_profile(spark, sf_dir):
    from runlens.operators.profiles import output_profile

    from runlens.session import scratch_path

    # The dashboard tables are written as a job writes them; the profile reads the stored copies.
    t, base = build(spark, sf_dir), scratch_path(spark, "output-profile")
    tables = {"platform": sm.platform_summary(t.classified, AS_OF), "application": sm.application_summary(t.classified, AS_OF),
              "timeseries": sm.metric_timeseries(t.enriched, AS_OF)}
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
    p = output_profile(*[spark.read.schema(df.schema).parquet(f"{base}/{name}") for name, df in tables.items()])
    return p.select("table_name", "stat", round6(F.col("num_value")).alias("num_value"), "text_value")


@query("top_experiments")
def q_top_experiments(spark, sf_dir):
    from runlens.operators.profiles import top_experiments

    return top_experiments(build(spark, sf_dir).metric_rows)


@query("top_metrics")
def q_top_metrics(spark, sf_dir):
    from runlens.operators.profiles import top_metrics

    return top_metrics(build(spark, sf_dir).metric_rows)


@query("param_profile")
def q_param_profile(spark, sf_dir):
    from runlens.operators.profiles import param_profile

    return param_profile(build(spark, sf_dir).metric_rows)


@query("params_null_share")
def q_params_null_share(spark, sf_dir):
    from runlens.operators.profiles import params_null_share

    p = params_null_share(build(spark, sf_dir).metric_rows)
    return p.select("rows", "null_params", round6(F.col("null_params_pct")).alias("null_params_pct"))


@query("status_distribution")
def q_status_distribution(spark, sf_dir):
    from runlens.operators.profiles import status_distribution

    d = status_distribution(build(spark, sf_dir).enriched)
    return d.select("status", "count", round6(F.col("percentage")).alias("percentage"))


# ---------------------------------------------------------------- dimension sources (SRC3-8, SNK8)

def _metadata(spark, sf_dir):
    from runlens.sources.dimensions import parse_metadata
    from runlens.sources.fixtures import metadata_payloads

    return parse_metadata(metadata_payloads(spark, build(spark, sf_dir).events))


def _thresholds(spark, sf_dir):
    from runlens.sources.fixtures import threshold_payloads

    return threshold_payloads(spark, build(spark, sf_dir).events)


_META_COLS = ["metric_name", "display_name", "description", "unit", "category", "higher_is_better"]
_THR_COLS = ["metric_name", "critical_threshold", "warning_threshold", "experiment_id", "updated_at", "updated_by"]


@query("metadata_parse")
def q_metadata_parse(spark, sf_dir):
    from runlens.sources.dimensions import dedupe_metadata

    return dedupe_metadata(_metadata(spark, sf_dir)).select(*_META_COLS)


@query("thresholds_parse")
def q_thresholds_parse(spark, sf_dir):
    from runlens.sources.dimensions import parse_thresholds

    return parse_thresholds(_thresholds(spark, sf_dir)).select(*_THR_COLS)


@query("platform_defaults")
def q_platform_defaults(spark, sf_dir):
    from runlens.sources.dimensions import parse_thresholds, platform_defaults

    # Only the valid items reach the strict reader, as a well-formed response would.
    ok = parse_thresholds(_thresholds(spark, sf_dir))
    payload = F.concat(F.lit('{"thresholds":['), F.to_json(F.struct(
        "metric_name", "critical_threshold", "warning_threshold", "experiment_id",
        F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"), "updated_by"),
        {"ignoreNullFields": "false"}), F.lit("]}")).alias("payload")
    return platform_defaults(ok.select(payload)).select(*_THR_COLS)


@query("metric_lookup")
def q_metric_lookup(spark, sf_dir):
    from runlens.sources.dimensions import metric_lookup

    return metric_lookup(_metadata(spark, sf_dir), "click").select(*_META_COLS)


@query("list_metrics")
def q_list_metrics(spark, sf_dir):
    from runlens.sources.dimensions import list_metrics

    return list_metrics(_metadata(spark, sf_dir))


@query("threshold_upsert")
def q_threshold_upsert(spark, sf_dir):
    """Tighten every platform default of a metric seen in the batch by 10 %: append to the stored log,
    then read its current view (newest row per (metric, experiment))."""
    from runlens.session import scratch_path
    from runlens.sinks import thresholds_log
    from runlens.sources.dimensions import parse_thresholds

    path = scratch_path(spark, "thresholds")
    thresholds_log.append(parse_thresholds(_thresholds(spark, sf_dir)), path)
    log = thresholds_log.stored(spark, path)
    seen = build(spark, sf_dir).metric_rows.select("metric_name").distinct()
    updates = log.where(F.col("experiment_id").isNull()).join(seen, "metric_name", "left_semi").select(
        "metric_name", (F.col("critical_threshold") * F.lit(0.9)).alias("critical_threshold"),
        (F.col("warning_threshold") * F.lit(0.9)).alias("warning_threshold"), "experiment_id",
    )
    thresholds_log.append(thresholds_log.stamped(updates, "runlens-job", AS_OF), path)
    cur = thresholds_log.current_thresholds(thresholds_log.stored(spark, path))
    return cur.select("metric_name", "experiment_id", round6(F.col("critical_threshold")).alias("critical_threshold"),
                      round6(F.col("warning_threshold")).alias("warning_threshold"), "updated_at", "updated_by")


# ---------------------------------------------------------------- storage, layout, job metrics (SRC9-10, SNK1-7, PM1-5)

@query("snapshot_roundtrip")
def q_snapshot_roundtrip(spark, sf_dir):
    """Write the enriched table as a snapshot twice under one run key (idempotent),
    log an empty snapshot of another table, then load the latest snapshot."""
    from runlens.session import scratch_path
    from runlens.sinks.snapshots import load_latest, run_key, write_snapshot

    base = scratch_path(spark, "snapshots")
    e = build(spark, sf_dir).enriched.persist()
    key = run_key("historical", AS_OF)
    write_snapshot(e, base, "enriched_metrics", key, AS_OF)
    write_snapshot(e, base, "enriched_metrics", key, AS_OF)
    write_snapshot(e.limit(0), base, "platform_summary", key, AS_OF)
    e.unpersist()
    back = load_latest(spark, base, "enriched_metrics")
    return back.select("run_id", "metric_name", "status", round6(F.col("moving_avg_24h")).alias("moving_avg_24h"))


@query("layout_infer")
def q_layout_infer(spark, sf_dir):
    from runlens.sinks.layout import infer_types

    rows = build(spark, sf_dir).metric_rows
    text = rows.select(
        "run_id", "metric_name",
        F.col("metric_value").cast("string").alias("value_text"),
        F.col("start_time").cast("string").alias("start_time"),
        F.regexp_extract("run_id", r"-(\d+)-", 1).alias("user_number"),
        F.col("user_id").alias("owner"),
    )
    return infer_types(text)


@query("snapshot_typed")
def q_snapshot_typed(spark, sf_dir):
    """Text columns stored in the types that the sketch finds, and loaded as the same text."""
    from runlens.session import scratch_path
    from runlens.sinks.snapshots import load_latest, snapshot_log, write_snapshot

    rows = build(spark, sf_dir).metric_rows
    whole = F.floor("metric_value").cast("bigint").cast("string")
    cents = F.lpad((F.regexp_extract("run_id", r"-(\d+)-", 1).cast("int") % 100).cast("string"), 2, "0")
    text = rows.select(
        "run_id", "metric_name", whole.alias("whole"), F.concat(whole, F.lit("."), cents).alias("price"),
        F.concat(F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")).alias("local_time"),
        F.when(F.col("metric_name") == "click", "9007199254740993").otherwise("2.5").alias("mixed"))
    base = scratch_path(spark, "typed")
    write_snapshot(text, base, "texts", "typed", AS_OF, infer=True)
    kinds = dict(load_latest(spark, base, "texts", physical=True).dtypes)
    # One log row: which columns are dictionary-encoded.
    layout = snapshot_log(spark, base).select("layout_json").first()[0]
    encoded = F.from_json(F.lit(layout), "array<struct<column_name:string,dictionary:boolean>>")
    coded = F.array_join(F.transform(F.filter(encoded, lambda x: x["dictionary"]), lambda x: x["column_name"]), ",")
    return load_latest(spark, base, "texts").select(
        *text.columns, *[F.lit(kinds[c]).alias(f"{c}_type") for c in ("whole", "price", "local_time", "mixed")], coded.alias("dictionary_columns"))


@query("snapshot_logs")
def q_snapshot_logs(spark, sf_dir):
    """The write and load records that one table's snapshots leave (columns that do not depend on the clock)."""
    from runlens.session import scratch_path
    from runlens.sinks.snapshots import load_latest, load_log, load_snapshot, snapshot_log, write_snapshot

    t, base = build(spark, sf_dir), scratch_path(spark, "logs")
    rows = t.classified.select("run_id", "metric_name", "status")
    write_snapshot(rows.where("status = 'critical'"), base, "classified", "first", AS_OF)
    write_snapshot(rows, base, "classified", "second", AS_OF)
    write_snapshot(rows.limit(0), base, "classified", "third", AS_OF)
    load_latest(spark, base, "classified")
    load_snapshot(spark, base, "classified", "second")
    load_snapshot(spark, base, "classified", "second")
    common = ["table_name", "snapshot_id", "snapshot_date", "rows", F.array_join("columns", ",").alias("columns"), "data_types",
              ((F.col("size_mb") > 0) == (F.col("rows") > 0)).alias("sized")]
    written = snapshot_log(spark, base).select(F.lit("write").alias("event"), "commit_no", *common)
    return written.unionByName(load_log(spark, base).select(F.lit("load").alias("event"), "commit_no", *common))


@query("sink_order")
def q_sink_order(spark, sf_dir):
    """Order inside and across the files of the three dashboard tables as a job writes them, and of a shuffled copy."""
    from functools import reduce

    from runlens.operators import summaries as sm
    from runlens.session import scratch_path
    from runlens.sinks.order import inversions
    from runlens.sinks.snapshots import write_snapshot

    t, base = build(spark, sf_dir), scratch_path(spark, "order")
    by_app = [("application", False), ("timestamp", True)]
    platform = sm.platform_summary(t.classified, AS_OF)
    outputs = {
        "platform_summary": (platform, [("timestamp", True)]),
        "application_summary": (sm.application_summary(t.classified, AS_OF).drop("metrics"), by_app),
        "metric_timeseries": (sm.sort_timeseries(sm.metric_timeseries(t.enriched, AS_OF)),
                              [("application", False), ("metric_name", False), ("timestamp", False)]),
        "shuffled": (platform.repartition(3, F.xxhash64("timestamp")).sortWithinPartitions(F.xxhash64("timestamp")), [("timestamp", True)]),
    }
    checked = []
    for name, (df, keys) in outputs.items():
        record = write_snapshot(df, base, name, "order", AS_OF, sort_by_time=False)
        stored = spark.read.schema(df.schema).parquet(record["data_path"])
        checked.append(inversions(stored, keys).select(
            F.lit(name).alias("table_name"), "rows", (F.col("inside") == 0).alias("ordered_inside"), (F.col("across") == 0).alias("ordered_across")))
    return reduce(lambda a, b: a.unionByName(b), checked)


def _job_metrics(spark, sf_dir):
    """The stored metrics table of a backup job replayed at the end of the busiest hour."""
    from runlens.plans.jobs import backup_job
    from runlens.session import scratch_path

    t, base = build(spark, sf_dir), scratch_path(spark, "job-metrics")
    job = backup_job(spark, t.runs, t.experiments, t.metadata, t.thresholds, base, _busiest(t))
    return job["metrics"]


@query("job_metrics_table")
def q_job_metrics_table(spark, sf_dir):
    """Rows, megabytes, durations and status shares of a job as stored; the clock's values as whether they are positive."""
    counted = F.col("unit").isin("records", "%")
    return _job_metrics(spark, sf_dir).select("name", "unit", round6(F.when(counted, F.col("value"))).alias("value"), (F.col("value") > 0).alias("positive"))


@query("job_metrics_overview")
def q_job_metrics_overview(spark, sf_dir):
    """Summary (count, distinct names, time range) of a job's metrics."""
    from runlens.sinks import metric_log

    return metric_log.summary(_job_metrics(spark, sf_dir)).select(
        "total_metrics", F.array_join("metric_types", ",").alias("metric_types"), (F.col("time_range_start") < F.col("time_range_end")).alias("spans_time"))


@query("job_metrics_newest")
def q_job_metrics_newest(spark, sf_dir):
    """The ten newest values of a job's metrics, newest first."""
    from pyspark.sql import Window

    from runlens.sinks import metric_log

    newest = metric_log.newest(_job_metrics(spark, sf_dir))     # ten rows
    order = Window.orderBy(F.desc("timestamp"), "name", "value")
    return newest.select(F.row_number().over(order).alias("position"), "name", "unit")


@query("job_metrics_summary")
def q_job_metrics_summary(spark, sf_dir):
    """Data volumes and the status distribution, appended to the metrics table and read back."""
    from runlens.operators.profiles import status_distribution
    from runlens.session import scratch_path
    from runlens.sinks import metric_log

    t = build(spark, sf_dir)
    path = scratch_path(spark, "job-metrics")
    metric_log.append(metric_log.row_count(t.metric_rows, "metric_rows", AS_OF), path)
    metric_log.append(metric_log.row_count(t.enriched, "enriched_metrics", AS_OF), path)
    metric_log.append(metric_log.status_shares(status_distribution(t.enriched), AS_OF), path)
    return metric_log.stored(spark, path).select("name", round6(F.col("value")).alias("value"), "unit")


@query("historical_job")
def q_historical_job(spark, sf_dir):
    """The 30-day job end to end (snapshots in the shared folder); returns the
    platform summary it wrote, reloaded from its snapshot."""
    from runlens.plans.jobs import historical_job
    from runlens.session import scratch_path
    from runlens.sinks.snapshots import load_latest
    from runlens.sources import fixtures as fx

    t = build(spark, sf_dir)
    base = scratch_path(spark, "jobs")
    historical_job(spark, t.runs, t.experiments, t.metadata, t.thresholds, base, AS_OF)
    p = load_latest(spark, base, "platform_summary")
    return p.select("timestamp", "total_runs", "critical_runs", "warning_runs", "healthy_runs",
                    round6(F.col("pass_rate")).alias("pass_rate"), round6(F.col("pass_rate_trend")).alias("pass_rate_trend"))


# ---------------------------------------------------------------- streaming (ST1-4)

def _drain_stream(spark, sf_dir):
    """Three overlapping extracts (days 1-12, 10-22, 20-end), as a poller would land
    them; after each landing the stream drains what is new (availableNow), keeping
    its state in the shared folder between runs."""
    import datetime as dt

    from runlens.session import scratch_path
    from runlens.streaming.incremental import land_extract, run_incremental

    t = build(spark, sf_dir)
    work = scratch_path(spark, "stream")
    landing = f"{work}/landing"
    rows = t.metric_rows.drop("extraction_timestamp")
    day = F.dayofmonth("start_time")
    out = None
    for i, (lo, hi) in enumerate([(1, 12), (10, 22), (20, 31)]):
        land_extract(rows.where(day.between(lo, hi)), landing, AS_OF + dt.timedelta(minutes=5 * i))
        out = run_incremental(spark, landing, work, t.metadata, t.thresholds, AS_OF)
    return out


@query("stream_platform_hourly")
def q_stream_platform_hourly(spark, sf_dir):
    from runlens.streaming.incremental import read_hourly

    _, hourly = _drain_stream(spark, sf_dir)
    h = read_hourly(spark, hourly)
    return h.select(F.col("time_hour").alias("timestamp"), "total_runs", "critical_runs", "warning_runs",
                    "healthy_runs", round6(F.col("pass_rate")).alias("pass_rate"))


@query("stream_latest_wins")
def q_stream_latest_wins(spark, sf_dir):
    from runlens.streaming.incremental import read_current

    history, _ = _drain_stream(spark, sf_dir)
    cur = read_current(spark, history)
    return cur.select("run_id", "metric_name", round6(F.col("metric_value")).alias("metric_value"),
                      "extraction_timestamp")


@query("stream_trend")
def q_stream_trend(spark, sf_dir):
    """The pass-rate trend over the hours that the stream has stored."""
    from runlens.streaming.incremental import stored_trend

    _, hourly = _drain_stream(spark, sf_dir)
    h = stored_trend(spark, hourly)
    return h.select(F.col("time_hour").alias("timestamp"), *[round6(F.col(c)).alias(c) for c in (
        "pass_rate", "pass_rate_24h_ago", "pass_rate_trend", "pass_rate_trend_24h")])


@query("stream_series")
def q_stream_series(spark, sf_dir):
    """Moving average and forecast over the rows that the stream has stored."""
    from runlens.streaming.incremental import stored_series

    t = build(spark, sf_dir)
    history, _ = _drain_stream(spark, sf_dir)
    e = stored_series(spark, history, t.metadata, t.thresholds, AS_OF, ["run_id", "experiment_id", "metric_name", "start_time"])
    return e.select("run_id", "experiment_id", "metric_name", "start_time",
                    round6(F.col("moving_avg_24h")).alias("moving_avg_24h"),
                    round6(F.col("forecast_next")).alias("forecast_next"))


@query("stream_repair")
def q_stream_repair(spark, sf_dir):
    """Polls that saw only the runs of even users; the 30-day repair run brings in the others."""
    import datetime as dt

    from runlens.session import scratch_path
    from runlens.streaming.incremental import land_extract, read_hourly, repair, run_incremental

    t = build(spark, sf_dir)
    work = scratch_path(spark, "stream-repair")
    rows = t.metric_rows.drop("extraction_timestamp")
    user = F.regexp_extract("run_id", r"-(\d+)-", 1).cast("bigint")
    land_extract(rows.where(user % 2 == 0), f"{work}/landing", AS_OF)
    history, hourly = run_incremental(spark, f"{work}/landing", work, t.metadata, t.thresholds, AS_OF)
    repair(rows, history, hourly, t.metadata, t.thresholds, AS_OF + dt.timedelta(minutes=30), AS_OF)
    h = read_hourly(spark, hourly)
    return h.select(F.col("time_hour").alias("timestamp"), "total_runs", "critical_runs", "warning_runs",
                    "healthy_runs", round6(F.col("pass_rate")).alias("pass_rate"))


# ---------------------------------------------------------------- plain sinks and the SQL surface (SRC9, SNK2, SNK4-5)

@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf_dir):
    """Write the metric rows to a Parquet path in the shared folder and read them back."""
    from runlens.session import scratch_path
    from runlens.sinks.tables import read_parquet, write_parquet

    path = scratch_path(spark, "parquet")
    write_parquet(build(spark, sf_dir).metric_rows, path)
    back = read_parquet(spark, path)
    return back.select("run_id", "metric_name", round6(F.col("metric_value")).alias("metric_value"), "start_time",
                       F.size("params").cast("bigint").alias("param_count"))


@query("table_roundtrip")
def q_table_roundtrip(spark, sf_dir):
    """Save the classified rows as a table of the session catalog and query it by name."""
    import hashlib

    from runlens.sinks.tables import create_table, execute

    # One table per session and directory, replaced at every call.
    name = f"runlens_classified_{hashlib.md5(f'{spark.sparkContext.applicationId} {sf_dir}'.encode()).hexdigest()[:12]}"
    create_table(build(spark, sf_dir).classified, name)
    return execute(spark, f"SELECT run_id, metric_name, status FROM {name}")


HOURLY_SQL = """
WITH runs AS (
  SELECT run_id, start_time,
         CASE WHEN count_if(status = 'critical') > 0 THEN 'critical'
              WHEN count_if(status = 'warning') > 0 THEN 'warning' ELSE 'healthy' END AS run_status
  FROM enriched_metrics
  WHERE start_time <= :as_of
  GROUP BY run_id, experiment_name, user_id, start_time)
SELECT date_trunc('hour', start_time) AS timestamp,
       count(*) AS total_runs,
       count_if(run_status = 'critical') AS critical_runs,
       count_if(run_status = 'warning') AS warning_runs,
       count_if(run_status = 'healthy') AS healthy_runs,
       round(100.0D * count_if(run_status IN ('healthy', 'warning')) / count(*) + 1e-9D, 6) AS pass_rate
FROM runs
GROUP BY date_trunc('hour', start_time)
"""


@query("platform_hourly_sql")
def q_platform_hourly_sql(spark, sf_dir):
    """The hourly platform counts as Spark SQL over a registered view, with a named parameter."""
    from runlens.sinks.tables import execute, register

    register(build(spark, sf_dir).classified, "enriched_metrics")
    return execute(spark, HOURLY_SQL, {"as_of": AS_OF})


def _drain_watermarked(spark, sf_dir, order):
    """Land thirds of the time range (cut at midnight) in the given order, draining after each."""
    import datetime as dt

    from runlens.session import scratch_path
    from runlens.streaming.incremental import land_extract, run_watermarked

    t = build(spark, sf_dir)
    work = scratch_path(spark, "stream-wm")
    landing = f"{work}/landing"
    rows = t.metric_rows.drop("extraction_timestamp")
    first, last = rows.agg(F.min(F.to_date("start_time")), F.max(F.to_date("start_time"))).first()
    days = (last - first).days + 1 if first else 0
    cuts = [first + dt.timedelta(days=days * i // 3) for i in range(4)] if first else [dt.date(1970, 1, 1)] * 4
    day = F.to_date("start_time")
    out = None
    for n, i in enumerate(order):
        part = rows.where((day >= F.lit(cuts[i])) & (day < F.lit(cuts[i + 1])))
        land_extract(part, landing, AS_OF + dt.timedelta(minutes=5 * n))
        out = run_watermarked(spark, landing, work, t.metadata, t.thresholds, AS_OF)
    return landing, out


@query("stream_late_hours")
def q_stream_late_hours(spark, sf_dir):
    """The second third of the range lands first and the first third last: its hours are behind the watermark and are
    reported, with their runs, by the audit of the landed rows."""
    from runlens.streaming.incremental import late_hours

    landing, out = _drain_watermarked(spark, sf_dir, [1, 2, 0])
    t = build(spark, sf_dir)
    late = late_hours(spark, landing, out, t.metadata, t.thresholds, AS_OF)
    return late.select(F.col("time_hour").alias("timestamp"), "total_runs", "missed_runs",
                       round6(F.col("pass_rate")).alias("pass_rate"))


@query("stream_hourly_watermark")
def q_stream_hourly_watermark(spark, sf_dir):
    """Extracts land in time order (thirds of the whole range), each drained by its own
    availableNow run, so no row arrives behind the watermark; hours the watermark has
    not yet closed are not emitted."""
    landing, out = _drain_watermarked(spark, sf_dir, [0, 1, 2])
    h = spark.read.parquet(out)
    return h.select(F.col("time_hour").alias("timestamp"), "total_runs", "critical_runs", "warning_runs",
                    "healthy_runs", round6(F.col("pass_rate")).alias("pass_rate"))


@query("delta_job")
def q_delta_job(spark, sf_dir):
    """The 1-hour delta job replayed at the end of the busiest hour."""
    from runlens.plans.jobs import delta_job

    return _replayed(spark, sf_dir, delta_job)


@query("backup_job")
def q_backup_job(spark, sf_dir):
    """The 6-hour backup job replayed at the end of the busiest hour."""
    from runlens.plans.jobs import backup_job

    return _replayed(spark, sf_dir, backup_job)


def _busiest(t):
    """The end of the hour in which the most runs started (ties: the later hour)."""
    import datetime as dt

    per_hour = t.runs.groupBy(F.date_trunc("hour", "start_time").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return per_hour.agg(F.max_by("h", F.struct("n", "h"))).first()[0] + dt.timedelta(hours=1)


def _replayed(spark, sf_dir, job):
    """Run a job at the end of the hour in which the most runs
    started (a scalar read from the data; ties: the later hour); returns the enriched
    snapshot it wrote, whose moving averages and forecasts cover that extract only."""
    from runlens.session import scratch_path
    from runlens.sinks.snapshots import load_latest
    from runlens.sources import fixtures as fx

    t = build(spark, sf_dir)
    base = scratch_path(spark, "jobs")
    job(spark, t.runs, t.experiments, t.metadata, t.thresholds, base, _busiest(t))
    e = load_latest(spark, base, "enriched_metrics")
    return e.select("run_id", "metric_name", "status", round6(F.col("metric_value")).alias("metric_value"),
                    round6(F.col("moving_avg_24h")).alias("moving_avg_24h"),
                    round6(F.col("forecast_next")).alias("forecast_next"))
