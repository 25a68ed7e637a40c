"""Incremental monitoring over landed run extracts.

Polling with an overlapping lookback reads each run many times; every extract is
whole, so the newest copy of a (run_id, metric_name) wins - not the first one.
Each micro-batch appends its rows to a history table by day, then
recomputes only the days it touched from the latest-wins view of those days.
After the stream drains, the hourly table equals the batch platform_hourly of the same rows.

A run whose start moves to another day leaves a ``moved`` row in the day it is no longer in, so
every day can be recomputed by itself and no run counts twice. On which day a run stands is looked up in the run index
(see ``state``), so a batch reads its own days and its runs' index buckets, never the rest of the history. History rows,
recomputed days and index rows of a batch become visible together. Repair runs (``repair``) send the rows of
a longer lookback through the same handler.

Windows over rows (lag, moving average) are not allowed on a stream; ``stored_trend`` and
``stored_series`` compute them over the stored tables, so they cover all history, not one extract.
"""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schemas as S
from runlens.operators import summaries as sm
from runlens.operators.enrich import enrich
from runlens.operators.series import SERIES, series_windows
from runlens.session import scratch_path
from runlens.sinks.commits import fresh_id
from runlens.sinks.tables import read_parquet, write_parquet
from runlens.streaming.state import BUCKET_RUNS, MAX_FOLDERS, StreamTables, added, index_change


def latest_wins(rows: DataFrame) -> DataFrame:
    """Newest extraction per (run_id, metric_name); of equal ones the later start, then the larger value.

    Rows marked ``moved`` (if there is such a column) stand behind the run's own rows and are not returned.
    """
    newest = _newest(rows)
    return newest.where(~F.col("moved")).drop("moved") if "moved" in rows.columns else newest


def _newest(rows: DataFrame) -> DataFrame:
    moved = [F.col("moved")] if "moved" in rows.columns else []
    w = Window.partitionBy("run_id", "metric_name").orderBy(
        F.desc("extraction_timestamp"), F.desc("start_time"), *moved, F.desc("metric_value"))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def land_extract(rows: DataFrame, landing: str, extracted_at: dt.datetime) -> None:
    """Write one extract (metric rows stamped with their extraction time) as files."""
    rows.withColumn("extraction_timestamp", F.lit(extracted_at)).write.mode("append").parquet(landing)


def _day(start) -> F.Column:
    return F.coalesce(F.date_format(start, "yyyy-MM-dd"), F.lit("none"))


class HourlyUpdater:
    """foreachBatch handler: history append, run index, touched-day recompute, one commit."""

    def __init__(self, history: str, hourly: str, metadata: DataFrame, thresholds: DataFrame,
                 as_of: dt.datetime | None = None, bucket_runs: int = BUCKET_RUNS) -> None:
        self.history, self.hourly = history, hourly
        self.metadata, self.thresholds, self.as_of = metadata, thresholds, as_of
        self.bucket_runs = bucket_runs
        self.read_paths: list[str] = []     # what the last batch read of the stored tables

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        tables = StreamTables.beside(batch.sparkSession, self.history)
        if 0 <= batch_id <= tables.state["batch"]:
            return      # committed before a restart
        commit = fresh_id()
        rows = batch.withColumn("moved", F.lit(False)).withColumn("day_key", _day("start_time"))
        # The rows are written before anything else is asked of them; the steps below read the columns they need from these files.
        own = tables.with_changes({"history": added({}, tables.write(rows, "history", commit), commit)})
        if own.state["history"]:
            with tables.kept("runs", self._whereabouts(tables, own.read("history", rows.schema)), commit) as runs:
                # One row per calendar day that the batch's runs are in or were in.
                days = {r["day"]: r["left"] for r in runs.select(F.explode("days").alias("day"), "newest").groupBy("day").agg(
                    F.max(F.col("day") != F.col("newest.day_key")).alias("left")).collect()}
                self._store(tables, own, rows.schema, runs, days, commit, batch_id)
        else:
            tables.drop("history", commit)
        self.read_paths = tables.read_paths

    def _whereabouts(self, tables: StreamTables, stamped: DataFrame) -> DataFrame:
        """Per run of the batch: ``newest`` (extraction, start, day), all ``days`` it has rows in, whether it is new to the index."""
        seen = stamped.groupBy("run_id").agg(
            F.max(F.struct("extraction_timestamp", "start_time", "day_key")).alias("seen"), F.collect_set("day_key").alias("days"))
        known = tables.whereabouts(stamped).select("run_id", F.col("newest").alias("known"))
        newest = F.greatest("seen", "known")
        return seen.join(known, "run_id", "left").select(
            "run_id", newest.alias("newest"), F.col("known").isNull().alias("fresh"), (~newest.eqNullSafe(F.col("known"))).alias("changed"),
            F.when(F.col("known").isNull(), F.col("days")).otherwise(F.array_union("days", F.array("known.day_key"))).alias("days"))

    def _store(self, tables: StreamTables, own: StreamTables, schema: T.StructType, runs: DataFrame, days: dict[str, bool],
               commit: str, batch_id: int) -> None:
        written, left = list(own.state["history"]), sorted(d for d, any_left in days.items() if any_left)
        if left:
            gone = runs.select("run_id", "newest", F.explode("days").alias("day_key")).where(F.col("day_key") != F.col("newest.day_key"))
            old = tables.read("history", schema, left).where("not moved").select(*schema.names).unionByName(own.read("history", schema, left))
            marks = (old.join(gone, ["run_id", "day_key"]).withColumn("start_time", F.col("newest.start_time"))
                     .withColumn("extraction_timestamp", F.col("newest.extraction_timestamp")).withColumn("moved", F.lit(True))
                     .select(*schema.names).dropDuplicates(["run_id", "metric_name", "day_key"]))
            written = tables.write(marks, "history", commit)
        history = added(tables.state["history"], written, commit)
        after = tables.with_changes({"history": history})
        full = [d for d in sorted(days) if len(history.get(d, [])) > MAX_FOLDERS]
        if full:    # a day of many small parts becomes one, of the rows that can still count
            merged = fresh_id()
            after.write(_newest(after.read("history", schema, full)).select(*schema.names), "history", merged)
            history = {**history, **{d: [merged] for d in full}}
            after = tables.with_changes({"history": history})
        current = latest_wins(after.read("history", schema, sorted(days)))
        enriched = enrich(current.drop("day_key"), self.metadata, self.thresholds, self.as_of)
        hourly = sm.platform_hourly(sm.run_status(enriched)).withColumn("day_key", _day("time_hour"))
        shown = tables.write(hourly, "hourly", commit)
        hours = {d: c for d, c in tables.state["hourly"].items() if d not in days}      # a day that lost its last run is in no commit
        change = {"history": history, "hourly": {**hours, **{d: commit for d in shown}},
                  "schemas": {"history": schema.json(), "hourly": hourly.schema.json()}}
        change |= index_change(tables, runs, commit, self.bucket_runs)
        tables.commit(batch_id, change)


def run_incremental(spark: SparkSession, landing: str, work: str, metadata: DataFrame,
                    thresholds: DataFrame, as_of: dt.datetime | None = None,
                    max_files_per_trigger: int | None = None) -> tuple[str, str]:
    """Drain the landing folder with an availableNow trigger; returns (history, hourly) paths."""
    schema = S.METRIC_ROW
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing)
    history, hourly = f"{work}/history", f"{work}/hourly"
    q = (
        stream.writeStream.foreachBatch(HourlyUpdater(history, hourly, metadata, thresholds, as_of))
        .option("checkpointLocation", f"{work}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return history, hourly


def repair(rows: DataFrame, history: str, hourly: str, metadata: DataFrame, thresholds: DataFrame,
           extracted_at: dt.datetime, as_of: dt.datetime | None = None) -> None:
    """Send the metric rows of a longer lookback (the 6-hour or 30-day run) through the stream's tables.

    Runs the polls missed come in, revised ones are replaced, and only the days of ``rows`` are recomputed.
    Of a repair and a batch that commit at the same time one fails with ``CommitConflict`` and is run again.
    """
    stamped = rows.withColumn("extraction_timestamp", F.lit(extracted_at)).select(*[f.name for f in S.METRIC_ROW.fields])
    HourlyUpdater(history, hourly, metadata, thresholds, as_of)(stamped, -1)


def _stored(spark: SparkSession, path: str, table: str) -> DataFrame:
    tables = StreamTables.beside(spark, path)
    if table not in tables.state["schemas"]:
        raise FileNotFoundError(f"the stream has committed no batch beside {path}")
    return tables.read(table, T.StructType.fromJson(json.loads(tables.state["schemas"][table]))).drop("day_key")


def read_hourly(spark: SparkSession, hourly: str) -> DataFrame:
    return _stored(spark, hourly, "hourly")


def read_current(spark: SparkSession, history: str) -> DataFrame:
    return latest_wins(_stored(spark, history, "history"))


def stored_trend(spark: SparkSession, hourly: str) -> DataFrame:
    """The hourly table with its pass-rate trend over all stored hours."""
    return sm.pass_rate_lag(read_hourly(spark, hourly))


def stored_series(spark: SparkSession, history: str, metadata: DataFrame, thresholds: DataFrame,
                  as_of: dt.datetime | None = None, columns: list[str] | None = None) -> DataFrame:
    """Current rows with the moving average and forecast of their whole stored series.

    ``columns`` of the enriched rows are kept (all by default). The current rows are written to the shared folder once, with those
    columns and the ones the windows need, because the windows read them several times.
    """
    current = enrich(read_current(spark, history), metadata, thresholds, as_of)
    columns = columns or current.columns
    path = scratch_path(spark, "stream-series")
    write_parquet(current.select(*dict.fromkeys([*columns, *SERIES, "start_time", "run_id", "metric_value"])), path)
    return series_windows(read_parquet(spark, path)).select(*columns, "moving_avg_24h", "forecast_next")


def watermarked_hourly(classified_stream: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Hourly platform counts as native streaming state (append mode).

    Two chained window aggregations: per (hour, run) the metric statuses, then per
    hour the runs by worst status. An hour is emitted once the watermark (newest
    start_time minus ``watermark``) passes its end; rows that come later than that are not in it
    (``run_watermarked`` writes them out). Use when extracts never revise a run (otherwise ``HourlyUpdater``).
    """
    per_run = (
        classified_stream.withWatermark("start_time", watermark)
        .groupBy(F.window("start_time", "1 hour").alias("w"), "run_id")
        .agg(F.count_if(F.col("status") == "critical").alias("_c"),
             F.count_if(F.col("status") == "warning").alias("_w"))
    )
    status = sm.run_status_of(F.col("_c"), F.col("_w")).alias("run_status")
    return (
        per_run.select(F.window_time("w").alias("_t"), status)
        .groupBy(F.window("_t", "1 hour").alias("h"))
        .agg(*sm.hourly_counts())
        .select(F.col("h.start").alias("time_hour"), "total_runs", "critical_runs", "warning_runs",
                "healthy_runs", "pass_rate")
    )


def run_watermarked(spark: SparkSession, landing: str, work: str, metadata: DataFrame,
                    thresholds: DataFrame, as_of: dt.datetime | None = None,
                    watermark: str = "1 hour") -> str:
    """Drain the landing folder into the emitted-hours table; returns its path.

    Landed rows of emitted hours that the state did not take are found by comparison: see ``late_hours``.
    """
    stream = spark.readStream.schema(S.METRIC_ROW).parquet(landing)
    classified = enrich(stream, metadata, thresholds, as_of)
    out = f"{work}/hourly_watermarked"
    q = (
        watermarked_hourly(classified, watermark).writeStream.outputMode("append")
        .format("parquet").option("path", out)
        .option("checkpointLocation", f"{work}/_checkpoint_watermarked")
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return out


def late_hours(spark: SparkSession, landing: str, emitted: str, metadata: DataFrame, thresholds: DataFrame,
               as_of: dt.datetime | None = None) -> DataFrame:
    """Hours behind the watermark whose landed runs are not all in the emitted table, with their true counts.

    (time_hour, total_runs, critical_runs, warning_runs, healthy_runs, pass_rate, missed_runs): what came behind
    the watermark, counted, so that no row is lost silently, whether its hour was emitted or not; an audit reads all
    landed rows once. The watermark is that of the newest batch in the stream's checkpoint.
    """
    landed = sm.platform_hourly(sm.run_status(enrich(latest_wins(spark.read.schema(S.METRIC_ROW).parquet(landing)),
                                                     metadata, thresholds, as_of))).drop("active_applications")
    got = spark.read.parquet(emitted)
    batches = spark.read.text(f"{os.path.dirname(emitted.rstrip('/'))}/_checkpoint_watermarked/offsets")
    stamp = F.regexp_extract("value", r'"batchWatermarkMs":(-?\d+)', 1).try_cast("long")
    watermark = F.timestamp_millis(F.lit(batches.agg(F.max(stamp)).first()[0] or 0))
    found = got.groupBy("time_hour").agg(F.sum("total_runs").alias("_n"))
    missed = (F.col("total_runs") - F.coalesce("_n", F.lit(0))).alias("missed_runs")
    return (landed.where(F.col("time_hour") + F.expr("INTERVAL 1 HOUR") <= watermark).join(found, "time_hour", "left")
            .select(*landed.columns, missed).where("missed_runs > 0"))
