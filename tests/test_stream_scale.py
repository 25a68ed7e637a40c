"""What the stream's steps read and write (findings F1, F2)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from runlens.operators.enrich import enrich
from runlens.operators.series import series_windows
from runlens.plans.context import build
from runlens.session import scratch_path
from runlens.sinks import commits
from runlens.sources import fixtures as fx
from runlens.streaming import incremental as inc
from runlens.streaming.state import INDEX, StreamTables
from tests.helpers import T0, metric_rows


def _fed(spark, name, **kw):
    work = scratch_path(spark, name)
    up = inc.HourlyUpdater(f"{work}/history", f"{work}/hourly", fx.metric_metadata(spark), fx.thresholds(spark), T0, **kw)
    for i in range(2):
        rows = [(f"r{j}", str(j % 2), "click", 10.0 * j + i, T0 + dt.timedelta(hours=7 * j)) for j in range(6 + 2 * i)]
        up(metric_rows(spark, rows).withColumn("extraction_timestamp", F.lit(T0 + dt.timedelta(minutes=i))), i)
    return work


def test_series_read_a_stored_copy_of_the_current_rows(spark):
    history = f"{_fed(spark, 't-series')}/history"
    meta, thr = fx.metric_metadata(spark), fx.thresholds(spark)
    want = series_windows(enrich(inc.read_current(spark, history), meta, thr, T0))
    whole = inc.stored_series(spark, history, meta, thr, T0)
    assert whole.columns == want.columns and not [f for f in whole.inputFiles() if "/history/" in f]
    cols = ["run_id", "metric_name", "start_time"]
    few = inc.stored_series(spark, history, meta, thr, T0, cols)
    cols += ["moving_avg_24h", "forecast_next"]
    assert few.columns == cols
    rows = sorted(tuple(r) for r in want.select(*cols).collect())
    assert len(rows) == 8 and rows == sorted(tuple(r) for r in whole.select(*cols).collect()) == sorted(tuple(r) for r in few.collect())


def test_a_growing_index_is_written_once_a_batch(spark):
    work = _fed(spark, "t-once", bucket_runs=1)
    tables = StreamTables(spark, work)
    assert tables.state["runs"] == 8 and tables.state["buckets"] == 16
    known = tables.read("index", INDEX)
    assert known.count() == 6 + 8 and known.select("run_id").distinct().count() == 8 and known.where(F.col("bucket") != tables.bucket()).count() == 0
    assert len([n for n in commits.children(spark, f"{work}/index") if n.startswith("commit=")]) == 2
    assert not commits.children(spark, f"{work}/_runs")         # what only the batch needed is gone


def test_an_empty_batch_leaves_nothing(spark):
    work = scratch_path(spark, "t-empty")
    up = inc.HourlyUpdater(f"{work}/history", f"{work}/hourly", fx.metric_metadata(spark), fx.thresholds(spark), T0)
    up(metric_rows(spark, []), 0)
    assert not commits.children(spark, f"{work}/history") and StreamTables(spark, work).state["number"] == 0


def test_the_classified_rows_are_written_when_asked_for(spark, tmp_path):
    events = [(T0 + dt.timedelta(hours=5 * i), i % 7, t, float(i)) for i in range(20) for t in ("click", "view")] + [(None, 3, "click", 1.0)]
    spark.createDataFrame(events, "ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    t = build(spark, str(tmp_path))
    want = fx.runs_from_events(fx.load_events(spark, str(tmp_path)))
    text = [F.to_json(F.struct(*want.columns)).alias("row")]
    assert sorted(r[0] for r in t.runs.select(*text).collect()) == sorted(r[0] for r in want.select(*text).collect())
    assert "classified" not in vars(t)
    files = t.enriched_base.inputFiles()
    assert t.enriched_base.inputFiles() == files and "classified" in os.path.dirname(files[0])
