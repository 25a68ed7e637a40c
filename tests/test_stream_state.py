"""Run index, commits and compaction of the incremental stream (ST1, ST3)."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from runlens.operators import summaries as sm
from runlens.operators.enrich import enrich
from runlens.session import scratch_path
from runlens.sinks import commits
from runlens.sources import fixtures as fx
from runlens.streaming import state
from runlens.streaming.incremental import HourlyUpdater, latest_wins, read_current, read_hourly
from tests.helpers import T0, metric_rows

DAY = dt.timedelta(days=1)


def extract(spark, rows, minute):
    return metric_rows(spark, rows).withColumn("extraction_timestamp", F.lit(T0 + dt.timedelta(minutes=minute)))


def updater(spark, work, **kw):
    return HourlyUpdater(f"{work}/history", f"{work}/hourly", fx.metric_metadata(spark), fx.thresholds(spark), T0, **kw)


def hours(spark, work):
    return {r["time_hour"]: r["total_runs"] for r in read_hourly(spark, f"{work}/hourly").collect()}


def days_read(paths, table="history"):
    return {p.rsplit("=", 1)[1] for p in paths if f"/{table}/" in p}


def test_a_batch_reads_its_own_days_and_buckets_only(spark):
    work = scratch_path(spark, "t-index")
    up = updater(spark, work, bucket_runs=4)
    for i in range(6):
        up(extract(spark, [(f"r{i}-{j}", "0", "click", 30.0, T0 + i * DAY) for j in range(4)], i), i)
    buckets = state.StreamTables(spark, work).state["buckets"]
    assert buckets >= 16
    up(extract(spark, [("new", "0", "click", 30.0, T0 + 2 * DAY)], 10), 6)
    assert days_read(up.read_paths) == {"2024-01-03"} and len(days_read(up.read_paths, "index")) <= 1
    # A run that moves: its old day is read as well, and nothing else.
    up(extract(spark, [("r0-1", "0", "click", 30.0, T0 + 4 * DAY)], 11), 7)
    assert days_read(up.read_paths) == {"2024-01-01", "2024-01-05"} and len(days_read(up.read_paths, "index")) == 1
    want = {T0 + i * DAY: 4 for i in range(6)}
    assert hours(spark, work) == {**want, T0: 3, T0 + 2 * DAY: 5, T0 + 4 * DAY: 5}


def test_replayed_and_failed_batches(spark, monkeypatch):
    work = scratch_path(spark, "t-replay")
    up = updater(spark, work)
    up(extract(spark, [("r1", "0", "click", 30.0, T0), ("r2", "0", "click", 30.0, T0)], 1), 0)
    moved = extract(spark, [("r1", "0", "click", 30.0, T0 + DAY)], 2)
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            up(moved, 1)
    assert hours(spark, work) == {T0: 2}                         # all of the batch or nothing
    up(moved, 1)
    up(moved, 1)                                                 # replayed after its commit
    assert hours(spark, work) == {T0: 1, T0 + DAY: 1}
    tables = state.StreamTables(spark, work)
    assert tables.state["number"] == 2 and tables.sweep() == []
    assert len(tables.sweep(dt.timedelta(0))) == 3               # the dead batch's history, hours and index
    assert hours(spark, work) == {T0: 1, T0 + DAY: 1}


def test_a_writer_that_comes_second_fails_whole(spark):
    work = scratch_path(spark, "t-second")
    updater(spark, work)(extract(spark, [("r1", "0", "click", 30.0, T0)], 1), 0)
    stale = state.StreamTables(spark, work)
    updater(spark, work)(extract(spark, [("r2", "0", "click", 30.0, T0)], 2), 1)
    with pytest.raises(commits.CommitConflict):
        stale.commit(1, {"hourly": {}})
    assert hours(spark, work) == {T0: 2}


def test_random_batches_equal_the_whole_recompute(spark, monkeypatch):
    """Moves, revisions, late extracts, compaction of days and buckets, growth of the index."""
    monkeypatch.setattr(state, "MAX_FOLDERS", 2)
    monkeypatch.setattr("runlens.streaming.incremental.MAX_FOLDERS", 2)
    rng, work, landed = random.Random(3), scratch_path(spark, "t-random"), []
    up = updater(spark, work, bucket_runs=3)
    for i in range(9):
        minute = i if i % 4 else rng.randrange(20)
        by_run = {f"r{rng.randrange(12)}": T0 + rng.randrange(4) * DAY + dt.timedelta(hours=rng.randrange(3)) for _ in range(5)}
        rows = [(r, "0", m, float(rng.choice([5, 30])), s) for r, s in by_run.items() for m in ("click", "view")]
        batch = extract(spark, rows, minute)
        landed.append(batch)
        up(batch, i)
    rows = landed[0]
    for more in landed[1:]:
        rows = rows.unionByName(more)
    # The newest extract of a run is where it stands; rows of other days do not count.
    seen = defaultdict(lambda: (dt.datetime.min, dt.datetime.min))
    for r in rows.collect():
        seen[r["run_id"]] = max(seen[r["run_id"]], (r["extraction_timestamp"], r["start_time"]))
    home = spark.createDataFrame([(k, v[1].strftime("%Y-%m-%d")) for k, v in seen.items()], "run_id string, home string")
    own = rows.join(home, "run_id").where(F.date_format("start_time", "yyyy-MM-dd") == F.col("home")).drop("home")
    want = latest_wins(own.select(*rows.columns))
    key = ("run_id", "metric_name", "start_time", "metric_value", "extraction_timestamp")
    assert sorted(tuple(r) for r in read_current(spark, f"{work}/history").select(*key).collect()) == sorted(tuple(r) for r in want.select(*key).collect())
    hourly = sm.platform_hourly(sm.run_status(enrich(want, fx.metric_metadata(spark), fx.thresholds(spark), T0)))
    cols = ("time_hour", "total_runs", "critical_runs", "pass_rate")
    assert sorted(tuple(r) for r in read_hourly(spark, f"{work}/hourly").select(*cols).collect()) == sorted(tuple(r) for r in hourly.select(*cols).collect())
    tables = state.StreamTables(spark, work)
    assert tables.state["buckets"] > 1 and max(map(len, tables.state["history"].values())) <= 2
    known = {r["run_id"]: r["newest"]["day_key"] for r in tables.read("index", state.INDEX).groupBy("run_id").agg(F.max("newest").alias("newest")).collect()}
    assert known == {r["run_id"]: r["home"] for r in home.collect()}
