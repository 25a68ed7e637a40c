"""Series windows: row moving average, forecast, time-window average (WIN2-4)."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from runlens.operators.series import moving_average_time, series_windows
from tests.helpers import T0, col_values, hours, metric_rows


def _series(spark, values, exp="0", metric="click", start=T0):
    rows = [(f"r{i:03d}", exp, metric, v, t) for i, (v, t) in enumerate(zip(values, hours(len(values), start)))]
    return metric_rows(spark, rows)


@pytest.mark.parametrize("values,avgs,forecast", [
    ([1], [1.0], [1.0]),
    ([1, 3], [1.0, 2.0], [1.0, 3.0]),
    ([1, 3, 4], [1.0, 2.0, 8 / 3], [5.5] * 3),
    ([1, 2, 3, 4, 5, 6], [1.0, 1.5, 2.0, 2.5, 3.0, 4.0], [7.0] * 6),
])
def test_short_series(spark, values, avgs, forecast):
    out = series_windows(_series(spark, values))
    assert col_values(out, "moving_avg_24h") == pytest.approx(avgs)
    assert col_values(out, "forecast_next") == pytest.approx(forecast)


def test_missing_values_skipped(spark):
    out = series_windows(_series(spark, [1.0, None, 3.0]))
    assert col_values(out, "moving_avg_24h") == pytest.approx([1.0, 1.0, 2.0])


@pytest.mark.parametrize("rows_per_bucket", [1, 2, 3, 7])
def test_bucketed_windows_equal_plain_window(spark, rows_per_bucket):
    """Bucket edges with carried rows give exactly the plain per-series window."""
    rnd = random.Random(rows_per_bucket)
    rows = []
    for s in range(4):
        t = T0
        for i in range(rnd.randint(1, 40)):
            t += dt.timedelta(minutes=rnd.choice([1, 5, 60, 600]))
            v = None if rnd.random() < 0.1 else round(rnd.uniform(0, 100), 2)
            rows.append((f"r{s}-{i:03d}", str(s % 2), ["click", "view"][s // 2], v, t))
    df = metric_rows(spark, rows)
    got = series_windows(df, rows_per_bucket=rows_per_bucket)
    w = Window.partitionBy("experiment_id", "metric_name").orderBy("start_time", "run_id")
    want = df.withColumn("want", F.avg("metric_value").over(w.rowsBetween(-4, 0)))
    g = {r["run_id"]: (r["moving_avg_24h"], r["forecast_next"]) for r in got.collect()}
    assert len(g) == len(rows)
    for r in want.collect():
        assert g[r["run_id"]][0] == pytest.approx(r["want"], nan_ok=True) if r["want"] is not None \
            else g[r["run_id"]][0] is None
    # forecast against pandas on each series
    pdf = pd.DataFrame(rows, columns=["run_id", "exp", "metric", "v", "t"]).sort_values(["t", "run_id"])
    for (_, _), grp in pdf.groupby(["exp", "metric"]):
        vals = grp["v"].tolist()
        for rid, v in zip(grp["run_id"], vals):
            fc = g[rid][1]
            if len(vals) >= 3:
                v1, v2, v3 = vals[-1], vals[-2], vals[-3]
                exp = None if None in (v1, v2, v3) or any(pd.isna([v1, v2, v3])) else v1 + ((v2 - v3) + (v1 - v2)) / 2
            else:
                exp = None if pd.isna(v) else v
            assert (fc is None and exp is None) or fc == pytest.approx(exp)


def _brute_time_avg(rows, hours_window=24):
    """Rows in (t - window, t], preceding peers only on ties (run_id order)."""
    out = {}
    ordered = sorted(rows, key=lambda r: (r[2], r[4], r[0]))
    for i, r in enumerate(ordered):
        vals = [x[3] for x in ordered[: i + 1]
                if x[2] == r[2] and x[4] > r[4] - dt.timedelta(hours=hours_window) and x[3] is not None]
        out[r[0]] = sum(vals) / len(vals) if vals else None
    return out


@pytest.mark.parametrize("rows_per_bucket", [1, 3, 40, 10**6])
def test_time_window_average_brute_force(spark, rows_per_bucket):
    rnd = random.Random(7)
    rows, t = [], T0
    for i in range(300):
        t += dt.timedelta(minutes=rnd.choice([0, 7, 45, 180, 1440]))   # ties, gaps, exact 24 h steps
        v = None if rnd.random() < 0.05 else round(rnd.uniform(0, 50), 2)
        rows.append((f"r{i:04d}", str(i % 3), rnd.choice(["click", "view"]), v, t))
    got = moving_average_time(metric_rows(spark, rows), rows_per_bucket=rows_per_bucket).collect()
    assert len(got) == len(rows)
    want = _brute_time_avg(rows)
    for r in got:
        w = want[r["run_id"]]
        assert (r["moving_avg_time"] is None and w is None) or r["moving_avg_time"] == pytest.approx(w)


@pytest.mark.parametrize("rows_per_bucket", [1, 2, 5, 7, 10**6])
def test_time_window_average_keeps_precision(spark, rows_per_bucket):
    """One huge value, an infinity, ties and a burst: values outside a frame leave no trace in it."""
    rows = [(f"a{i:03d}", "0", "click", 1.0, T0 + dt.timedelta(hours=3 * i)) for i in range(40)]
    rows[4] = (*rows[4][:3], 1e17, rows[4][4])
    rows[20] = (*rows[20][:3], float("inf"), rows[20][4])
    rows += [(f"b{i:03d}", "1", "click", 1.0, T0 + dt.timedelta(days=4, seconds=i // 2)) for i in range(30)]
    got = {r["run_id"]: r["moving_avg_time"] for r in
           moving_average_time(metric_rows(spark, rows), rows_per_bucket=rows_per_bucket).collect()}
    finite = [(*r[:3], None if r[3] == float("inf") else r[3], r[4]) for r in rows]
    want = _brute_time_avg(finite)
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
    assert got["a015"] == 1.0 and got["a030"] == 1.0


def test_time_window_open_lower_bound(spark):
    rows = [("r1", "0", "click", 1.0, T0), ("r2", "0", "click", 2.0, T0 + dt.timedelta(days=1))]
    got = {r["run_id"]: r["moving_avg_time"] for r in moving_average_time(metric_rows(spark, rows)).collect()}
    assert got == {"r1": 1.0, "r2": 2.0}


def test_burst_split_equals_plain_window(spark):
    """A burst (most rows within five hours of a 20-day series) falls into one first-level
    bucket and is split into about five second-level buckets."""
    rows = [(f"r{i:04d}", "0", "click", float(i % 17), T0 + dt.timedelta(days=i)) for i in range(20)]
    rows += [(f"b{i:04d}", "0", "click", float(i % 13), T0 + dt.timedelta(days=5, seconds=i * 90))
             for i in range(200)]
    df = metric_rows(spark, rows)
    got = series_windows(df, rows_per_bucket=10)
    w = Window.partitionBy("experiment_id", "metric_name").orderBy("start_time", "run_id")
    want = {r["run_id"]: r["m"] for r in df.withColumn("m", F.avg("metric_value").over(w.rowsBetween(-4, 0))).collect()}
    g = {r["run_id"]: r["moving_avg_24h"] for r in got.collect()}
    assert len(g) == len(rows)
    assert all(g[k] == pytest.approx(v) for k, v in want.items())


@pytest.mark.parametrize("rows_per_bucket", [4, 50])
def test_rows_on_one_timestamp_are_split_by_rank(spark, rows_per_bucket):
    """Half of a series on one timestamp, among earlier and later rows and another series."""
    rnd = random.Random(rows_per_bucket)
    rows = [(f"r-{rnd.randrange(10**6):06d}", "0", "click", float(i % 97), T0 + dt.timedelta(hours=5)) for i in range(300)]
    rows += [(f"s-{i}", "0", "click", float(i), T0 + dt.timedelta(minutes=i * 7)) for i in range(120)]
    rows += [(f"t-{i}", "1", "click", float(i), T0) for i in range(40)]
    df = metric_rows(spark, rows).dropDuplicates(["run_id"])
    got = {r["run_id"]: r["moving_avg_24h"] for r in series_windows(df, rows_per_bucket=rows_per_bucket).collect()}
    w = Window.partitionBy("experiment_id", "metric_name").orderBy("start_time", "run_id").rowsBetween(-4, 0)
    want = {r["run_id"]: r["want"] for r in df.withColumn("want", F.avg("metric_value").over(w)).collect()}
    assert got == pytest.approx(want) and len(got) == df.count()


def test_a_million_ties_run_in_many_tasks(spark):
    """One series, one timestamp: the plan's window partitions hold a bounded share each."""
    from runlens.operators import series

    n = 1_000_000
    df = spark.range(n).selectExpr("concat('run-', md5(cast(id as string))) AS run_id", "'0' AS experiment_id", "'m' AS metric_name",
                                   "TIMESTAMP '2024-01-01 00:00:00' AS start_time", "cast(id % 1000 as double) AS metric_value")
    out = series_windows(df, rows_per_bucket=20_000)
    marked = df.selectExpr("*", "bigint(0) AS _b1", "bigint(0) AS _b2")
    blocks = series._rank_splitters(marked, 20_000).first()["_splitters"]
    assert 100 < len(blocks) <= series.SPLITTERS
    per_block = marked.select(F.size(F.filter(F.array(*[F.lit(b["r"]) for b in blocks]), lambda x: x <= F.col("run_id"))).alias("b")).groupBy("b").count()
    assert per_block.agg(F.max("count")).first()[0] < n / 25
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = out.where("moving_avg_24h >= 0").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 4 and max(r["count"] for r in per_task) < n / 2
    w = Window.orderBy("start_time", "run_id").rowsBetween(-4, 0)
    want = df.select("run_id", F.avg("metric_value").over(w).alias("want"))
    assert out.join(want, "run_id").where(F.abs(F.col("want") - F.col("moving_avg_24h")) > 1e-9).count() == 0 and out.count() == n


@pytest.mark.parametrize("rows_per_bucket", [5, 60])
def test_one_second_burst_is_split(spark, rows_per_bucket):
    """A third of the rows within one second, its echo a day later, and quiet stretches around them."""
    rnd = random.Random(rows_per_bucket)
    burst = T0 + dt.timedelta(days=2, hours=7, seconds=30)
    rows = [(f"b{i:03d}", "0", "click", float(rnd.randrange(50)), burst + dt.timedelta(microseconds=rnd.randrange(10**6))) for i in range(200)]
    rows += [(f"q{i:03d}", "1", "click", float(rnd.randrange(50)), T0 + dt.timedelta(minutes=23 * i)) for i in range(300)]
    rows += [(f"e{i:03d}", "1", "click", float(i), burst + dt.timedelta(days=1, microseconds=rnd.randrange(-10**6, 2 * 10**6))) for i in range(40)]
    rows += [(f"v{i:03d}", "1", "view", float(i), dt.datetime(1969, 12, 31, 23, 0) + dt.timedelta(minutes=7 * i)) for i in range(30)]
    out = moving_average_time(metric_rows(spark, rows), rows_per_bucket=rows_per_bucket)
    got = {r["run_id"]: r["moving_avg_time"] for r in out.collect()}
    assert got == pytest.approx(_brute_time_avg(rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = out.where("run_id like 'b%' AND moving_avg_time >= 0").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 1
