"""The non-broadcast fallbacks give the same rows as the broadcast plans."""

import datetime as dt

from runlens.operators import joins
from runlens.operators.enrich import enrich
from runlens.operators.series import series_windows
from runlens.sources import fixtures as fx
from tests.helpers import T0, metric_rows


def _rows(spark):
    rows = []
    for i in range(60):
        rows.append((f"r{i:03d}", str(i % 3), ["click", "view", "error"][i % 3], float((i * 7) % 31),
                     T0 + dt.timedelta(hours=i)))
    return metric_rows(spark, rows)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_beyond_bound_is_not_broadcast(spark):
    meta = fx.metric_metadata(spark)
    small = joins.join_dimension(_rows(spark), meta.select("metric_name", "unit"), "metric_name", max_rows=100)
    large = joins.join_dimension(_rows(spark), meta.select("metric_name", "unit"), "metric_name", max_rows=1)
    assert sorted(small.collect()) == sorted(large.collect())
    assert "BroadcastHashJoin" in _plan(small)


def test_a_side_that_grew_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "dim")
    facts = spark.range(10).selectExpr("cast(id as string) as k")

    def joined():
        return joins.join_dimension(facts, spark.read.parquet(path), "k", max_rows=100)._jdf.queryExecution().analyzed().toString()

    spark.range(10).selectExpr("cast(id as string) as k", "id as v").write.parquet(path)
    assert "ResolvedHint (strategy=broadcast)" in joined() or "strategy=broadcast" in joined()
    spark.range(5000).selectExpr("cast(id as string) as k", "id as v").write.mode("overwrite").parquet(path)
    assert "strategy=broadcast" not in joined()


def test_wide_rows_are_judged_by_bytes(spark):
    wide = spark.range(10).selectExpr("cast(id as string) as k", "repeat('x', 2000) as v")
    plan = joins.join_dimension(spark.range(3).selectExpr("cast(id as string) as k"), wide, "k", max_bytes=10_000)
    assert "strategy=broadcast" not in plan._jdf.queryExecution().analyzed().toString()


def test_series_buckets_do_not_change_results(spark):
    base = enrich(_rows(spark), fx.metric_metadata(spark), fx.thresholds(spark), T0)
    cols = ["run_id", "moving_avg_24h", "forecast_next"]
    split = sorted(series_windows(base, rows_per_bucket=4).select(*cols).collect())
    assert split == sorted(series_windows(base).select(*cols).collect())
    assert all(r["moving_avg_24h"] is not None for r in split)


def test_a_large_day_is_written_by_several_tasks(spark, monkeypatch):
    import glob

    from runlens.plans import context
    from runlens.session import scratch_path

    seen = []
    monkeypatch.setattr(context, "scratch_path", lambda s, name: seen.append(scratch_path(s, name)) or seen[-1])
    df = spark.range(0, 400_000, 1, 8).selectExpr("md5(cast(id as string)) AS run_id", "TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, if(id < 1000, 1, 0)) AS start_time")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        back = context._by_day(df, "t-days")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: len(glob.glob(f"{seen[0]}/start_day={d}/*.parquet")) for d in ("2024-01-01", "2024-01-02")}
    assert files["2024-01-01"] > 3 and files["2024-01-02"] == 1
    assert back.count() == 400_000 and back.columns[:2] == df.columns
