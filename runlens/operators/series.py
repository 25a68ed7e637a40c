"""Per-series windows: row moving average, forecast, time-window moving average.

A series is (experiment_id, metric_name) ordered by (start_time, run_id); run_id
breaks ties deterministically. One series may hold a large share of all rows, so
no window here is partitioned by the series key alone over the full data:

* The row moving average (last ``window_rows`` rows) runs in (series, bucket)
  partitions. Bucket width is chosen per series from its row count and time span
  (about ``rows_per_bucket`` rows each); buckets that still hold more (bursts) are
  split once more from their own count, and what is then still too full (rows denser than the
  clock can split, up to all of them on one timestamp) is split by rank: between
  splitters, (start_time, run_id) keys of the bucket drawn evenly by a hash. Each bucket also receives the
  ``window_rows - 1`` rows that precede it ("carry"), taken from the per-bucket
  tails, so frames that cross a bucket edge are exact.
* The forecast needs only the series' last three rows and its row count: a
  map-side limited top-k plus a partial aggregate (``series_forecast``, without the buckets).
* The time-window average runs in (metric, leaf) partitions. Leaves are cells of a tree over time
  (hour, second, millisecond): a cell is divided only where it holds more than ``rows_per_bucket`` rows, so a burst is split
  and quiet stretches are not. Whole cells inside a frame are summed level by level over the cells' sums, the part
  at the frame's start from rows copied one window-length forward. Only values inside
  the frame are ever added, none is subtracted, so the tree cannot change a result.

Infinite values count as missing in the averages, as NaN does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["experiment_id", "metric_name"]
ROWS_PER_BUCKET = 1_000_000


def _finite(value: str):
    v = F.col(value)
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def _series_stats(df: DataFrame, rows_per_bucket: int) -> DataFrame:
    stats = df.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("start_time").alias("_t0"),
        F.max("start_time").alias("_t1"),
    )
    span = (F.unix_micros("_t1") - F.unix_micros("_t0") + F.lit(1)).cast("double")
    width = F.least(span, span * F.lit(float(rows_per_bucket)) / F.col("_n"))
    return stats.withColumn("_bucket_us", F.greatest(F.ceil(width), F.lit(1)).cast("bigint"))


# Splitters of a bucket: at most this many, so that looking one up stays cheap.
SPLITTERS = 256


def _rank_splitters(rows: DataFrame, rows_per_bucket: int) -> DataFrame:
    """(series, _b1, _b2, _splitters) of the buckets that still hold more than ``rows_per_bucket`` rows.

    The splitters are the sorted places of the rows whose run_id hashes to 0 modulo a quarter bucket, thinned to ``SPLITTERS``:
    the same in every evaluation of the plan, whatever the order of the tasks.
    """
    drawn = F.pmod(F.xxhash64("run_id"), F.lit(max(1, rows_per_bucket // 4))) == 0
    place = F.struct(F.col("start_time").alias("t"), F.col("run_id").alias("r"))
    found = rows.groupBy(*SERIES, "_b1", "_b2").agg(
        F.count(F.lit(1)).alias("_c2"), F.array_sort(F.collect_set(F.when(drawn, place))).alias("_drawn")).where(F.col("_c2") > rows_per_bucket)
    step = F.ceil(F.size("_drawn") / SPLITTERS)
    return found.select(*SERIES, "_b1", "_b2", F.filter("_drawn", lambda x, i: i % step == 0).alias("_splitters"))


def series_windows(enriched: DataFrame, value: str = "metric_value", window_rows: int = 5,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``moving_avg_24h`` (mean of the last ``min(n, window_rows)`` non-null values)
    and ``forecast_next`` (n >= 3: last value + mean of the last two differences, the
    same on every row of the series; else the row's own value).

    Rows with a NULL series key are dropped, as a group-by over the key would. The
    per-series tables are joined without a hint: AQE knows their size when it picks the join.
    """
    df = enriched.where(F.col("experiment_id").isNotNull() & F.col("metric_name").isNotNull())
    k = window_rows - 1
    keep = max(k, 1)
    stats = _series_stats(df, rows_per_bucket)

    b = df.join(stats, SERIES).withColumn("_off", F.unix_micros("start_time") - F.unix_micros("_t0"))
    b = b.withColumn("_b1", F.expr("_off div _bucket_us"))
    # Second level for bursts: a first-level bucket holding more than rows_per_bucket rows
    # (a partial aggregate finds them; at most n / rows_per_bucket exist) is split again
    # with a width sized from its own count. (level 1, level 2) stays monotone in time.
    hot = (
        b.groupBy(*SERIES, "_b1").agg(F.count(F.lit(1)).alias("_c1"))
        .where(F.col("_c1") > F.lit(rows_per_bucket))
        .join(stats.select(*SERIES, "_bucket_us"), SERIES)
        .select(*SERIES, "_b1", F.greatest(F.ceil(F.col("_bucket_us").cast("double") * F.lit(float(rows_per_bucket))
                                                  / F.col("_c1")), F.lit(1)).cast("bigint").alias("_sub_us"))
    )
    b = b.join(hot, [*SERIES, "_b1"], "left").withColumn(
        "_b2", F.when(F.col("_sub_us").isNull(), F.lit(0).cast("bigint")).otherwise(F.expr("(_off - _b1 * _bucket_us) div _sub_us"))
    )
    splitters = _rank_splitters(b.where(F.col("_sub_us").isNotNull()), rows_per_bucket)
    b = b.join(splitters, [*SERIES, "_b1", "_b2"], "left")
    place = F.struct(F.col("start_time").alias("t"), F.col("run_id").alias("r"))
    rank = F.when(F.col("_splitters").isNull(), F.lit(0)).otherwise(F.size(F.filter("_splitters", lambda x: x <= place)))
    b = b.withColumn("_bucket", F.struct(F.col("_b1").alias("b1"), F.col("_b2").alias("b2"), rank.alias("b3"))) \
        .drop("_off", "_b1", "_b2", "_sub_us", "_splitters")
    slim = b.select(*SERIES, "_bucket", "start_time", "run_id", F.col(value).alias("_raw"), _finite(value).alias("_v"))

    # Last `keep` rows of every (series, bucket); the limit runs map-side before the shuffle.
    w_tail = Window.partitionBy(*SERIES, "_bucket").orderBy(F.desc("start_time"), F.desc("run_id"))
    tails = slim.withColumn("_rn", F.row_number().over(w_tail)).where(F.col("_rn") <= keep)

    # Series-level pass over the tails only (at most `keep` rows per bucket).
    w_ser = Window.partitionBy(*SERIES).orderBy("start_time", "run_id")

    data = b.drop("_n", "_t0", "_t1", "_bucket_us").withColumn("_v", _finite(value)).withColumn(
        "_carry", F.lit(False)
    )
    if k > 0:
        carried = (
            tails.withColumn("_prev", F.collect_list(F.struct("start_time", "run_id", "_v"))
                             .over(w_ser.rowsBetween(-(k - 1), 0)))
            .withColumn("_next", F.lead("_bucket").over(w_ser))
            .where((F.col("_rn") == 1) & F.col("_next").isNotNull())
            .select(*SERIES, F.col("_next").alias("_bucket"), F.explode("_prev").alias("_c"))
            .select(*SERIES, "_bucket", "_c.start_time", "_c.run_id", F.col("_c._v").alias("_v"),
                    F.lit(True).alias("_carry"))
        )
        u = data.unionByName(carried, allowMissingColumns=True)
        w_main = Window.partitionBy(*SERIES, "_bucket").orderBy("start_time", "run_id").rowsBetween(-k, 0)
        out = u.withColumn("moving_avg_24h", F.avg("_v").over(w_main)).where(~F.col("_carry"))
    else:
        out = data.withColumn("moving_avg_24h", F.col("_v"))

    return _with_forecast(out.drop("_n"), df, value).select(*enriched.columns, "moving_avg_24h", "forecast_next")


def series_forecast(enriched: DataFrame, value: str = "metric_value") -> DataFrame:
    """Adds only ``forecast_next`` of ``series_windows``: two aggregates, no buckets."""
    df = enriched.where(F.col("experiment_id").isNotNull() & F.col("metric_name").isNotNull())
    return _with_forecast(df, df, value).select(*enriched.columns, "forecast_next")


def _with_forecast(out: DataFrame, df: DataFrame, value: str) -> DataFrame:
    """``out`` with the forecast of its series, from the last three rows (limited before the shuffle) and the row count of ``df``."""
    w_desc = Window.partitionBy(*SERIES).orderBy(F.desc("start_time"), F.desc("run_id"))
    last3 = (
        df.select(*SERIES, "start_time", "run_id", F.col(value).alias("_raw"))
        .withColumn("_r", F.row_number().over(w_desc)).where(F.col("_r") <= 3)
        .groupBy(*SERIES)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.max(F.when(F.col("_r") == i, F.col("_raw"))).alias(f"_v{i}") for i in (1, 2, 3)])
    )
    v1, v2, v3 = F.col("_v1"), F.col("_v2"), F.col("_v3")
    forecast = last3.select(*SERIES, F.col("_n").alias("_last"), (v1 + ((v2 - v3) + (v1 - v2)) / F.lit(2.0)).alias("_fc"))
    return out.join(forecast, SERIES, "left").withColumn(
        "forecast_next", F.when(F.col("_last") >= 3, F.col("_fc")).otherwise(F.col(value))
    )


# Widths of the tree's levels in microseconds (hour, second, millisecond).
LEVELS = [3_600_000_000, 1_000_000, 1_000]
FIRST = -(2**63)        # sorts before every time


def _cell(width: int):
    """The cell of ``_key`` at a level, exact for negative times too."""
    return F.expr(f"(_key - pmod(_key, {width}L)) div {width}L")


def moving_average_time(df: DataFrame, window_hours: int = 24, value: str = "metric_value",
                        out_col: str = "moving_avg_time", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Mean of non-null finite values with start_time in (t - window, t] per metric, over all
    experiments. Rows tied on start_time see only the peers before them in run_id
    order, as a row-by-row rolling window would.

    Each row counts in its own leaf and, moved forward by one window, in the leaf it expires in. Cells are divided by how many of both
    they hold, so both sides of a frame share one tree. For a row at t in leaf L, inside ever larger cells up to the window-long chunk:
      rows of L up to t                              (running sum in the (metric, L) partition)
    + rows that expire in L after t                  (the same, from the end)
    + per level: whole cells before L's in their parent, and what expires in whole cells after it
                                                     (running sums over the cells of one parent, at most 3600).
    """
    w_us = window_hours * LEVELS[0]
    base = df.where(F.col("metric_name").isNotNull()).withColumn("_key", F.unix_micros("start_time")).withColumn("_v", _finite(value))
    own = base.select("metric_name", "_key", F.lit(1).alias("_kind"), "_v")
    moved = base.select("metric_name", (F.col("_key") + F.lit(w_us)).alias("_key"), F.lit(0).alias("_kind"), "run_id", "_v")
    both = own.unionByName(moved.drop("run_id"))

    # Per level the cells under a divided parent with their sums, and which of them are divided in turn (at most rows / rows_per_bucket).
    full, rows, above, leaves = [], both, None, None
    for level, width in enumerate(LEVELS):
        parent = _cell(LEVELS[level - 1]) if level else _cell(w_us)
        v1, v0 = (F.when(F.col("_kind") == k, F.col("_v")) for k in (1, 0))
        cells = rows.groupBy("metric_name", parent.alias("_parent"), _cell(width).alias("_leaf")).agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_kind") == 1).alias("_own"),
            F.sum(v1).alias("_s1"), F.count(v1).alias("_c1"), F.sum(v0).alias("_s0"), F.count(v0).alias("_c0"))
        siblings = Window.partitionBy("metric_name", "_parent").orderBy("_leaf")
        before = siblings.rowsBetween(Window.unboundedPreceding, -1)
        after = siblings.rowsBetween(1, Window.unboundedFollowing)
        found = cells.select(
            "metric_name", "_parent", "_leaf", "_n", "_own",
            (F.coalesce(F.sum("_s1").over(before), F.lit(0.0)) + F.coalesce(F.sum("_s0").over(after), F.lit(0.0))).alias("_ms"),
            (F.coalesce(F.sum("_c1").over(before), F.lit(0)) + F.coalesce(F.sum("_c0").over(after), F.lit(0))).alias("_mc"))
        if above is not None:   # what the larger cells around it add
            found = found.join(above, ["metric_name", "_parent"]).select(
                "metric_name", "_leaf", "_n", "_own", (F.col("_ms") + F.col("_us")).alias("_ms"), (F.col("_mc") + F.col("_uc")).alias("_mc"))
        last = level == len(LEVELS) - 1
        divided = F.lit(False) if last else F.col("_n") > rows_per_bucket
        part = found.where(~divided & (F.col("_own") > 0)).select("metric_name", F.lit(level).alias("_level"), "_leaf", "_ms", "_mc")
        leaves = part if leaves is None else leaves.unionByName(part)
        if not last:
            above = found.where(divided).select("metric_name", F.col("_leaf").alias("_parent"), F.col("_ms").alias("_us"), F.col("_mc").alias("_uc"))
            full.append(cells.where(divided).select("metric_name", F.col("_leaf").alias("_cell")))
            rows = both.withColumn("_cell", _cell(width)).join(full[-1], ["metric_name", "_cell"]).drop("_cell")

    data = base.withColumn("_kind", F.lit(1))
    u = data.unionByName(moved, allowMissingColumns=True).withColumn("_level", F.lit(0))
    for level, hot in enumerate(full):
        u = u.withColumn("_cell", F.when(F.col("_level") == level, _cell(LEVELS[level])))
        u = u.join(hot.withColumn("_hot", F.lit(True)), ["metric_name", "_cell"], "left")
        u = u.withColumn("_level", F.when(F.col("_hot"), F.lit(level + 1)).otherwise(F.col("_level"))).drop("_cell", "_hot")
    leaf = _cell(LEVELS[-1])
    for level, width in reversed(list(enumerate(LEVELS[:-1]))):
        leaf = F.when(F.col("_level") == level, _cell(width)).otherwise(leaf)
    u = u.withColumn("_leaf", leaf)
    # The sum of the whole cells comes as the first row of its leaf.
    u = u.unionByName(leaves.withColumn("_key", F.lit(FIRST)).withColumn("_kind", F.lit(-1)), allowMissingColumns=True)
    part = Window.partitionBy("metric_name", "_level", "_leaf")
    run = part.orderBy("_key", "_kind", "run_id").rowsBetween(Window.unboundedPreceding, 0)
    rest = part.orderBy(F.desc("_key"), F.desc("_kind"), F.desc("run_id")).rowsBetween(Window.unboundedPreceding, -1)
    dv = F.when(F.col("_kind") == 1, F.col("_v"))
    ev = F.when(F.col("_kind") == 0, F.col("_v"))
    u = u.select(
        "*",
        F.sum(dv).over(run).alias("_ds"), F.count(dv).over(run).alias("_dc"),
        F.max("_ms").over(run).alias("_whole"), F.max("_mc").over(run).alias("_wholes"),
        F.sum(ev).over(rest).alias("_es"), F.count(ev).over(rest).alias("_ec"),
    ).where(F.col("_kind") == 1)
    z, none = F.lit(0.0), F.lit(0)
    s = F.coalesce(F.col("_es"), z) + F.coalesce(F.col("_whole"), z) + F.coalesce(F.col("_ds"), z)
    c = F.coalesce(F.col("_ec"), none) + F.coalesce(F.col("_wholes"), none) + F.col("_dc")
    return u.withColumn(out_col, F.when(c > 0, s / c)).select(*df.columns, out_col)
