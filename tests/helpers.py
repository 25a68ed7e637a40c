"""Hand-written metric rows for edge-case tests."""

import datetime as dt

from pyspark.sql import functions as F

from runlens import schemas as S

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def metric_rows(spark, rows):
    """rows: (run_id, experiment_id, metric_name, value, start_time[, params])."""
    out = []
    for r in rows:
        run_id, exp, metric, value, start = r[:5]
        params = r[5] if len(r) > 5 else {"model": "m"}
        out.append((run_id, exp, f"app-{exp}", "u1", run_id[:8], start, None, "FINISHED", metric,
                    None if value is None else float(value), params, {}, T0))
    return spark.createDataFrame(out, S.METRIC_ROW)


def hours(n, start=T0):
    return [start + dt.timedelta(hours=i) for i in range(n)]


def col_values(df, col, order="start_time"):
    return [r[col] for r in df.orderBy(order, "run_id").collect()]


__all__ = ["F", "T0", "col_values", "hours", "metric_rows"]
