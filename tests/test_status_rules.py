"""Health status, threshold resolution and dimension joins (CLS1-2, JN2-3, FLT3)."""

import math

from runlens.operators.enrich import enrich
from runlens.sources import fixtures as fx
from tests.helpers import T0, metric_rows

CASES = [
    # run, experiment, metric, value, expected status, expected source
    ("r-eqcrit", "0", "click", 8.0, "warning", "platform"),
    ("r-eqwarn", "0", "click", 20.0, "healthy", "platform"),
    ("r-below", "0", "click", 7.99, "critical", "platform"),
    ("r-override", "1", "click", 25.0, "critical", "experiment"),
    ("r-lowatwarn", "1", "error", 90.0, "healthy", "experiment"),
    ("r-lowatcrit", "1", "error", 150.0, "warning", "experiment"),
    ("r-lowabove", "1", "error", 150.01, "critical", "experiment"),
    ("r-nan-click", "0", "click", math.nan, "healthy", "platform"),
    ("r-nan-error", "1", "error", math.nan, "healthy", "experiment"),
]
DROPPED = [
    ("r-nothr", "0", "error", 1.0),      # no threshold for (error, 0) and no platform default
    ("r-nometa", "0", "signup", 1.0),    # no metadata
]


def test_status_cases(spark):
    rows = [(r, e, m, v, T0) for (r, e, m, v, _, _) in CASES] + [(r, e, m, v, T0) for (r, e, m, v) in DROPPED]
    out = enrich(metric_rows(spark, rows), fx.metric_metadata(spark), fx.thresholds(spark), T0)
    got = {r["run_id"]: (r["status"], r["threshold_source"], r["metric_value"]) for r in out.collect()}
    assert set(got) == {c[0] for c in CASES}
    for run, _, _, value, status, source in CASES:
        assert got[run][0] == status, run
        assert got[run][1] == source, run
        if math.isnan(value):
            assert got[run][2] is None


def test_override_takes_whole_row(spark):
    out = enrich(metric_rows(spark, [("r1", "1", "click", 25.0, T0)]), fx.metric_metadata(spark),
                 fx.thresholds(spark), T0).collect()[0]
    assert (out["critical_threshold"], out["warning_threshold"]) == (30.0, 60.0)


def test_run_state_kept(spark):
    out = enrich(metric_rows(spark, [("r1", "0", "click", 25.0, T0)]), fx.metric_metadata(spark),
                 fx.thresholds(spark), T0).collect()[0]
    assert out["run_state"] == "FINISHED" and out["status"] == "healthy"
