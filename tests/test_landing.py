"""Landed run files and their catalogue (SRC1)."""

import datetime as dt

import pytest

from runlens import schemas as S
from runlens.session import scratch_path
from runlens.sinks import commits
from runlens.sources import fixtures as fx
from runlens.sources.landing import files_between, land_runs, newest_landing, read_runs, scan_landed, zones
from runlens.sources.runs import scan_runs
from tests.helpers import T0

DAY = dt.timedelta(days=1)


def runs(spark, days):
    return spark.createDataFrame([(f"r{d}-{i}", str(i % 3), None if d is None else T0 + d * DAY + dt.timedelta(hours=i), None, "FINISHED", {"click": 1.0}, {}, {})
                                  for d in days for i in range(6)], S.RUNS)


def test_scan_opens_only_files_of_its_window(spark):
    folder = scratch_path(spark, "t-landing")
    for days in ((0, 1, 2), (3, 4), (5,), (None,)):
        land_runs(runs(spark, days), folder)
    every = files_between(spark, folder)
    some = files_between(spark, folder, T0 + 3 * DAY, T0 + 4 * DAY)
    assert 0 < len(some) < len(every) and zones(spark, folder).agg({"rows": "sum"}).first()[0] == 42
    as_of = T0 + 5 * DAY
    got = scan_landed(spark, folder, fx.experiments(spark), as_of, 30)
    want = scan_runs(runs(spark, range(6)), fx.experiments(spark), as_of, "30 HOURS")
    assert sorted(r["run_id"] for r in got.collect()) == sorted(r["run_id"] for r in want.collect())
    zone = {r["path"]: (r["first_start"], r["last_start"]) for r in zones(spark, folder).collect()}
    opened = {f.split("file://")[-1].replace("file:", "") for f in got.inputFiles()}
    for path, (first, last) in zone.items():
        meets = last is not None and last > as_of - dt.timedelta(hours=30) and first <= as_of
        assert (path.split("file://")[-1].replace("file:", "") in opened) == meets


def test_only_new_landings_are_read_again(spark):
    folder = scratch_path(spark, "t-landing")
    assert newest_landing(spark, folder) == 0 and read_runs(spark, folder).count() == 0
    land_runs(runs(spark, (0,)), folder)
    seen = newest_landing(spark, folder)
    assert read_runs(spark, folder, after=seen).count() == 0
    land_runs(runs(spark, (1, 2)), folder)
    assert {r["run_id"][:2] for r in read_runs(spark, folder, after=seen).collect()} == {"r1", "r2"}


def test_a_landing_that_dies_is_not_seen(spark, monkeypatch):
    folder = scratch_path(spark, "t-landing")
    land_runs(runs(spark, (0,)), folder)
    monkeypatch.setattr(commits, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        land_runs(runs(spark, (1,)), folder)
    assert read_runs(spark, folder).count() == 6
