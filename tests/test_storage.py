"""Snapshots and the snapshot log (SNK1, SNK7, SRC10), layout inference (SNK6)."""

import pytest
from pyspark.sql import functions as F

from runlens.session import scratch_path
from runlens.sinks.layout import infer_types
from runlens.sinks.snapshots import compact_log, load_latest, snapshot_log, write_snapshot
from tests.helpers import T0, metric_rows


def _df(spark, n=5):
    return metric_rows(spark, [(f"r{i}", "0", "click", float(i), T0) for i in range(n)])


def test_rerun_same_key_is_idempotent(spark):
    base = scratch_path(spark, "t-snap")
    write_snapshot(_df(spark), base, "t", "k1", T0)
    write_snapshot(_df(spark), base, "t", "k1", T0)
    assert load_latest(spark, base, "t").count() == 5
    assert spark.read.parquet(f"{base}/t").count() == 5


def test_empty_snapshot_is_honoured(spark):
    base = scratch_path(spark, "t-snap")
    write_snapshot(_df(spark), base, "t", "k1", T0)
    write_snapshot(_df(spark).limit(0), base, "t", "k2", T0)
    out = load_latest(spark, base, "t")
    assert out.count() == 0 and out.columns == _df(spark).columns
    assert snapshot_log(spark, base).where("table_name = 't'").count() == 2


def test_loads_are_logged(spark):
    from runlens.sinks.snapshots import load_log, load_snapshot

    base = scratch_path(spark, "t-loads")
    write_snapshot(_df(spark, 3), base, "t", "k1", T0)
    write_snapshot(_df(spark).limit(0), base, "t", "k2", T0)
    load_snapshot(spark, base, "t", "k1")
    for _ in range(2):
        load_latest(spark, base, "t")
    got = load_log(spark, base).orderBy("loaded_at").collect()
    assert [(r["table_name"], r["snapshot_id"], r["rows"], r["path"]) for r in got] == [
        ("t", "k1", 3, f"{base}/t"), ("t", "k2", 0, f"{base}/t"), ("t", "k2", 0, f"{base}/t")]
    assert compact_log(spark, base, max_files=1) and load_log(spark, base).count() == 3


def test_missing_snapshot_raises(spark):
    base = scratch_path(spark, "t-snap")
    write_snapshot(_df(spark), base, "other", "k1", T0)
    with pytest.raises(FileNotFoundError):
        load_latest(spark, base, "t")


def test_layout_lossless_only(spark):
    df = spark.createDataFrame([("1", "1.5", "x", "2024-01-01 00:00:00", "7"), ("2", "abc", "y", None, "8")],
                               "a string, b string, c string, end_time string, exp_id string")
    got = {r["column_name"]: r["inferred_type"] for r in infer_types(df).collect()}
    assert got == {"a": "bigint", "b": "string", "c": "string", "end_time": "timestamp"}


def test_plain_sinks_and_parameterised_sql(spark):
    from runlens.sinks.tables import create_table, execute, read_parquet, register, write_parquet

    base = scratch_path(spark, "t-tables")
    df = _df(spark, 4)
    write_parquet(df, f"{base}/p")
    assert read_parquet(spark, f"{base}/p").count() == 4
    register(df, "t_rows")
    assert execute(spark, "SELECT count(*) AS n FROM t_rows WHERE metric_value >= :lo", {"lo": 2.0}).first()["n"] == 2
    create_table(df.select("run_id", "metric_value"), "t_rows_tbl")
    assert spark.table("t_rows_tbl").count() == 4


def test_log_compaction_keeps_every_row(spark):
    base = scratch_path(spark, "t-snap")
    for i in range(4):
        write_snapshot(_df(spark, i + 1), base, "t", f"k{i}", T0)
    before = sorted(snapshot_log(spark, base).select("snapshot_id", "rows").collect())
    assert not compact_log(spark, base, max_files=10)
    assert compact_log(spark, base, max_files=2)
    assert sorted(snapshot_log(spark, base).select("snapshot_id", "rows").collect()) == before
    assert len(snapshot_log(spark, base).inputFiles()) == 1
    write_snapshot(_df(spark, 9), base, "t", "k9", T0)
    assert load_latest(spark, base, "t").count() == 9 and snapshot_log(spark, base).count() == 5


def test_writer_that_dies_before_its_record_changes_nothing(spark, monkeypatch):
    import datetime as dt

    from runlens.sinks import commits
    from runlens.sinks.snapshots import sweep_snapshots

    base = scratch_path(spark, "t-commit")
    write_snapshot(_df(spark, 3), base, "t", "k1", T0)
    with monkeypatch.context() as m:
        m.setattr(commits, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            write_snapshot(_df(spark, 8), base, "t", "k1", T0)
    assert load_latest(spark, base, "t").count() == 3 and snapshot_log(spark, base).count() == 1
    assert sweep_snapshots(spark, base) == []                       # too young: its writer might still commit
    gone = sweep_snapshots(spark, base, dt.timedelta(0))
    assert len(gone) == 1 and load_latest(spark, base, "t").count() == 3


def test_concurrent_writers_of_one_snapshot(spark, monkeypatch):
    """Another writer commits between this one's data and its record: both are whole, the later record wins."""
    from runlens.sinks import commits

    base = scratch_path(spark, "t-race")
    real, turns = commits.append, []

    def late(*args, **kw):
        if not turns:
            turns.append(1)
            write_snapshot(_df(spark, 8), base, "t", "k1", T0)
            assert load_latest(spark, base, "t").count() == 8
        return real(*args, **kw)

    monkeypatch.setattr(commits, "append", late)
    write_snapshot(_df(spark, 3), base, "t", "k1", T0)
    assert sorted(r["metric_value"] for r in load_latest(spark, base, "t").collect()) == [0.0, 1.0, 2.0]
    assert spark.read.parquet(f"{base}/t").count() == 3 and snapshot_log(spark, base).count() == 2


def test_record_numbers_are_given_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    from runlens.sinks import commits

    log = f"{scratch_path(spark, 't-log')}/_log"
    commits.commit(spark, log, 1, {"a": 1})
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, log, 1, {"a": 2})
    assert commits.read(spark, log, 1) == {"a": 1}
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: commits.append(spark, log, {"a": i})["commit_no"], range(12)))
    assert len(commits.numbers(spark, log)) == 1 + len(set(got)) == 13


TEXTS = {
    "whole": (["0", "-7", "9007199254740993"], "bigint"),
    "mixed": (["9007199254740993", "2.5", None], "string"),
    "padded": (["007", "8", "9"], "string"),
    "signed_zero": (["-0.0", "1.5", "2.5"], "double"),
    "price": (["2.50", "0.05", "123456789012345678901234567890.25"], "decimal(32,2)"),
    "scales": (["2.5", "0.125", "1.0E10"], "double"),
    "deep": (["0.0000000001", "0.1234567891", "1.1234567891"], "string"),
    "suffixes": (["1d", "2f", "1e400"], "string"),
    "wide": (["99999999999999999999", "1", "2"], "string"),
    "spaces": ([" 5 ", "6", "7"], "string"),
    "odd": (["NaN", "Infinity", "1.5"], "string"),
    "none": ([None, None, None], "string"),
    "a_time": (["2024-01-31 23:59:59", "1969-12-31 00:00:00", None], "timestamp"),
    "b_time": (["2024-01-31T23:59:59.25Z", "0001-01-01T00:00:00.00Z", "9999-12-31T23:59:59.99Z"], "timestamp"),
    "c_timestamp": (["2024-01-31 23:59:59.000001+05:30", "2024-03-10 02:30:00.123456+05:30", "1900-01-01 00:00:00.000000+05:30"], "timestamp"),
    "zones_time": (["2024-01-31 23:59:59+05:00", "2024-01-31 23:59:59+06:00", None], "string"),
    "long_time": (["2024-01-31 23:59:59.1234567", "2024-01-31 23:59:59.1234567", None], "string"),
    "bad_time": (["2024-02-30 00:00:00", "2024-02-28 00:00:00", None], "string"),
    "day_time": (["2024-02-28", "2024-02-27", None], "string"),
    "when": (["2024-01-31 23:59:59", "2024-01-31 23:59:58", None], "string"),
    "user_id": (["1", "2", "3"], "string"),
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_typed_snapshots_give_every_text_back(spark, zone):
    from runlens.sinks.layout import sketch

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(list(zip(*[v for v, _ in TEXTS.values()])), ", ".join(f"{c} string" for c in TEXTS))
        assert {x.column_name: x.inferred_type for x in sketch(df)} == {c: t for c, (_, t) in TEXTS.items()}
        base = scratch_path(spark, "t-typed")
        write_snapshot(df, base, "t", "k", T0, infer=True)
        back = load_latest(spark, base, "t")
        assert back.schema == df.schema
        assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
        stored = dict(load_latest(spark, base, "t", physical=True).dtypes)
        assert stored == {c: t for c, (_, t) in TEXTS.items()}
        assert infer_types(df.select("mixed")).first()["inferred_type"] == "string"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hours_that_the_zone_skips_stay_text(spark):
    from runlens.sinks.layout import sketch

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00", "2024-03-10 02:30:00Z")], "a_time string, b_time string")
        assert [x.inferred_type for x in sketch(df)] == ["string", "timestamp"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dictionary_decision_reaches_the_files(spark):
    import glob

    import pyarrow.parquet as pq

    base = scratch_path(spark, "t-dictionary")
    df = spark.range(3000).selectExpr("concat('k', id % 7) AS few", "concat('k', id) AS many", "concat('k', id % 1700) AS over")
    record = write_snapshot(df.coalesce(1), base, "t", "k", T0, infer=True)
    meta = pq.ParquetFile(glob.glob(f"{record['data_path']}/*.parquet")[0]).metadata.row_group(0)
    encoded = {meta.column(i).path_in_schema: any("DICTIONARY" in e for e in meta.column(i).encodings) for i in range(3)}
    assert encoded == {"few": True, "many": False, "over": False}


def test_order_check_sees_every_seam(spark, monkeypatch):
    from runlens.sinks import order

    monkeypatch.setattr(order, "BLOCK", 3)
    keys = [("a", False), ("b", True)]

    def check(parts, keys=keys):
        base = scratch_path(spark, "t-order")
        rows = spark.sparkContext.parallelize(parts, len(parts)).flatMap(list)      # one file per part
        spark.createDataFrame(rows, "a string, b long").write.parquet(base)
        r = order.inversions(spark.read.parquet(base), keys).first()
        return r["rows"], r["files"], r["inside"], r["across"]

    good = [[(None, 5), (None, None), ("a", 3), ("a", 3), ("a", None)], [("b", 9), ("b", 1), ("c", 7), ("d", 7)]]
    assert check(good) == (9, 2, 0, 0)
    assert check(good[::-1]) == (9, 2, 0, 1)
    assert check([[("a", 1), ("a", 2), ("a", 3), ("a", 2)], [("b", 0)]]) == (5, 2, 2, 0)      # one of them at a block's seam or inside
    assert check([[("a", 3), ("a", 2), ("a", 1), ("a", 9)]])[2] == 1                          # at the seam of two blocks
    assert check([[("b", 1), (None, 1)]]) == (2, 1, 1, 0)
    assert check([[]])[2:] == (0, 0)
