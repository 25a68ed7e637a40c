"""Session helpers: a local session for tests/bench and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "runlens") -> SparkSession:
    """Session used by tests and bench; production jobs receive the cluster's session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="runlens-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a session on a ``local`` master (tests) gets a
    temporary folder of its own; on a cluster that folder would be private to one
    machine, so an unset folder is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    if not spark.conf.get("spark.master", "").split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="runlens-shared-")
        spark.sparkContext.setCheckpointDir(_LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one job's tables."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/runlens/{name}-{uuid.uuid4().hex[:12]}"


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def _sql_literal(v, dtype) -> str:
    import datetime as dt

    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return f"CAST({v!r} AS {dtype.simpleString()})"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def local_table(spark: SparkSession, rows, schema):
    """A small literal table as a VALUES relation: planned on the JVM, exact size known
    to the optimizer (so joins against it broadcast by statistics, not by guess)."""
    from pyspark.sql import functions as F

    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    values = ", ".join(
        "(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")" for r in rows
    )
    names = ", ".join(f.name for f in schema.fields)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
