"""Dated Parquet snapshots of a table plus a snapshot log.

Layout: ``<base>/<table>/snapshot_date=YYYY-MM-DD/snapshot_id=<run key>/commit=<fresh id>/part-*.parquet``
and ``<base>/_snapshot_log`` (one record per write, also for empty outputs), ``<base>/_load_log`` (one record per load).

A write is visible when its record is (one atomic rename, see ``commits``): a job that dies between data and record
leaves the old snapshot readable. Readers take the record with the highest number, and only the folder it names.
Re-writing a snapshot_id leaves one copy, so a re-run of a scheduled run is idempotent: of two writers at once
the later record wins whole, and the superseded folder is removed after the commit (or later, see ``retain``). Folders without
a record are left to ``sweep_snapshots``, as their writers may still be at work.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.sinks import commits
from runlens.sinks.commits import delete_path, file_system
from runlens.sinks.layout import ColumnLayout, as_records, first_time_column, restore, sketch, stored_types, writer_options

LOG_FILES = 64      # a log of more files is compacted by the next job

LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("snapshot_date", T.StringType()),
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("size_mb", T.DoubleType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("data_types", T.StringType()),
    T.StructField("schema_json", T.StringType()),
    T.StructField("layout_json", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("data_path", T.StringType()),
    T.StructField("commit_no", T.LongType()),
    T.StructField("written_at", T.TimestampType()),
])

LOAD_SCHEMA = T.StructType([*[f for f in LOG_SCHEMA.fields if f.name not in ("schema_json", "layout_json", "written_at")],
                            T.StructField("loaded_at", T.TimestampType())])


def run_key(kind: str, as_of: dt.datetime) -> str:
    """Idempotent run key per scheduled time, e.g. ``delta_2024-02-01T00-05``."""
    return f"{kind}_{as_of.strftime('%Y-%m-%dT%H-%M')}"


def write_snapshot(df: DataFrame, base: str, table: str, snapshot_id: str, as_of: dt.datetime,
                   sort_by_time: bool = True, infer: bool = False, retain: dt.timedelta = dt.timedelta(0)) -> dict:
    """Write one snapshot (Snappy Parquet, micros timestamps) and commit it with its log record.

    The row count is observed during the write itself (no second pass). ``infer`` stores text columns in the types and
    encodings that ``layout.sketch`` finds, which reads ``df`` once more; loads give the texts back.
    Folders of this snapshot that were superseded over ``retain`` ago are removed (readers may still hold a younger one).
    """
    spark = df.sparkSession
    layouts = sketch(df) if infer else []
    date = as_of.strftime("%Y-%m-%d")
    out = stored_types(df, layouts)
    tcol = first_time_column(df) if sort_by_time else None
    if tcol:
        out = out.sortWithinPartitions(tcol)
    obs = Observation(f"snapshot_{table}_{snapshot_id}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    path = f"{base.rstrip('/')}/{table}"
    snapshot = f"{path}/snapshot_date={date}/snapshot_id={snapshot_id}"
    data = f"{snapshot}/commit={commits.fresh_id()}"
    out.write.option("compression", "snappy").options(**writer_options(layouts)).parquet(data)
    rows = int(obs.get.get("rows", 0))
    record = {
        "table_name": table, "snapshot_date": date, "snapshot_id": snapshot_id, "rows": rows,
        "size_mb": snapshot_size_mb(spark, data) if rows else 0.0,
        "columns": df.columns, "data_types": json.dumps(dict(out.dtypes)), "schema_json": df.schema.json(),
        "layout_json": json.dumps(as_records(layouts)),
        "path": path, "data_path": data, "written_at": _now(),
    }
    record = commits.append(spark, f"{base.rstrip('/')}/_snapshot_log", record)
    if not rows:
        delete_path(spark, data)     # an empty snapshot is its record alone
    commits.retire(spark, snapshot, data.rsplit("/", 1)[1], record["commit_no"], retain)
    return record


def sweep_snapshots(spark: SparkSession, base: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove data folders that are no snapshot's newest commit (dead writers, superseded copies) and are older than ``older_than``."""
    newest = (snapshot_log(spark, base).groupBy("table_name", "snapshot_date", "snapshot_id")
              .agg(F.max_by("data_path", "commit_no").alias("data_path"), F.first("path").alias("path")))
    kept: dict[str, set] = {}
    for r in newest.select("path", "snapshot_date", "snapshot_id", "data_path").toLocalIterator():     # one row per snapshot
        kept[f"{r['path']}/snapshot_date={r['snapshot_date']}/snapshot_id={r['snapshot_id']}"] = {r["data_path"].rsplit("/", 1)[1]}
    gone = []
    for table in [n for n in commits.children(spark, base) if not n.startswith("_")]:
        for date in commits.children(spark, f"{base.rstrip('/')}/{table}"):
            for snapshot in commits.children(spark, f"{base.rstrip('/')}/{table}/{date}"):
                folder = f"{base.rstrip('/')}/{table}/{date}/{snapshot}"
                gone += [f"{folder}/{n}" for n in commits.sweep(spark, folder, kept.get(folder, set()), older_than)]
    return gone


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def snapshot_size_mb(spark: SparkSession, partition: str) -> float:
    """Bytes of one snapshot partition's files, from the file listing."""
    fs, p = file_system(spark, partition)
    return round(fs.getContentSummary(p).getLength() / (1024 * 1024), 4)


def snapshot_log(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(f"{base.rstrip('/')}/_snapshot_log").distinct()


def load_log(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(LOAD_SCHEMA).json(f"{base.rstrip('/')}/_load_log").distinct()


def compact_log(spark: SparkSession, base: str, max_files: int = LOG_FILES) -> bool:
    """Rewrite the snapshot log and the load log, see ``_compact``; whether the snapshot log was rewritten."""
    _compact(spark, f"{base.rstrip('/')}/_load_log", LOAD_SCHEMA, max_files)
    return _compact(spark, f"{base.rstrip('/')}/_snapshot_log", LOG_SCHEMA, max_files)


def _compact(spark: SparkSession, path: str, schema: T.StructType, max_files: int) -> bool:
    """Rewrite a log of more than ``max_files`` files as one file (a record per write or load: small).

    The new file is added before the old ones go, and readers ignore equal rows, so a job that dies in between
    loses nothing; records that others append meanwhile are in files this call has not listed and stay.
    """
    names = [n for n in commits.children(spark, path) if n.endswith(".json")]
    if len(names) <= max_files:
        return False
    files = [f"{path}/{n}" for n in names]
    # The new name starts with the last number, so that the next record gets a higher one.
    last = max(int(n.split(".")[0]) for n in names)
    lines = spark.read.text(files).distinct().toLocalIterator()
    commits.put(spark, f"{path}/{last:0{commits.DIGITS}d}.{commits.fresh_id()}.json", [json.loads(r["value"]) for r in lines])
    for old in files:
        delete_path(spark, old)
    return True


def load_latest(spark: SparkSession, base: str, table: str, physical: bool = False) -> DataFrame:
    """The newest logged snapshot of ``table``, with the types it was given (``physical``: as stored).

    An empty snapshot yields a typed empty frame; no snapshot at all raises.
    """
    return _load(spark, base, table, F.lit(True), physical)


def load_snapshot(spark: SparkSession, base: str, table: str, snapshot_id: str, physical: bool = False) -> DataFrame:
    """The snapshot of ``table`` under one run key, whatever other jobs wrote since."""
    return _load(spark, base, table, F.col("snapshot_id") == snapshot_id, physical)


def _load(spark: SparkSession, base: str, table: str, which, physical: bool) -> DataFrame:
    log = snapshot_log(spark, base).where((F.col("table_name") == table) & which)
    latest = log.agg(F.max_by(F.struct(*LOG_SCHEMA.names), "commit_no").alias("l")).select("l.*").first()
    if latest is None or latest["snapshot_id"] is None:
        raise FileNotFoundError(f"no snapshot found for table {table!r} under {base}")
    schema = T.StructType.fromJson(json.loads(latest["schema_json"]))
    record = {k: v for k, v in latest.asDict().items() if k in LOAD_SCHEMA.names}
    commits.append(spark, f"{base.rstrip('/')}/_load_log", {**record, "loaded_at": _now()}, key="load_no")
    if latest["rows"] == 0:
        return spark.createDataFrame([], schema)
    # The one commit, with the logged types: no listing of the others, no inference.
    layouts = [ColumnLayout(**x) for x in json.loads(latest["layout_json"])]
    kinds = {x.column_name: x.inferred_type for x in layouts}
    stored = T.StructType([T.StructField(f.name, T._parse_datatype_string(kinds[f.name])) if f.name in kinds else f for f in schema.fields])
    found = spark.read.schema(stored).parquet(latest["data_path"])
    return found if physical else restore(found, layouts)
