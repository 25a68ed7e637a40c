"""The stored tables of the incremental stream and their commits.

``<work>/history``, ``<work>/hourly`` and ``<work>/index`` hold folders ``commit=<id>`` with sub-folders per day or bucket;
``<work>/_state`` holds numbered records that list which of them count. A batch writes its history rows, the
recomputed days and its index rows to one fresh commit and makes all of it visible by one renamed record,
so a reader never sees a moved run in two days or in none, and a batch that is replayed after its commit is recognised by its id.

The index says on which day a run stands: (run_id, newest extraction, start, day), in ``buckets`` hash buckets of run_id. A
batch reads the buckets of its own runs and appends to them. A bucket is rewritten when it has more than ``MAX_FOLDERS`` parts, and
the number of buckets is quadrupled when they hold more than ``bucket_runs`` runs on average, so a look-up costs at most
``bucket_runs`` rows a bucket, whatever the history holds.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.session import local_table
from runlens.sinks import commits

MAX_FOLDERS = 8
BUCKET_RUNS = 50_000
KEPT_RECORDS = 10

INDEX = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("newest", T.StructType([
        T.StructField("extraction_timestamp", T.TimestampType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("day_key", T.StringType()),
    ])),
])

START = {"number": 0, "batch": -1, "history": {}, "hourly": {}, "index": {}, "buckets": 1, "runs": 0, "schemas": {}, "retired": []}


class StreamTables:
    """One work folder's tables as of a commit; ``read_paths`` lists the folders that were read through it."""

    def __init__(self, spark: SparkSession, work: str):
        self.spark, self.work = spark, work.rstrip("/")
        taken = commits.numbers(spark, f"{self.work}/_state")
        self.state = commits.read(spark, f"{self.work}/_state", taken[-1]) if taken else json.loads(json.dumps(START))
        self.read_paths: list[str] = []

    @classmethod
    def beside(cls, spark: SparkSession, table_path: str) -> StreamTables:
        return cls(spark, os.path.dirname(table_path.rstrip("/")))

    def with_changes(self, changed: dict) -> StreamTables:
        """The same tables with parts that are written but not committed."""
        other = object.__new__(StreamTables)
        other.spark, other.work, other.read_paths, other.state = self.spark, self.work, self.read_paths, {**self.state, **changed}
        return other

    def read(self, table: str, schema: T.StructType, keys: list[str] | None = None) -> DataFrame:
        """Rows of ``table`` in the given days or buckets (all by default), with the column of that name."""
        listed = self.state[table]
        part = "bucket" if table == "index" else "day_key"
        own = [(k, c) for k in (listed if keys is None else keys) if k in listed for c in _listed(listed[k])]
        paths = [f"{self.work}/{table}/commit={c}/{part}={k}" for k, c in own]
        self.read_paths += paths
        full = T.StructType([*[f for f in schema.fields if f.name != part], T.StructField("commit", T.StringType()), T.StructField(part, T.StringType())])
        if not paths:
            return local_table(self.spark, [], full).drop("commit")
        return self.spark.read.schema(full).option("basePath", f"{self.work}/{table}").parquet(*paths).drop("commit")

    def write(self, rows: DataFrame, table: str, commit: str) -> list[str]:
        """Add rows partitioned by day or bucket to a commit that is not recorded yet; the days or buckets it has rows of."""
        part = "bucket" if table == "index" else "day_key"
        path = f"{self.work}/{table}/commit={commit}"
        rows.write.mode("append").partitionBy(part).parquet(path)
        return [n.split("=", 1)[1] for n in commits.children(self.spark, path) if n.startswith(f"{part}=")]

    def drop(self, table: str, commit: str) -> None:
        """Remove a commit that no record names."""
        commits.delete_path(self.spark, f"{self.work}/{table}/commit={commit}")

    @contextmanager
    def kept(self, name: str, rows: DataFrame, commit: str) -> Iterator[DataFrame]:
        """Rows that several steps of a batch read, as files that go when the batch ends."""
        path = f"{self.work}/_{name}/commit={commit}"
        try:
            rows.write.parquet(path)
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            commits.delete_path(self.spark, path)

    def bucket(self, run_id: str = "run_id") -> F.Column:
        return F.pmod(F.xxhash64(run_id), F.lit(self.state["buckets"])).cast("string")

    def whereabouts(self, runs: DataFrame) -> DataFrame:
        """(run_id, newest) of those buckets that the runs are in."""
        if not self.state["index"]:
            return local_table(self.spark, [], INDEX)
        # At most one row per bucket.
        keys = ["0"] if self.state["buckets"] == 1 else [r[0] for r in runs.select(self.bucket().alias("b")).distinct().collect()]
        return self.read("index", INDEX, keys).groupBy("run_id").agg(F.max("newest").alias("newest"))

    def commit(self, batch: int, changed: dict) -> None:
        """Make the changed parts visible; raises ``CommitConflict`` if another writer committed meanwhile."""
        old = self.state
        new = {**old, **changed, "number": old["number"] + 1, "batch": max(batch, old["batch"])}
        new["retired"] = sorted(_folders(old) - _folders(new))
        commits.commit(self.spark, f"{self.work}/_state", new["number"], new)
        # What the commit before this one replaced: readers of the record before may still be at what this one replaces.
        for path in set(old["retired"]) - _folders(new):
            commits.delete_path(self.spark, f"{self.work}/{path}")
        expired = commits.numbers(self.spark, f"{self.work}/_state")[:-KEPT_RECORDS]
        for number in expired:
            commits.delete_path(self.spark, f"{self.work}/_state/{number:0{commits.DIGITS}d}.json")
        self.state = new

    def sweep(self, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
        """Remove commits that no record names (writers that died) and that are older than ``older_than``."""
        named = {p.split("/")[1] for p in _folders(self.state) | set(self.state["retired"])}
        return [n for table in ("history", "hourly", "index", "_runs") for n in commits.sweep(self.spark, f"{self.work}/{table}", named, older_than)]


def _listed(value) -> list[str]:
    return value if isinstance(value, list) else [value]


def _folders(state: dict) -> set[str]:
    return {f"{table}/commit={c}/{part}={k}" for table, part in (("history", "day_key"), ("hourly", "day_key"), ("index", "bucket"))
            for k, cs in state[table].items() for c in _listed(cs)}


def added(listed: dict, keys: list[str], commit: str) -> dict:
    """``listed`` with one more commit for each key."""
    return {**listed, **{k: [*listed.get(k, []), commit] for k in keys}}


def index_change(tables: StreamTables, rows: DataFrame, commit: str, bucket_runs: int = BUCKET_RUNS) -> dict:
    """Write the changed ones of a batch's rows (run_id, newest, fresh, changed) to the index; the changed parts of the state."""
    counts = rows.agg(F.count_if("fresh").alias("fresh"), F.count_if("changed").alias("changed")).first()
    if not counts["changed"]:
        return {}
    own = rows.where("changed").select("run_id", "newest")
    runs = tables.state["runs"] + counts["fresh"]
    listed, buckets = tables.state["index"], tables.state["buckets"]
    while runs > bucket_runs * buckets:
        buckets *= 4
    if buckets > tables.state["buckets"]:   # all runs are dealt anew, those of the batch straight into the new buckets
        later = tables.with_changes({"buckets": buckets})
        if listed:
            own = later.read("index", INDEX).select(*own.columns).unionByName(own).groupBy("run_id").agg(F.max("newest").alias("newest"))
        keys = later.write(own.withColumn("bucket", later.bucket()).repartition("bucket"), "index", commit)
        return {"index": {k: [commit] for k in keys}, "buckets": buckets, "runs": runs}
    keys = tables.write(own.withColumn("bucket", tables.bucket()).repartition("bucket"), "index", commit)
    listed = added(listed, keys, commit)
    full = [k for k, cs in listed.items() if len(cs) > MAX_FOLDERS]
    if full:
        merged = tables.with_changes({"index": listed}).read("index", INDEX, full).groupBy("run_id").agg(F.max("newest").alias("newest"))
        fresh = commits.fresh_id()
        keys = tables.write(merged.withColumn("bucket", tables.bucket()).repartition("bucket"), "index", fresh)
        listed = {**{k: cs for k, cs in listed.items() if k not in full}, **{k: [fresh] for k in keys}}
    return {"index": listed, "buckets": buckets, "runs": runs}
