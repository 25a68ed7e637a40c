"""Landed run files and their catalogue: which files hold which stretch of start times.

Each landing is one commit: the files of an extract, then a zone map (file, least and greatest start_time, rows), then
the record that makes both visible. Scans choose files by their zones before Spark lists or opens anything, and a reader that
remembers the last record number it saw reads only what landed since.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schemas as S
from runlens.sinks import commits
from runlens.sources.runs import normalize_run_times, scan_runs

ZONES = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("first_start", T.TimestampType()),
    T.StructField("last_start", T.TimestampType()),
    T.StructField("rows", T.LongType()),
])


def land_runs(runs: DataFrame, folder: str) -> int:
    """Write one extract, each file a stretch of start times, and add it to the catalogue; its record number."""
    spark, commit = runs.sparkSession, commits.fresh_id()
    data, zones = f"{folder.rstrip('/')}/runs/{commit}", f"{folder.rstrip('/')}/_zones/{commit}"
    runs.repartitionByRange("start_time").sortWithinPartitions("start_time").write.parquet(data)
    stored = spark.read.schema(runs.schema).parquet(data)
    found = normalize_run_times(stored.select("start_time", F.col("_metadata.file_name").alias("file")))
    found.groupBy("file").agg(F.min("start_time").alias("first_start"), F.max("start_time").alias("last_start"),
                              F.count("*").alias("rows")).write.parquet(zones)
    return commits.append(spark, f"{folder.rstrip('/')}/_landings", {"commit": commit})["commit_no"]


def newest_landing(spark: SparkSession, folder: str) -> int:
    """The number of the last landing (0 if nothing has landed)."""
    return max(commits.numbers(spark, f"{folder.rstrip('/')}/_landings"), default=0)


def zones(spark: SparkSession, folder: str, after: int = 0) -> DataFrame:
    """The zone map of all landings after a record number, with the path of each file."""
    folder = folder.rstrip("/")
    own = [commits.read(spark, f"{folder}/_landings", n)["commit"] for n in commits.numbers(spark, f"{folder}/_landings") if n > after]
    if not own:
        return spark.createDataFrame([], ZONES).withColumn("path", F.lit(""))
    found = spark.read.schema(ZONES).parquet(*[f"{folder}/_zones/{c}" for c in own])
    commit = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return found.select("*", F.concat(F.lit(f"{folder}/runs/"), commit, F.lit("/"), F.col("file")).alias("path"))


def files_between(spark: SparkSession, folder: str, since: dt.datetime | None = None, until: dt.datetime | None = None, after: int = 0) -> list[str]:
    """The landed files that may hold starts after ``since`` and up to ``until`` (the files a scan opens; Spark's driver lists them anyway)."""
    found = zones(spark, folder, after)
    if since is not None:
        found = found.where(F.col("last_start") > F.lit(since))
    if until is not None:
        found = found.where(F.col("first_start") <= F.lit(until))
    return sorted(r["path"] for r in found.select("path").toLocalIterator())


def read_runs(spark: SparkSession, folder: str, since: dt.datetime | None = None, until: dt.datetime | None = None, after: int = 0,
              raw: bool = False) -> DataFrame:
    """Landed runs from the files whose zones meet the interval; rows of these files are not filtered further."""
    schema = S.RUNS_RAW if raw else S.RUNS
    paths = files_between(spark, folder, since, until, after)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def scan_landed(spark: SparkSession, folder: str, experiments: DataFrame, as_of: dt.datetime, hours: int,
                experiment_filter: str | None = None, raw: bool = False) -> DataFrame:
    """``scan_runs`` over the landed files that can hold runs of the lookback window."""
    runs = read_runs(spark, folder, as_of - dt.timedelta(hours=hours), as_of, raw=raw)
    return scan_runs(runs, experiments, as_of, f"{hours} HOURS", experiment_filter)
