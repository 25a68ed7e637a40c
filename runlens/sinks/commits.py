"""Commit records: small JSON files that make written data visible, one atomic rename each.

Data is written to a fresh folder first; it counts once a record that names it exists. A record gets the next
free number of its log by renaming a finished file to it, and a rename onto an existing name fails, so of two
writers one gets the number and the other takes the next. A writer that dies before its rename leaves data that no record
names; ``sweep`` removes it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 12


class CommitConflict(RuntimeError):
    """The number of the record is taken: another writer committed first."""


def fresh_id() -> str:
    return uuid.uuid4().hex[:16]


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, folder: str) -> dict[str, dt.datetime]:
    """Names in a folder with their modification times; nothing for a folder that does not exist."""
    fs, p = file_system(spark, folder)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): dt.datetime.fromtimestamp(s.getModificationTime() / 1000) for s in fs.listStatus(p)}


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The record numbers of a log, ascending (a compacted file carries the last number it holds)."""
    return sorted({int(n.split(".")[0]) for n in children(spark, folder) if n.endswith(".json") and n[:DIGITS].isdigit()})


def commit(spark: SparkSession, folder: str, number: int, record: dict) -> None:
    """Store ``record`` under ``number``; raises ``CommitConflict`` if that number is taken."""
    put(spark, f"{folder.rstrip('/')}/{number:0{DIGITS}d}.json", [record])


def put(spark: SparkSession, path: str, records: list[dict]) -> None:
    """Write JSON lines to a hidden file and rename it to ``path``, which must not exist."""
    jvm = spark._jvm
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/_{fresh_id()}"
    fs, p = file_system(spark, hidden)
    out = fs.create(p, False)
    try:
        out.write(bytearray("".join(json.dumps(r) + "\n" for r in records).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(p, jvm.org.apache.hadoop.fs.Path(path), spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        fs.delete(p, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise CommitConflict(f"record {name} of {folder} is taken") from e
        raise


def append(spark: SparkSession, folder: str, record: dict, key: str = "commit_no", tries: int = 100) -> dict:
    """Store ``record`` under the next free number, which it carries as ``key``; returns it."""
    for _ in range(tries):
        number = 1 + max(numbers(spark, folder), default=0)
        stored = {**record, key: number}
        try:
            commit(spark, folder, number, stored)
        except CommitConflict:
            continue
        return stored
    raise CommitConflict(f"no free record number in {folder} after {tries} tries")


def read(spark: SparkSession, folder: str, number: int) -> dict:
    """One record, read by the driver."""
    fs, p = file_system(spark, f"{folder.rstrip('/')}/{number:0{DIGITS}d}.json")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def retire(spark: SparkSession, folder: str, own: str, number: int, older_than: dt.timedelta) -> None:
    """Mark the committed child ``own`` with its number and delete the marked children that an older number superseded.

    Children without a mark belong to writers that have not committed; they stay.
    """
    fs, p = file_system(spark, f"{folder}/{own}")
    if fs.exists(p):
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{own}/_commit_{number}"), True).close()
    limit = dt.datetime.now() - older_than
    marks = {name: (int(m.split("_")[-1]), at) for name in children(spark, folder)
             for m, at in children(spark, f"{folder}/{name}").items() if m.startswith("_commit_")}
    newest = max([number, *[n for n, _ in marks.values()]])
    for name, (n, at) in marks.items():
        if n < newest and at <= limit:
            delete_path(spark, f"{folder}/{name}")


def sweep(spark: SparkSession, folder: str, kept: set[str], older_than: dt.timedelta) -> list[str]:
    """Delete the children of ``folder`` that are not in ``kept`` and were last changed before ``older_than`` ago.

    The age protects writers that have data but no record yet.
    """
    limit = dt.datetime.now() - older_than
    gone = [n for n, at in children(spark, folder).items() if n not in kept and not n.startswith("_") and at <= limit]
    for name in gone:
        delete_path(spark, f"{folder.rstrip('/')}/{name}")
    return gone
