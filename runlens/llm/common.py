"""Helpers shared by the operators: table access, lineage cuts, salted ranks, row structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.session import scratch_path, sf_path

# A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, table))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: later plans
    start at files every executor can reach, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def as_row(df: DataFrame) -> DataFrame:
    """The whole input row as one struct column ``row``: columns an operator adds for its
    own use can then not clash with the input's."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))


def from_row(df: DataFrame, *added: str) -> DataFrame:
    """Undo ``as_row``; of equal names the operator's column replaces the input's."""
    names = {a.lower() for a in added}
    kept = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in names]
    return df.select(*[F.col("row").getField(c).alias(c) for c in kept], *added)


def bucket_of(hex_digest: Column, digits: int) -> Column:
    """The first hex digits of a digest as a number."""
    return F.conv(F.substring(hex_digest, 1, digits), 16, 10).cast("int")


def gapless_rank(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence, out: str,
                 offsets: DataFrame | None = None) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in (bucket, order) order.

    The group is split by ``bucket`` (a hash bucket), so a group with a third of all rows is
    sorted by as many tasks as it has buckets. Per bucket only a count leaves the task;
    the running sum of a group's counts gives each bucket's first number. Group columns must
    not be null.
    """
    keys = [*group, bucket]
    if offsets is None:
        offsets = bucket_offsets(df, group, bucket)
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
    return (df.withColumn(out, local).join(offsets, keys)
            .withColumn(out, F.col(out) + F.col("__before") - 1).drop("__before"))


def bucket_offsets(df: DataFrame, group: Sequence[str], bucket: str) -> DataFrame:
    counts = df.groupBy(*group, bucket).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*group).orderBy(bucket)) - F.col("__n")
    return counts.select(*group, bucket, before.alias("__before"))


HOT_CLASSES = 1000


def join_classes(rows: DataFrame, classes: DataFrame, on: str, copies: str) -> DataFrame:
    """Each row with its class (every row has one); ``copies`` is the number of rows of a class.

    A class with over a thousandth of all rows would fill one task of a shuffle join. There are fewer than ``HOT_CLASSES`` of
    them, so they are broadcast; the rows of the others are joined by a shuffle.
    """
    total = classes.agg(F.coalesce(F.sum(copies), F.lit(0)).alias("n")).first()["n"]
    hot = F.col(copies) * HOT_CLASSES > total
    found = rows.join(F.broadcast(classes.where(hot)), on)
    rest = rows.join(F.broadcast(classes.where(hot).select(on)), on, "left_anti").join(classes.where(~hot), on)
    return found.unionByName(rest)
