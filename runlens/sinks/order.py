"""Order of stored rows, checked from where they stand in the files, without sorting them again.

Rows of a file are cut into blocks of ``BLOCK`` by their position. Inside a block neighbours are compared; the first and last keys of
blocks (two rows a block) are then compared inside a file, and those of files across files in name order, which is the
order of the tasks that wrote them. A block is the unit of work, so a large file is checked by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def inversions(stored: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """(rows, files, inside, across): how often a row follows one that it should stand before, in a file and between files.

    ``stored`` is read from Parquet files; ``keys`` are (column, descending) in order of weight. Nulls come first, descending last.
    """
    rows = stored.select(F.struct(*[F.col(c).alias(f"k{i}") for i, (c, _) in enumerate(keys)]).alias("key"),
                         F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    rows = rows.withColumn("block", F.floor(F.col("at") / BLOCK))
    before = F.lag("key").over(Window.partitionBy("file", "block").orderBy("at"))
    near = rows.withColumn("wrong", _follows(before, F.col("key"), keys))
    blocks = near.groupBy("file", "block").agg(
        F.count("*").alias("rows"), F.count_if("wrong").alias("inside"), F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"))
    # Two keys a block from here on.
    seam = F.lag("last").over(Window.partitionBy("file").orderBy("block"))
    files = blocks.withColumn("seam", _follows(seam, F.col("first"), keys)).groupBy("file").agg(
        F.sum("rows").alias("rows"), (F.sum("inside") + F.count_if("seam")).alias("inside"),
        F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last"))
    border = F.lag("last").over(Window.orderBy("file"))     # one row a file
    return files.withColumn("border", _follows(border, F.col("first"), keys)).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("*").alias("files"),
        F.coalesce(F.sum("inside"), F.lit(0)).alias("inside"), F.count_if("border").alias("across"))


def _follows(earlier, later, keys: Sequence[tuple[str, bool]]):
    """Whether ``earlier`` should stand behind ``later``; false where there is no earlier row."""
    wrong = F.lit(False)
    for i, (_, descending) in reversed(list(enumerate(keys))):
        a, b = earlier[f"k{i}"], later[f"k{i}"]
        # A null is less than any value.
        less = (a.isNull() & b.isNotNull()) | F.coalesce(a < b, F.lit(False))
        more = (b.isNull() & a.isNotNull()) | F.coalesce(a > b, F.lit(False))
        wrong = (less if descending else more) | (a.eqNullSafe(b) & wrong)
    return earlier.isNotNull() & wrong
