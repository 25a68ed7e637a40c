"""Weighted rendezvous hashing of record keys over shards (operator 1).

Each (key, shard) pair gets a uniform number u from a digest of both; the record goes to
the shard with the least ``-ln(u) / weight``. Nothing but the key and the shard list
decides: a new shard can only take records that score best on it, and a removed shard's
records spread over the rest. Assignment is a projection, without a shuffle.

Defined cases: a null key is a key of its own (one shard for all null keys); equal keys,
so repeated rows too, share a shard and get different slots; an empty table gives an empty
table; ties of the score (equal digests) go to the smaller shard number; input columns
named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import as_row, bucket_of, from_row, gapless_rank

NULL_KEY = "\u0000null"
# 13 hex digits are 52 bits: exact in a double.
U_DIGITS = 13


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key among ``weights`` (shard number -> positive weight)."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("shards need positive weights")
    text = F.coalesce(key.cast("string"), F.lit(NULL_KEY))
    scores = []
    for shard, weight in sorted(weights.items()):
        digest = F.md5(F.concat(text, F.lit(f"/{shard}")).cast("binary"))
        u = (F.conv(F.substring(digest, 1, U_DIGITS), 16, 10).cast("double") + 0.5) / F.lit(float(16**U_DIGITS))
        scores.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("score"), F.lit(int(shard)).alias("shard")))
    return F.array_min(F.array(*scores)).getField("shard")


def assign_shards(df: DataFrame, key: str, weights: Mapping[int, float],
                  grown: Mapping[int, float] | None = None, bucket_digits: int = 3) -> DataFrame:
    """``df`` with ``shard``, ``slot`` and, given a grown shard list, ``grown_shard``.

    ``slot`` numbers a shard's records from 0 without gaps. A shard is an unbounded group,
    so it is numbered in ``16**bucket_digits`` hash buckets; the order inside a
    bucket is by key, then by a digest of the other columns.
    """
    rows = as_row(df)
    k = F.col("row").getField(key)
    digest = F.md5(F.to_json(F.col("row"), {"ignoreNullFields": "false"}).cast("binary"))
    rows = rows.select("row", k.alias("__key"), digest.alias("__digest"), rendezvous(k, weights).alias("shard"),
                       *([rendezvous(k, grown).alias("grown_shard")] if grown else []))
    rows = rows.withColumn("__bucket", bucket_of(F.col("__digest"), bucket_digits))
    ranked = gapless_rank(rows, ["shard"], "__bucket", ["__key", "__digest"], "slot")
    return from_row(ranked, "shard", "slot", *(["grown_shard"] if grown else []))
