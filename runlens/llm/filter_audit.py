"""Filter interaction audit (operator 13): what each filter removes under every order of the filters.

A document's outcome under all orders follows from the set of filters it fails, so the audit needs the failures once:

1. Row filters are one projection: a bit per filter.
2. The duplicate filter is an existential self-join: a document fails if a document with the same hash, the same exact
   text and a smaller key exists (left-semi join). The right side holds one row per text, its least key, and
   only texts whose hash several keys share travel at all, so a text that a third of the rows hold is aggregated
   before the shuffle.
3. The failing keys of the join and the failures of the projection are united; one aggregate per key gives the bits.
4. Documents are counted by (part, bits, labels): at most 2**filters * 4 rows per part. Only these counts meet the orders.

Defined cases: a null text counts as empty; a null part as the empty string; a row without key is never smaller than another and
has no smaller one, so it fails no duplicate test and has no label; rows with equal keys are separate rows, and equal
texts under equal keys are not earlier than each other; several labels of a key count as lost if any of them is 1; an
empty table gives an empty result; texts are judged whole; columns of other names are not read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import cut, words
from runlens.operators.joins import sized_side

SALT_ROWS = 500


def duplicate_keys(docs: DataFrame) -> DataFrame:
    """(key, hash) of the rows of ``docs`` (key, hash, text) whose text a smaller key also has."""
    several = docs.groupBy("hash").agg((F.min("key") < F.max("key")).alias("several"), F.ceil(F.count("*") / SALT_ROWS).alias("salts"))
    several = cut(several.where("several").select("hash", "salts"), "audit-hashes")
    shared = docs.join(sized_side(several), "hash")
    shared = shared.withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")))
    # One row per text and salt: the copies of a text are spread over as many tasks as it has SALT_ROWS.
    first = shared.groupBy(F.col("hash").alias("h"), F.col("text").alias("t"), "salts").agg(F.min("key").alias("least"))
    first = first.select("h", "t", "least", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("s"))
    same = (shared["hash"] == first["h"]) & (shared["salt"] == first["s"]) & (shared["text"] == first["t"])
    return shared.join(first, same & (first["least"] < shared["key"]), "left_semi").select("key", "hash").distinct()


def failures(df: DataFrame, key: str, text: str, part: str, filters: Mapping[str, Column], duplicate: str) -> DataFrame:
    """(key, part, bits, n): how many rows of a key and part fail exactly the filters in ``bits``.

    ``filters`` maps a letter to a condition over ``text`` (never null there) and its ``words``; ``duplicate`` is
    the letter of the duplicate filter. Bit i of ``bits`` belongs to the i-th letter of ``letters``.
    """
    names = letters(filters, duplicate)
    bits = F.lit(0)
    for name, failing in filters.items():
        bits = bits.bitwiseOR(F.when(failing, F.lit(1 << names.index(name))).otherwise(0))
    docs = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                     F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    docs = docs.withColumn("hash", F.xxhash64("text"))
    own = (docs.withColumn("words", words(F.col("text"))).select("key", "hash", "part", bits.alias("bits"))
           .groupBy("key", "hash", "part", "bits").agg(F.count("*").alias("n")))
    unkeyed = own.where("key IS NULL").select("key", "part", "bits", "n")
    keyed = docs.where("key IS NOT NULL")
    again = duplicate_keys(keyed.select("key", "hash", "text")).select(
        "key", "hash", F.lit(None).cast("string").alias("part"), F.lit(1 << names.index(duplicate)).alias("bits"), F.lit(0).cast("long").alias("n"))
    united = own.where("key IS NOT NULL").unionByName(again)
    # Rows of one key and text may name several parts: the bit of the join reaches each of them.
    per_key = united.groupBy("key", "hash").agg(
        F.bit_or(F.when(F.col("part").isNull(), F.col("bits")).otherwise(0)).alias("again"),
        F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "bits", "n"))).alias("rows"))
    keyed_rows = per_key.select("key", "again", F.explode("rows").alias("r")).select(
        "key", "r.part", F.col("r.bits").bitwiseOR(F.col("again")).alias("bits"), "r.n")
    return keyed_rows.unionByName(unkeyed)


def letters(filters: Mapping[str, Column], duplicate: str) -> list[str]:
    return sorted([*filters, duplicate])


def combinations(failed: DataFrame, labels: DataFrame, key: str, good: str, toxic: str) -> DataFrame:
    """(part, bits, good, toxic, n): the documents counted by what they fail and how they are labelled."""
    flags = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.coalesce(F.max(F.col(good) == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col(toxic) == 1), F.lit(False)).alias("toxic"))
    # Rows that fail nothing lose nothing under any order: their labels are not looked up.
    lost = failed.where("bits != 0 AND key IS NOT NULL").join(flags, "key", "left")
    marked = lost.select("part", "bits", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    other = failed.where("bits = 0 OR key IS NULL").select("part", "bits", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n")
    return marked.unionByName(other).groupBy("part", "bits", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(combos: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``shapley`` is what the step's filter removes summed over all orders: of k failed filters each comes
    first in the k-th part of the orders.
    """
    steps = []
    for order in permutations(names):
        before = 0
        for i, name in enumerate(order):
            bit = 1 << names.index(name)
            steps.append({"filter_order": "".join(order), "step": i + 1, "bit": bit, "before": before})
            before |= bit
    # One literal, parsed once when the plan is optimised.
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    rows = combos.select("*", F.explode(table).alias("s")).select("part", "bits", "good", "toxic", "n", "s.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    gone = F.col("bits").bitwiseAND(F.col("before")) != 0
    here = hit & ~gone

    def count(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long").alias(name)

    share = F.lit(factorial(len(names))) / F.bit_count("bits")
    return rows.groupBy("part", "filter_order", "step").agg(
        count(~hit & ~gone, "kept"), count(here, "removed"), count(hit & gone, "redundant"),
        count(F.col("bits") == F.col("bit"), "unique_fails"),
        count(here & F.col("good"), "good_lost"), count(here & F.col("toxic"), "toxic_lost"),
        F.sum(F.when(hit, F.col("n") * share.cast("long")).otherwise(0)).cast("long").alias("shapley"))
