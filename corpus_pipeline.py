"""The corpus pipeline: quality rules, SimHash near-dedup, decontamination, mixing, sharding.

``STAGES`` holds (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
``run`` writes each stage's rows as Parquet in the shared folder and reads them back as the next one's docs.
All but the last return the columns of documents; the last adds ``shard`` and ``slot``.

Cases: a null or empty text has no words, so the quality rules reject it; documents without an id count as
one id each (a near-duplicate group keeps one of them if it holds no id); an empty table stays empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runlens.llm.common import cut, read
from runlens.llm.decontaminate import find_matches
from runlens.llm.mixing import mix, repeat_copies
from runlens.llm.quality_rules import apply_rules
from runlens.llm.queries import SHARDS
from runlens.llm.sharding import assign_shards
from runlens.llm.simhash import keep_one

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return apply_rules(docs.select(*COLUMNS), "text").where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (least doc_id) of each group of linked fingerprints."""
    return keep_one(docs.select(*COLUMNS), "doc_id", "text")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    judged = find_matches(docs.select(*COLUMNS), "text", read(spark, sf_dir, "benchmark"))
    return judged.where("not contaminated").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0, 1 or 2 times)."""
    return repeat_copies(mix(docs.select(*COLUMNS), "doc_id", "text", "source"), COLUMNS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it."""
    return assign_shards(docs.select(*COLUMNS), "doc_id", SHARDS)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# The fingerprints, the alignment and the Newton iterations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
