"""Dimension payloads: metric metadata and thresholds.

Payloads are DataFrames with a ``payload`` JSON text column (one API response per
row), so many responses parse in parallel. Invalid items are dropped, as the
source contract demands; valid ones are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens import schemas as S

def _envelope(key: str) -> T.StructType:
    """``{key: [item, ...]}`` with every item kept as its raw JSON text."""
    return T.StructType([T.StructField(key, T.ArrayType(T.StringType()))])


def _explode_items(payloads: DataFrame, key: str, col: str = "payload") -> DataFrame:
    """One row per raw item text. ``load_ordinal`` = (response, position in its list) is used for
    last-wins. The response order is the payloads' own ``response_ordinal`` column; payloads without one are
    ordered by their text, so the winner never depends on how they are partitioned."""
    parsed = F.from_json(F.col(col), _envelope(key))[key]
    given = F.col("response_ordinal").cast("bigint") if "response_ordinal" in payloads.columns else F.lit(None).cast("bigint")
    base = payloads.withColumn("_resp", F.struct(given.alias("ordinal"), F.col(col).alias("text")))
    return base.select("_resp", F.posexplode(parsed).alias("_pos", "item")).select(
        F.struct("_resp", "_pos").alias("load_ordinal"), "item"
    )


def _has_key(item: Column, key: str) -> Column:
    return F.array_contains(F.json_object_keys(item), F.lit(key))


def _bad_type(item: Column, key: str, parsed: Column) -> Column:
    """Key present with a non-null value that did not parse into the declared type."""
    return F.get_json_object(item, f"$.{key}").isNotNull() & parsed.isNull()


def parse_metadata(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """``{"metrics":[...]}`` responses -> metadata rows (schema METRIC_METADATA + load_ordinal).

    Required: metric_name, display_name, description, category as non-null values;
    the ``unit`` key must be present (its value may be null); higher_is_better is a
    boolean defaulting to true.
    """
    items = _explode_items(payloads, "metrics", col)
    p = F.from_json("item", S.METRIC_METADATA)
    rows = items.select("load_ordinal", "item", p.alias("m"))
    required = [F.col(f"m.{k}").isNotNull() for k in ("metric_name", "display_name", "description", "category")]
    valid = required[0]
    for r in required[1:]:
        valid = valid & r
    valid = valid & _has_key(F.col("item"), "unit") & ~_bad_type(F.col("item"), "higher_is_better",
                                                                   F.col("m.higher_is_better"))
    return rows.where(F.coalesce(valid, F.lit(False))).select(
        "m.metric_name", "m.display_name", "m.description", "m.unit", "m.category",
        F.coalesce(F.col("m.higher_is_better"), F.lit(True)).alias("higher_is_better"),
        "load_ordinal",
    )


_THRESHOLD_TEXT = T.StructType([
    T.StructField("metric_name", T.StringType()),
    T.StructField("critical_threshold", T.DoubleType()),
    T.StructField("warning_threshold", T.DoubleType()),
    T.StructField("experiment_id", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("updated_by", T.StringType()),
])


def _threshold_rows(payloads: DataFrame, col: str) -> DataFrame:
    items = _explode_items(payloads, "thresholds", col)
    t = F.from_json("item", _THRESHOLD_TEXT)
    rows = items.select("load_ordinal", "item", t.alias("t"))
    ts = F.try_to_timestamp(F.col("t.updated_at"))
    valid = (
        F.col("t.metric_name").isNotNull()
        & F.col("t.critical_threshold").isNotNull()
        & F.col("t.warning_threshold").isNotNull()
        & ts.isNotNull()
        & F.col("t.updated_by").isNotNull()
        & ~_bad_type(F.col("item"), "experiment_id", F.col("t.experiment_id"))
    )
    return rows.select(
        "t.metric_name", "t.critical_threshold", "t.warning_threshold",
        F.nullif(F.col("t.experiment_id"), F.lit("")).alias("experiment_id"),
        ts.alias("updated_at"), "t.updated_by", "load_ordinal",
        F.coalesce(valid, F.lit(False)).alias("_valid"),
    )


def parse_thresholds(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """``{"thresholds":[...]}`` responses -> platform defaults and overrides together.

    ISO-8601 ``updated_at`` (a trailing ``Z`` is accepted); bad items dropped.
    """
    return _threshold_rows(payloads, col).where("_valid").drop("_valid")


def platform_defaults(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """Platform-level rows only. Unlike ``parse_thresholds`` one bad item fails the job."""
    rows = _threshold_rows(payloads, col)
    # The check sits in the filter (first conjunct), so it runs for every item and
    # cannot be pruned away like an unused column.
    all_valid = F.coalesce(
        F.when(~F.col("_valid"), F.raise_error(F.lit("invalid threshold item in platform defaults"))),
        F.lit(True),
    )
    return rows.where(all_valid & F.col("experiment_id").isNull()).drop("_valid")


def dedupe_metadata(meta: DataFrame) -> DataFrame:
    """One row per metric_name: the last one in response order wins."""
    if "load_ordinal" not in meta.columns:
        return meta.dropDuplicates(["metric_name"])
    w = Window.partitionBy("metric_name").orderBy(F.col("load_ordinal").desc())
    return meta.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "load_ordinal")


def latest_thresholds(thr: DataFrame) -> DataFrame:
    """One row per (metric_name, experiment_id or platform): newest ``updated_at`` wins.

    A window groups NULL experiment ids together, so platform rows dedupe as one key.
    """
    order = [F.col("updated_at").desc()]
    if "load_ordinal" in thr.columns:
        order.append(F.col("load_ordinal").desc())
    w = Window.partitionBy("metric_name", "experiment_id").orderBy(*order)
    out = thr.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return out.drop("load_ordinal") if "load_ordinal" in out.columns else out


def metric_lookup(meta: DataFrame, metric_name: str) -> DataFrame:
    """Single-metric lookup; empty when absent."""
    return dedupe_metadata(meta.where(F.col("metric_name") == F.lit(metric_name)))


def list_metrics(meta: DataFrame) -> DataFrame:
    return meta.select("metric_name").distinct()
