"""Map-column helpers (params / tags)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_keys(m: Column) -> Column:
    """Lower-case map keys; on a case collision the later entry wins; NULL stays NULL.

    Written without ``transform_keys`` (which raises on duplicate keys) so it
    does not depend on the session's map-key dedup policy.
    """
    keys = F.array_distinct(F.transform(F.map_keys(m), lambda k: F.lower(k)))
    values = F.transform(
        keys,
        lambda k: F.element_at(F.filter(F.map_entries(m), lambda e: F.lower(e["key"]) == k), -1)["value"],
    )
    return F.when(m.isNull(), F.lit(None)).otherwise(F.map_from_arrays(keys, values))


def key_params_json(params_lower: Column) -> Column:
    """``{}`` for NULL params, else ``{"model": <value or 'unknown'>}``."""
    model = F.coalesce(F.try_element_at(params_lower, F.lit("model")), F.lit("unknown"))
    return F.when(params_lower.isNull(), F.lit("{}")).otherwise(F.to_json(F.struct(model.alias("model"))))
