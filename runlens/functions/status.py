"""Health-status rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runlens.schemas import CRITICAL, HEALTHY, WARNING


def health_status(value: Column, higher_is_better: Column, critical: Column, warning: Column) -> Column:
    """critical / warning / healthy for one measurement.

    Higher-is-better: below critical -> critical, below warning -> warning.
    Otherwise mirrored with "above". Equality sits on the better side, and a
    missing value (NULL; NaN must be nulled first) compares false -> healthy.
    """
    hib = F.coalesce(higher_is_better, F.lit(True))
    worse_than_critical = F.when(hib, value < critical).otherwise(value > critical)
    worse_than_warning = F.when(hib, value < warning).otherwise(value > warning)
    return (
        F.when(worse_than_critical, F.lit(CRITICAL))
        .when(worse_than_warning, F.lit(WARNING))
        .otherwise(F.lit(HEALTHY))
    )


def threshold_source(override_matched: Column) -> Column:
    return F.when(override_matched, F.lit("experiment")).otherwise(F.lit("platform"))


def run_status(critical_count: Column, warning_count: Column) -> Column:
    """Worst status over a run's metrics, from per-status counts."""
    return (
        F.when(critical_count > 0, F.lit(CRITICAL))
        .when(warning_count > 0, F.lit(WARNING))
        .otherwise(F.lit(HEALTHY))
    )
