"""Statistics helpers with explicit NULL / NaN semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """NaN is 'missing' in the source model; Spark would order it above every number."""
    return F.nanvl(c, F.lit(None).cast("double"))


def epoch_seconds(ts: Column) -> Column:
    """Fractional epoch seconds of a timestamp."""
    return F.unix_micros(ts) / F.lit(1e6)


def safe_corr(y: Column, x: Column) -> Column:
    """Pearson correlation that is NULL (not an error) for n = 1 or a constant side."""
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def latest_non_null(value: Column, *order: Column) -> Column:
    """Value at the greatest ``order`` among rows where value is not NULL.

    Rows with a NULL value get a NULL ordering key and are skipped by max_by;
    the extra order columns are a deterministic tie-break.
    """
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))


def round6(c: Column) -> Column:
    """Presentation rounding used when comparing doubles across engines."""
    return F.round(c + F.lit(1e-9), 6)


def one_decimal(x: Column) -> Column:
    """A value of 0 or more rounded to tenths by its exact binary value, exact halves to even (0.35 is below its half: 0.3)."""
    whole = x.try_cast("bigint")
    ten = ((x - whole) * F.lit(float(1 << 58))).try_cast("bigint") * 10     # tenths, as multiples of 2 ** -58
    tenths, rest, half = F.shiftright(ten, 58), ten.bitwiseAND(F.lit((1 << 58) - 1)), F.lit(1 << 57)
    up = (rest > half) | ((rest == half) & (tenths % 2 == 1))
    return (whole * 10 + tenths + up.cast("int")) / F.lit(10.0)
