"""Dimension joins with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when its rows are proven to take at most this many bytes.
BROADCAST_MAX_BYTES = 8 * 1024 * 1024
# ... and it has at most this many rows, so the check itself reads a bounded part.
BROADCAST_MAX_ROWS = 200_000


def _row_bytes(dim: DataFrame):
    """Bytes of a row as text plus a fixed share per column: an upper estimate of its size in a join table."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in dim.columns]))
    return F.octet_length(row) + F.lit(16 + 16 * len(dim.columns))


def sized_side(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast-hinted ``dim`` when it provably holds at most ``max_rows`` rows and ``max_bytes`` bytes, else ``dim`` as is.

    The check reads at most ``max_rows + 1`` rows and is made anew at every call, so a side that has grown is
    seen. Beyond the bounds the join stays a shuffle join, which AQE may still convert (runtime size)
    or split (skew join). For dimensions read from storage; sides that a query derives are left to AQE.
    """
    head = dim.limit(max_rows + 1)
    size = head.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(head)), F.lit(0)).alias("b")).first()
    return F.broadcast(dim) if size["n"] <= max_rows and size["b"] <= max_bytes else dim


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    return fact.join(sized_side(dim, max_rows, max_bytes), on, how)
