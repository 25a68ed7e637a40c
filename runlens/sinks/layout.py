"""Write layout: types and dictionary encoding of text columns from one sketch pass, time-sorted files.

``sketch`` reads a table once and decides per text column how it is stored: bigint, decimal(p, s), double, timestamp or text, and
whether a text column is dictionary-encoded. A type is chosen only if every value comes back as the same
text; ``restore`` does that, so a table can be stored typed and read as it was.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NESTED_SKIP = {"params", "tags", "metadata"}

# Plausibility patterns checked before a cast is attempted.
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUM_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?\s*$"
TS_TEXT = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def first_time_column(df: DataFrame) -> str | None:
    for c in df.columns:
        if "time" in c.lower():
            return c
    return None


def _is_time_name(c: str) -> bool:
    return c.endswith("_time") or c.endswith("_timestamp")


def _candidates(df: DataFrame) -> list[str]:
    """Text columns eligible for inference. Identifiers stay text (``*_id``, run names)."""
    return [c for c, t in df.dtypes
            if t == "string" and c not in NESTED_SKIP and not c.endswith("_id") and c != "run_name"]


def infer_types(df: DataFrame) -> DataFrame:
    """(column_name, inferred_type) for text columns where every non-null value parses and prints as the same text
    (bigint, then double; ``*_time`` / ``*_timestamp`` as timestamps). One aggregate pass over all candidate columns."""
    cols = _candidates(df)
    if not cols:
        return df.sparkSession.range(0).select(F.lit("").alias("column_name"), F.lit("").alias("inferred_type"))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        # A cheap pattern test runs first (short-circuit AND), so the cast - whose
        # failure path is slow - only sees plausible text. A value counts as parsed
        # only when both agree, so the result stays lossless.
        # A value counts only if its text survives the cast and back: 007, 1d, 2.50 or
        # twenty decimals stay text.
        as_int = x.rlike(INT_TEXT) & x.try_cast("bigint").cast("string").eqNullSafe(x)
        # Whole numbers count as double only in a column of their own type: 5 beside 2.5 would come back as 5.0.
        as_num = x.rlike(NUM_TEXT) & x.try_cast("double").cast("string").eqNullSafe(x)
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.count_if(x.isNotNull() & ~as_int).alias(f"b{i}"),
            F.count_if(x.isNotNull() & ~as_num).alias(f"d{i}"),
        ]
        if _is_time_name(c):   # timestamps are only tried on *_time / *_timestamp columns
            as_ts = x.rlike(TS_TEXT) & F.try_to_timestamp(x).isNotNull()
            aggs.append(F.count_if(x.isNotNull() & ~as_ts).alias(f"t{i}"))
    entries = []
    for i, c in enumerate(cols):
        typ = (
            F.when(F.col(f"n{i}") == 0, F.lit("string"))
            .when(F.col(f"b{i}") == 0, F.lit("bigint"))
            .when(F.col(f"d{i}") == 0, F.lit("double"))
        )
        if _is_time_name(c):
            typ = typ.when(F.col(f"t{i}") == 0, F.lit("timestamp"))
        typ = typ.otherwise(F.lit("string"))
        entries.append(F.struct(F.lit(c).alias("column_name"), typ.alias("inferred_type")))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


# A text column is dictionary-encoded below this share and number of distinct values.
DICTIONARY_SHARE, DICTIONARY_VALUES = 0.5, 1000

INT_CANONICAL = r"^(0|-?[1-9][0-9]*)$"
DECIMAL_CANONICAL = r"^-?(0|[1-9][0-9]*)\.[0-9]{1,6}$"     # more digits could print with an exponent
TIME_PARTS = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})([ T])([0-9]{2}:[0-9]{2}:[0-9]{2})(?:\.([0-9]{1,6}))?(Z|[+-][0-9]{2}:[0-9]{2})?$"


@dataclass(frozen=True)
class ColumnLayout:
    """How a text column is stored; ``separator``, ``digits`` and ``suffix`` are those of its timestamps."""

    column_name: str
    inferred_type: str
    dictionary: bool
    separator: str = " "
    digits: int = 0
    suffix: str = ""


def _instant(x):
    """A text timestamp as the number of microseconds its local part would have in UTC."""
    local = F.concat_ws(" ", F.regexp_extract(x, TIME_PARTS, 1), F.regexp_extract(x, TIME_PARTS, 3))
    micros = F.rpad(F.regexp_extract(x, TIME_PARTS, 4), 6, "0").try_cast("bigint")
    return F.unix_micros(F.concat(local, F.lit("Z")).try_cast("timestamp")) + F.coalesce(micros, F.lit(0))


def _offset_us(suffix: str) -> int:
    if suffix in ("", "Z"):
        return 0
    return (1 if suffix[0] == "+" else -1) * (int(suffix[1:3]) * 60 + int(suffix[4:6])) * 60_000_000


def _local_text(micros, layout: ColumnLayout):
    """The text of a local time given as microseconds in UTC, whatever the session's zone."""
    days, rest = F.floor(micros / 86_400_000_000), F.pmod(micros, F.lit(86_400_000_000))
    seconds = F.floor(rest / 1_000_000)
    clock = F.format_string("%02d:%02d:%02d", F.floor(seconds / 3600).cast("int"), F.floor(seconds / 60 % 60).cast("int"), (seconds % 60).cast("int"))
    fraction = F.substring(F.lpad((rest % 1_000_000).cast("string"), 6, "0"), 1, layout.digits)
    point = F.concat(F.lit("."), fraction) if layout.digits else F.lit("")
    return F.concat(F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")).cast("string"), F.lit(layout.separator), clock, point, F.lit(layout.suffix))


def _zone_us(ts):
    """Microseconds that the session's zone is ahead of UTC at an instant."""
    return F.unix_micros(F.concat(ts.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")) - F.unix_micros(ts)


def _is_identifier(c: str) -> bool:
    """Identifiers stay text."""
    return c.endswith("_id") or c == "run_name"


def sketch(df: DataFrame) -> list[ColumnLayout]:
    """The layout of each text column, from one aggregate over ``df`` (one row per column reaches the driver)."""
    cols = [c for c, t in df.dtypes if t == "string" and c not in NESTED_SKIP]
    if not cols:
        return []
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"), F.approx_count_distinct(x, 0.01).alias(f"u{i}")]
        if _is_identifier(c):
            continue
        number = x.rlike(DECIMAL_CANONICAL) & ~x.rlike(r"^-0\.0*$")
        aggs += [
            F.count_if(x.isNotNull() & ~(x.rlike(INT_CANONICAL) & x.try_cast("bigint").isNotNull())).alias(f"int{i}"),
            F.count_if(x.isNotNull() & ~number).alias(f"dec{i}"),
            F.min(F.length(F.regexp_extract(x, r"\.([0-9]+)$", 1))).alias(f"lo{i}"),
            F.max(F.length(F.regexp_extract(x, r"\.([0-9]+)$", 1))).alias(f"hi{i}"),
            F.max(F.length(F.regexp_extract(x, r"^-?([0-9]+)", 1))).alias(f"whole{i}"),
            F.count_if(x.isNotNull() & ~(x.rlike(NUM_TEXT) & x.try_cast("double").cast("string").eqNullSafe(x))).alias(f"dbl{i}"),
        ]
        if _is_time_name(c):
            shape = F.when(x.rlike(TIME_PARTS), F.struct(
                F.regexp_extract(x, TIME_PARTS, 2).alias("separator"), F.length(F.regexp_extract(x, TIME_PARTS, 4)).alias("digits"),
                F.regexp_extract(x, TIME_PARTS, 5).alias("suffix")))
            plain = x.try_cast("timestamp")
            # Without an offset the text is a time of the session's zone; hours that the zone skips do not come back.
            shifted = (F.regexp_extract(x, TIME_PARTS, 5) == "") & (F.unix_micros(plain) + _zone_us(plain) != _instant(x))
            aggs += [F.count_if(x.isNotNull() & (shape.isNull() | _instant(x).isNull() | plain.isNull() | shifted)).alias(f"ts{i}"),
                     F.min(shape).alias(f"first{i}"), F.max(shape).alias(f"last{i}")]
    r = df.agg(*aggs).first()
    return [_decide(r, i, c) for i, c in enumerate(cols)]


def _decide(r, i: int, column: str) -> ColumnLayout:
    few = bool(r["rows"]) and r[f"u{i}"] < DICTIONARY_SHARE * r["rows"] and r[f"u{i}"] < DICTIONARY_VALUES
    if _is_identifier(column) or not r[f"n{i}"]:
        return ColumnLayout(column, "string", few)
    if not r[f"int{i}"]:
        return ColumnLayout(column, "bigint", False)
    if not r[f"dec{i}"] and r[f"lo{i}"] == r[f"hi{i}"] and r[f"whole{i}"] + r[f"hi{i}"] <= 38:
        return ColumnLayout(column, f"decimal({r[f'whole{i}'] + r[f'hi{i}']},{r[f'hi{i}']})", False)
    if not r[f"dbl{i}"]:
        return ColumnLayout(column, "double", False)
    if _is_time_name(column) and not r[f"ts{i}"] and r[f"first{i}"] == r[f"last{i}"]:
        return ColumnLayout(column, "timestamp", False, **r[f"first{i}"].asDict())
    return ColumnLayout(column, "string", few)


def stored_types(df: DataFrame, layouts: list[ColumnLayout]) -> DataFrame:
    """``df`` with each text column in its stored type."""
    return df.withColumns({x.column_name: F.col(f"`{x.column_name}`").cast(x.inferred_type) for x in layouts if x.inferred_type != "string"})


def restore(df: DataFrame, layouts: list[ColumnLayout]) -> DataFrame:
    """The text columns as they were before ``stored_types``."""
    def text(x: ColumnLayout):
        c = F.col(f"`{x.column_name}`")
        if x.inferred_type != "timestamp":
            return c.cast("string")
        return _local_text(F.unix_micros(c) + (_zone_us(c) if not x.suffix else F.lit(_offset_us(x.suffix))), x)

    return df.withColumns({x.column_name: text(x) for x in layouts if x.inferred_type != "string"})


def writer_options(layouts: list[ColumnLayout]) -> dict[str, str]:
    """Parquet options that leave text columns of many values plain."""
    return {f"parquet.enable.dictionary#{x.column_name}": str(x.dictionary).lower() for x in layouts if x.inferred_type == "string"}


def as_records(layouts: list[ColumnLayout]) -> list[dict]:
    return [asdict(x) for x in layouts]
