"""Threshold rules compiled into one projection (operator 4).

``RULES`` is a table: a named ratio of the text, a lower and an upper bound. ``ratios`` gives the
expressions, ``compile_rules`` turns the table into columns; there is no user function, so
no shuffle either and the plan is scan -> project.

Defined cases: a null text counts as empty; a text without words has ratios 0 and fails the
base rule; repeated rows are judged alike; an empty table gives an empty table; input columns named like the
added ones are replaced. Very long texts are processed whole: the repeated-window count sorts the windows
of one text, n log n in its words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import as_row, from_row, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages the rules cover.
STOP_WORDS = (
    "the of and to in is that it for on with as was be by this are from at or have not which "
    "der die das und von zu den mit ist im für auf ein eine nicht "
    "de la le les des et un une que qui dans pour sur par en du est "
    "el los las y del se al lo su para con por no"
).split()


@dataclass(frozen=True)
class Rule:
    name: str
    ratio: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word_length", "mean_word_length", 2.0, 12.0),
    Rule("symbols", "symbol_ratio", None, 0.05),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("capitals", "capital_ratio", None, 0.6),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.5),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _line_with_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _windows(ws: Column, n: Column, of, width: int = 3) -> Column:
    """``of`` (start, words) each run of ``width`` words of a text."""
    return F.transform(F.sequence(F.lit(0), n - width), lambda i: of(i, [F.get(ws, i + j) for j in range(width)]))


# A window's start takes the low bits of a packed number, its hash the others.
START_BITS = 24


def _same(key, a: Column, b: Column) -> Column:
    """Equal keys; a place beside the array has none."""
    return (key(a) == key(b)).eqNullSafe(F.lit(True))


def _twice(s: Column, key) -> Column:
    """Of an array sorted by key, the elements that share it with a neighbour."""
    return F.filter(s, lambda x, i: _same(key, x, F.get(s, i - 1)) | _same(key, x, F.get(s, i + 1)))


def _chars_of(t: Column, kind: str) -> Column:
    """How many characters of a kind: what the text loses without its runs of them."""
    return (F.char_length(t) - F.char_length(F.regexp_replace(t, f"{kind}+", ""))).cast("long")


def measures(text: Column) -> list[tuple[str, Column]]:
    """First projection: arrays and plain counts of one text."""
    t = F.coalesce(text, F.lit(""))
    return [
        ("__w", words(t)),
        ("__lines", F.filter(F.split(t, "\n"), _line_with_word)),
        ("n_symbols", F.regexp_count(t, F.lit("[" + SYMBOLS.replace("|", r"\|") + "]")).cast("long")),
        ("__upper", _chars_of(t, r"\p{Lu}")),
        ("__letters", _chars_of(t, r"\p{L}")),
    ]


def apply_rules(df: DataFrame, text: str, rules=RULES) -> DataFrame:
    """``df`` with the base counts, the ratios, one boolean per rule (``ok_<name>``), ``base_failed``
    and ``kept``."""
    d = as_row(df)
    t = F.col("row").getField(text)
    d = d.select("row", *[c.alias(n) for n, c in measures(t)])
    d = d.withColumn("n_words", F.size("__w").cast("long"))
    d = d.select(
        "*",
        F.when(F.col("n_words") >= 3, _windows(F.col("__w"), F.col("n_words").cast("int"), lambda i, ws: F.xxhash64(*ws)))
        .otherwise(F.array().cast("array<bigint>")).alias("__hashes"),
        F.char_length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__lines").cast("long").alias("__n_lines"),
        F.size(F.filter("__w", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("__stops"),
    )
    # Where a hash occurs twice at all, the windows are sorted as plain numbers, hash before start: equal windows
    # are neighbours. Neighbours with equal hash bits but other words, or a text with too many words for the bits, send
    # the text to a sort by the windows themselves, so the count is exact.
    low = F.lit((1 << START_BITS) - 1)
    none = F.array().cast("array<bigint>")
    packed = F.sort_array(F.transform("__hashes", lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))
    d = d.withColumn("__packed", F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), packed).otherwise(none))
    d = d.withColumn("__near", _twice(F.col("__packed"), lambda x: F.shiftright(x, START_BITS)))
    near, ws = F.col("__near"), F.col("__w")

    def other_words(x: Column, y: Column) -> Column:
        p, q = (v.bitwiseAND(low).cast("int") for v in (x, y))
        differ = F.get(ws, p) != F.get(ws, q)
        for j in (1, 2):
            differ = differ | (F.get(ws, p + j) != F.get(ws, q + j))
        return _same(lambda v: F.shiftright(v, START_BITS), x, y) & differ

    mixed = F.exists(F.transform(near, lambda x, i: F.coalesce(other_words(x, F.get(near, i - 1)), F.lit(False))), lambda b: b)
    by_words = F.array_sort(_windows(ws, F.col("n_words").cast("int"), lambda i, w: F.struct(F.concat_ws(" ", *w).alias("g"), i.alias("i"))))
    d = d.withColumn("__sorted", F.when((F.col("n_words") >= 3) & (mixed | (F.col("n_words") > low)), by_words))
    d = d.withColumn("__starts", F.sort_array(F.coalesce(
        F.transform(_twice(F.col("__sorted"), lambda x: x["g"]), lambda x: x["i"]),
        F.transform(near, lambda x: x.bitwiseAND(low).cast("int")))))
    st = F.col("__starts")
    covered = F.aggregate(
        F.transform(st, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(st, i + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, b: a + b)
    d = d.withColumn("n_repeat_words", covered.cast("long"))

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    d = d.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word_length"),
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("__stops", "n_words").alias("stop_word_ratio"),
        ratio("__upper", "__letters").alias("capital_ratio"),
        ratio("n_dup_lines", "__n_lines").alias("dup_line_ratio"),
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
    )
    checks = compile_rules(rules)
    d = d.select("*", *[c.alias(f"ok_{n}") for n, c in checks])
    verdict = ~F.col("base_failed")
    for n, _ in checks:
        verdict = verdict & F.col(f"ok_{n}")
    d = d.withColumn("kept", verdict)
    out = from_row(d, *BASE, *RATIOS, *[f"ok_{n}" for n, _ in checks], "base_failed", "kept")
    # A caller's filter on these columns stays above the generator; pushed further down it
    # would repeat the array expressions inside one another.
    return out.select(F.inline(F.array(F.struct(*[out[f"`{c}`"] for c in out.columns]))))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("mean_word_length", "symbol_ratio", "stop_word_ratio", "capital_ratio", "dup_line_ratio")


def compile_rules(rules) -> list[tuple[str, Column]]:
    """The threshold table as boolean columns over the ratios."""
    out = []
    for r in rules:
        c = F.lit(True)
        if r.low is not None:
            c = c & (F.col(r.ratio) >= r.low)
        if r.high is not None:
            c = c & (F.col(r.ratio) <= r.high)
        out.append((r.name, c))
    return out
