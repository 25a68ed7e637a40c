"""Mixing sources to target weights by entropy balancing (operator 8, native).

Targets: every source gets a share of ``total`` times all tokens by weight, never more than ``cap``
times its own tokens; what a capped source leaves is shared anew among the others.

Rates: among all document rates r with sum(size * r) = target per source, the ones nearest to
"each document once" in relative entropy are ``r = min(cap, exp(lambda * size / mean size))``.
lambda is the source's dual variable: Newton steps on the convex dual, kept inside a
bracket, for all sources at once. One iteration is one aggregate over the histogram
(source, size) -> documents, since documents of one source and size share a rate; the
documents themselves are aggregated once, whatever the number of iterations.

Copies: each (source, size) class gets a whole number of copies by cumulative rounding in size
order, which keeps every prefix within half a copy of its rate; the rest of a source is then
moved by whole copies of the largest class that fits. Inside a class the extra copies go to
the first documents in digest order (numbered in hash buckets, so one hot class is split).

All sums that decide something are exact (decimals), so reruns agree whatever the task order.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
documents of size 0 get one copy, or ``cap`` where their source's target is at the cap, and
take no words; equal documents are interchangeable; an empty table gives an empty table; columns
of the input named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import as_row, bucket_of, bucket_offsets, cut, from_row, n_words

UNIT = 2**30          # fixed-point unit of a rate
MAX_STEP = 4.0        # longest Newton step of a lambda
TOLERANCE = 1e-9
ITERATIONS = 60       # bracket halving alone reaches the tolerance in fewer
POLISH_ROUNDS = 12


def targets(sources: DataFrame, weights: Sequence[float], total: float, cap: float) -> DataFrame:
    """(src, has_source, source_size) -> the same with weight and target.

    Water filling: with ratio = cap * size / weight ascending, the first source whose ratio exceeds
    what is left per unit of weight, and all after it, are not capped. One row per source.
    """
    by_code_point = Window.orderBy(F.col("is_null"), "src")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sources.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_code_point) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("ratio", F.lit(float(cap)) * F.col("source_size") / F.col("weight"))
    order = Window.orderBy("ratio", "is_null", "src")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*",
        (F.lit(float(total)) * F.sum("source_size").over(everything)
         - F.lit(float(cap)) * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left_over"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_left"),
    )
    # Along the order that quotient rises up to the first uncapped source and falls after it.
    level = F.max(F.when(F.col("ratio") > F.col("left_over") / F.col("weight_left"),
                         F.col("left_over") / F.col("weight_left"))).over(everything)
    # Where nothing is left uncapped there is no level and every source is at its cap.
    s = s.withColumn("level", level)
    target = F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.lit(float(cap)) * F.col("source_size")) \
        .otherwise(F.col("level") * F.col("weight"))
    return s.select("src", "is_null", "source_size", "weight", target.alias("target"))


def _exact(c) -> F.Column:
    return F.sum(F.round(c * F.lit(1e6)).cast("decimal(38,0)")).cast("double") / F.lit(1e6)


def _balance(hist: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """(sid, lambda, whole) per source: ``whole`` marks a target at the cap."""
    nothing = F.lit(None).cast("double")
    state = sources.select(
        "sid", "target", "mean_size", F.lit(0.0).alias("lam"), nothing.alias("lo"), nothing.alias("hi"),
        (F.col("target") >= F.lit(cap * (1 - 1e-12)) * F.col("source_size")).alias("whole"),
        (F.col("source_size") == 0).alias("done"))
    state = cut(state.withColumn("done", F.col("done") | F.col("whole")), "mixing-state")
    for _ in range(ITERATIONS):
        if state.where(~F.col("done")).isEmpty():
            break
        z = F.col("size") / F.col("mean_size")
        rate = F.exp(F.col("lam") * z)
        free = rate < cap
        mass = F.col("n") * F.col("size")
        sums = (hist.join(state.where(~F.col("done")), "sid")
                .groupBy("sid").agg(_exact(mass * F.least(rate, F.lit(float(cap)))).alias("f"),
                                    _exact(F.when(free, mass * z * rate).otherwise(0.0)).alias("df")))
        t = state.join(sums, "sid", "left")
        f, df, lam = F.col("f"), F.col("df"), F.col("lam")
        lo = F.when(f < F.col("target"), F.greatest("lo", "lam")).otherwise(F.col("lo"))
        hi = F.when(f > F.col("target"), F.least("hi", "lam")).otherwise(F.col("hi"))
        t = t.withColumn("lo", lo).withColumn("hi", hi)
        # Newton on log(f / target): the same root as the dual's gradient f - target.
        step = F.log(F.greatest(f, F.lit(1e-6)) / F.col("target")) * f / df
        newton = lam - F.greatest(F.lit(-MAX_STEP), F.least(F.lit(MAX_STEP), step))
        inside = (df > 0) & (newton > F.coalesce("lo", F.lit(-1e300))) & (newton < F.coalesce("hi", F.lit(1e300)))
        middle = F.coalesce((F.col("lo") + F.col("hi")) / 2, F.col("hi") - MAX_STEP, F.col("lo") + MAX_STEP)
        reached = F.abs(f / F.col("target") - 1) < TOLERANCE
        pinched = (F.col("hi") - F.col("lo")) < 1e-14 * F.greatest(F.abs("lo"), F.abs("hi"))
        over = F.col("done") | F.coalesce(reached, F.lit(False)) | F.coalesce(pinched, F.lit(False))
        state = cut(t.select("sid", "target", "mean_size",
                             F.when(over, lam).when(inside, newton).otherwise(middle).alias("lam"),
                             "lo", "hi", "whole", over.alias("done")), "mixing-state")
    return state.select("sid", "lam", "whole")


def _copies_per_class(hist: DataFrame, sources: DataFrame, duals: DataFrame, cap: int) -> DataFrame:
    """(sid, size, n, rate, total): ``total`` copies among the n documents of a class."""
    c = hist.join(sources.select("sid", "mean_size", "target"), "sid").join(duals, "sid")
    rate = F.when(F.col("whole"), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size") / F.greatest(F.col("mean_size"), F.lit(1e-300)))))
    c = c.withColumn("rate", rate)
    share = (F.col("n").cast("decimal(38,0)") * F.round(F.col("rate") * F.lit(float(UNIT))).cast("decimal(18,0)"))
    after = F.sum(share).over(Window.partitionBy("sid").orderBy("size"))
    c = c.withColumn("share", share.cast("decimal(38,0)")).withColumn("after", after.cast("decimal(38,0)"))
    half = F.lit(UNIT // 2)

    def whole(x):
        return F.floor((x + half) / F.lit(UNIT).cast("decimal(18,0)")).cast("long")

    c = c.select("sid", "size", "n", "rate", "target", (whole(F.col("after")) - whole(F.col("after") - F.col("share"))).alias("total"))
    c = cut(c, "mixing-classes")
    for _ in range(POLISH_ROUNDS):
        rest = c.groupBy("sid").agg((F.first("target") - F.sum(F.col("total") * F.col("size"))).alias("rest"))
        # The largest class whose size fits into what is missing (or too much) and that has room for it.
        fits = c.join(rest, "sid").where(
            (F.col("size") > 0) & (F.col("size") <= F.abs("rest"))
            & F.when(F.col("rest") > 0, F.col("total") < cap * F.col("n")).otherwise(F.col("total") > 0))
        moves = fits.groupBy("sid").agg(F.max("size").alias("size"), F.first("rest").alias("rest"))
        moves = cut(moves, "mixing-moves")
        if moves.isEmpty():
            break
        wanted = F.floor(F.abs("rest") / F.col("size"))
        moved = F.when(F.col("rest") > 0, F.least(wanted, cap * F.col("n") - F.col("total"))) \
            .when(F.col("rest") < 0, -F.least(wanted, F.col("total"))).otherwise(0)
        c = cut(c.join(moves, ["sid", "size"], "left")
                .withColumn("total", (F.col("total") + moved).cast("long")).drop("rest"), "mixing-classes")
    return c


def mix(df: DataFrame, key: str, text: str, source: str, weights: Sequence[float] = (5, 2, 1),
        total: float = 1.5, cap: int = 2, bucket_digits: int = 3, size: str | None = None) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` (0..cap) per row.

    ``size`` names an input column that already holds the words of each document.
    """
    rows = as_row(df)
    r = F.col("row")
    # Rows of one class are told apart by key and text: null or equal keys keep the same copies on every run.
    told = F.struct(r.getField(key).alias("k"), *([] if size else [r.getField(text).alias("t")]))
    digest = F.md5(F.to_json(told, {"ignoreNullFields": "false"}).cast("binary"))
    rows = rows.select("row", r.getField(source).alias("src"), digest.alias("__digest"),
                       (r.getField(size).cast("long") if size else n_words(r.getField(text))).alias("size"))
    rows = rows.withColumn("__bucket", bucket_of(F.col("__digest"), bucket_digits))
    # One row per (source, size, bucket): everything but the last step works on this count.
    fine = cut(rows.groupBy("src", "size", "__bucket").agg(F.count("*").alias("n")), "mixing-histogram")
    sources = fine.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    sources = sources.withColumn("is_null", F.col("src").isNull())
    wanted = targets(sources, weights, total, cap)
    sources = cut(wanted.join(sources.select(F.col("src").alias("s2"), "docs"), F.col("src").eqNullSafe(F.col("s2"))).select(
        "src", "is_null", "source_size", "target", (F.col("source_size") / F.col("docs")).alias("mean_size"),
        F.row_number().over(Window.orderBy("is_null", "src")).alias("sid")), "mixing-sources")
    named = sources.select(F.col("src").alias("s2"), "sid")
    fine = cut(fine.join(named, F.col("src").eqNullSafe(F.col("s2"))).select("sid", "size", "__bucket", "n"), "mixing-fine")
    hist = cut(fine.groupBy("sid", "size").agg(F.sum("n").alias("n")), "mixing-hist")
    classes = _copies_per_class(hist, sources, _balance(hist, sources, float(cap)), cap)
    before = F.sum("n").over(Window.partitionBy("sid", "size").orderBy("__bucket")) - F.col("n")
    spots = (fine.select("sid", "size", "__bucket", before.alias("__before"))
             .join(classes.select("sid", "size", F.col("n").alias("docs"), "rate", "total"), ["sid", "size"])
             .join(sources.select("sid", "src", "source_size", "target"), "sid")
             .select(F.col("src").alias("s2"), F.col("size").alias("z2"), F.col("__bucket").alias("b2"),
                     "__before", "docs", "rate", "total", "source_size", "target"))
    here = F.row_number().over(Window.partitionBy("src", "size", "__bucket").orderBy("__digest")) - 1
    ranked = rows.withColumn("__here", here).join(
        spots, F.col("src").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")) & (F.col("__bucket") == F.col("b2")))
    each = F.floor(F.col("total") / F.col("docs"))
    copies = each + F.when(F.col("__before") + F.col("__here") < F.col("total") - each * F.col("docs"), 1).otherwise(0)
    return from_row(ranked.withColumn("copies", copies.cast("int")), "size", "source_size", "target", "rate", "copies")


def repeat_copies(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each row as often as ``copies`` says, with ``columns`` only."""
    return mixed.where(F.col("copies") > 0).select(
        *columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")).select(*columns)
