"""SimHash near-duplicates with pivot distance tables (operator 7).

Fingerprint: a bit is 1 if it is set in over half of the 64-bit hashes of a text's word shingles.
Equal fingerprints are one class, so copies cost one row from there on.

Links (``max_bits`` or fewer differing bits) among distinct fingerprints:

1. Rows that can be linked meet in a bucket. Of ``max_bits + 2`` blocks of the 64 bits, a linked pair
   leaves at least two untouched, so it agrees on both blocks of one of the pairs of blocks. A bucket
   is (mask, value): the bits that agree and their value.
2. A bucket with more than ``bucket_rows`` fingerprints is refined: the bits its mask leaves
   free are split in ``max_bits + 1`` groups, and a linked pair agrees on one of them. This
   repeats while a bucket is too large, until so few bits are free that no bucket
   can exceed ``bucket_rows``. Nothing is dropped: every linked pair shares a bucket at every level.
3. Inside a bucket the pivot table decides: the distances to ``PIVOTS`` reference fingerprints are
   precomputed; by the triangle inequality a pair whose coordinates differ by more than ``max_bits`` anywhere
   is no link. Rows are sorted by the first coordinate, so only a window of it is compared; what all
   coordinates leave is verified on the fingerprints. A bucket returns a spanning forest of its links, not its pairs.
4. Components: least-label propagation with pointer jumping over the forest edges, as Spark joins.

Defined cases: null and empty texts (or no word) have fingerprint 0, linked like any other; a text with fewer
words than the shingle length has one shingle; rows with equal keys are separate rows; ``component_id`` is the least
non-null key reachable (null if there is none); an empty table gives an empty table; columns of the
input named like the added ones are replaced. Texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import as_row, cut, from_row, join_classes

SEED = 42
PIVOTS = 16
ALL = (1 << 64) - 1


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the ``width``-word shingles of one text, as an unsigned number.

    ``bytes.lower`` lower-cases A-Z only and ``bytes.split`` splits at the six ASCII white-space characters.
    """
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    if len(ws) <= width:
        shingles = [b" ".join(ws)]
    else:
        shingles = map(b" ".join, zip(*[ws[i:] for i in range(width)]))
    h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    n = len(h)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # whole text, in slices of bounded memory
        part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(df: DataFrame, key: str, text: str, width: int = 3) -> DataFrame:
    """(key, fp): fp is the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return df.select(F.col(key).alias("key"), fp(F.col(text)).alias("fp"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _split(mask: int, parts: int) -> list[int]:
    """The set bits of a mask in ``parts`` groups of nearly equal size."""
    bits = [b for b in range(64) if mask >> b & 1]
    cuts = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def first_masks(max_bits: int) -> list[int]:
    blocks = _split(ALL, max_bits + 2)
    return [a | b for a, b in combinations(blocks, 2)]


def refined(masks: list[int], max_bits: int) -> dict[int, list[int]]:
    return {m: [m | g for g in _split(ALL & ~m, max_bits + 1)] for m in masks}


def pivot_values(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of the numbers 0..n-1."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), SEED) for i in range(n)], np.uint64)


def forest(fps: np.ndarray, max_bits: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """Edges (positions) of a spanning forest of the links among distinct fingerprints."""
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    ends = np.searchsorted(table[:, 0], table[:, 0] + max_bits, side="right")
    parent = np.arange(len(fps))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for i, end in enumerate(ends):
        j = np.arange(i + 1, end)
        for c in range(1, table.shape[1]):  # each coordinate discards about half of what is left
            if not len(j):
                break
            j = j[np.abs(table[j, c] - table[i, c]) <= max_bits]
        if len(j):
            j = j[np.bitwise_count(fps[j] ^ fps[i]) <= max_bits]
        for k in j:
            a, b = root(i), root(int(k))
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((int(order[i]), int(order[k])))
    return edges


def links(distinct: DataFrame, max_bits: int = 3, bucket_rows: int = 4096) -> DataFrame:
    """(a, b): edges that connect exactly the linked ones among distinct fingerprints ``fp``."""
    pivots = pivot_values()

    def in_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for members in batch["fps"]:
                own = np.asarray(members, np.int64)
                for i, j in forest(own.view(np.uint64), max_bits, pivots):
                    a.append(own[i])
                    b.append(own[j])
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    masks = first_masks(max_bits)
    found = []
    rows = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("val"))
        sizes = rows.groupBy("mask", "val").agg(F.count("*").alias("n")).where("n > 1")
        shared = rows.join(sizes, ["mask", "val"])
        last = all(1 << (64 - m.bit_count()) <= bucket_rows for m in masks)
        # At the last level the free bits bound every bucket.
        small = shared if last else shared.where(F.col("n") <= bucket_rows)
        members = small.groupBy("mask", "val").agg(F.collect_list("fp").alias("fps")).select("fps")
        found.append(members.mapInPandas(in_buckets, "a long, b long"))
        if last:
            break
        large = cut(shared.where(F.col("n") > bucket_rows).select("fp", "mask"), "simhash-large")
        if large.isEmpty():
            break
        finer = refined(masks, max_bits)
        table = F.create_map(*[x for m, ms in finer.items()
                               for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(y)) for y in ms]))])
        rows = large.select("fp", F.explode(table[F.col("mask")]).alias("mask"))
        masks = [y for ms in finer.values() for y in ms]
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges.distinct()


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(v, label): label is the least vertex of the component of each vertex of ``edges`` (a, b).

    Each round: a vertex takes the least label of its neighbours, then the label of its label
    (pointer jumping), until nothing changes.
    """
    both = cut(edges.select(F.col("a").alias("v"), F.col("b").alias("u"))
               .unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u"))), "components-edges")
    labels = cut(both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("label")), "components-labels")
    for _ in range(rounds):
        seen = both.join(labels.select(F.col("v").alias("u"), F.col("label").alias("theirs")), "u")
        least = seen.groupBy("v").agg(F.min("theirs").alias("theirs"))
        hooked = labels.join(least, "v").select("v", F.col("label").alias("old"), F.least("label", "theirs").alias("label"))
        target = labels.select(F.col("v").alias("label"), F.col("label").alias("jump"))
        jumped = hooked.join(target, "label", "left").select("v", F.least("label", "jump").alias("label"), "old")
        after = cut(jumped, "components-labels")
        if after.where(F.col("label") != F.col("old")).isEmpty():
            return after.select("v", "label")
        labels = after.select("v", "label")
    raise RuntimeError("components did not settle")


def near_duplicates(df: DataFrame, key: str, text: str, width: int = 3, max_bits: int = 3,
                    bucket_rows: int = 4096) -> DataFrame:
    """One row per input row: key, ``fp`` (signed long), ``component_id`` (least key of its group)."""
    fps = cut(fingerprints(df, key, text, width), "simhash-fingerprints")
    classes = cut(fps.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("copies")), "simhash-classes")
    edges = links(classes.select("fp"), max_bits, bucket_rows)
    labels = components(edges)
    grouped = classes.join(labels, classes["fp"] == labels["v"]).select("fp", "label", "least")
    # Only linked fingerprints have a label; the others are groups of their own.
    roots = grouped.groupBy("label").agg(F.min("least").alias("root"))
    linked = grouped.join(roots, "label").select("fp", "root", F.lit(True).alias("linked"))
    ids = classes.join(linked, "fp", "left").select(
        "fp", "copies", F.when(F.col("linked"), F.col("root")).otherwise(F.col("least")).alias("component_id"))
    found = join_classes(fps, cut(ids, "simhash-ids"), "fp", "copies")
    return found.select(F.col("key").alias(key), "fp", "component_id")


def hex_fingerprint(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(df: DataFrame, key: str, text: str, width: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each near-duplicate group: the one with the least (key, other columns), null keys last.

    Rows are told apart by a digest of all their columns; of rows equal throughout one is kept.
    """
    rows = as_row(df).select("row", F.md5(F.to_json(F.col("row"), {"ignoreNullFields": "false"}).cast("binary")).alias("digest"))
    # The digest, prefixed so that its order is (key, other columns), is the operator's key.
    k = F.col("row").getField(key)
    place = F.struct(k.isNull().alias("none"), k.alias("key"), F.col("digest").alias("digest"))
    keyed = rows.select("row", place.alias("place"))
    groups = near_duplicates(keyed.select("place", F.col("row").getField(text).alias("text")), "place", "text", width, max_bits)
    first = groups.select(F.col("component_id.digest").alias("digest")).distinct()
    kept = keyed.join(first, F.col("place.digest") == F.col("digest"), "left_semi")
    once = kept.withColumn("n", F.row_number().over(Window.partitionBy("place.digest").orderBy("place.digest")))
    return from_row(once.where("n = 1"))
