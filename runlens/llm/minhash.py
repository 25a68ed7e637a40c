"""HyperMinHash near-duplicates (operator 12).

Two documents are linked if their sets of distinct ``width``-word shingles have a Jaccard similarity of at least
``percent`` / 100; groups are the connected components of the links.

Sketch: each shingle hash names a bucket; of the least value of a bucket its register keeps the leading-zero count and
``MANTISSA`` following bits (16 bits in all). ``ROWS`` neighbouring registers are one band, and its compressed registers are a band key.

Candidates share a band key. The number of bands follows the set size: linked sets differ in at most ``spread`` of their
shingles, each of which can change one band, so up to ``WIDEST`` bands there are more bands than differing shingles and some band is equal. Sets of
neighbouring size classes carry the keys of both. Larger sets have ``WIDEST`` bands: at exactly the threshold all
of them differ with probability (1 - 0.85**8)**48 = 2e-7. For no size is a link missed with a higher probability than 4e-7.

Verification on full sets, without pairs of copies:

1. Equal texts are one class from the start.
2. Star rounds: a class in a key group that holds several components is checked against one member of another component. What is
   linked merges, so a group of many near copies needs few pairs.
3. In key groups that still hold several components the sketches of members of different components are compared. Where an estimate
   (corrected for register collisions) is within ``SIGMAS`` of the threshold, in the first band the two share, both members stay;
   these meet once more with their full sets, and a task returns a spanning forest of the links it finds there, not its pairs.
   Groups over ``block`` members (or ``SET_BYTES`` of sets) are compared block by block in separate tasks; none is cut off.

Defined cases: texts without a word have an empty set and are linked with nothing, copies included; a text of fewer than ``width``
words has one shingle, the whole; rows with equal keys are separate rows with one component; ``component_id`` is the least non-null key
reachable (null if there is none), and a row without key is kept if its group has no key; an empty table gives an
empty table. Only key and text are read; texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import cut, join_classes
from runlens.llm.simhash import components
from runlens.operators.joins import sized_side

BASE = np.uint64(0x9E3779B97F4A7C15)
MANTISSA = 10
ROWS = 8
WIDEST = 48             # bands of the largest sets
FEWEST = 12             # bands of the smallest sets that can be linked without being equal
SIGMAS = 6
LOW = 1 << 10           # of a key: four bits for the size class, six for the band
SET_BYTES = 1 << 24     # of full sets on one side of a comparison
AT_ONCE = 1 << 12       # pairs compared at a time
PAIR_BYTES = 1 << 25    # of pairs that may be broadcast


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Ascending hashes of the distinct shingles; A-Z lower-cased, words end at the six ASCII white-space characters."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    long = min(n, width)
    acc = h[:n - long + 1] + np.uint64(long)
    for i in range(1, long):
        acc = _mix(acc) * BASE + h[i:n - long + 1 + i]
    return np.unique(_mix(acc))


class Sizes:
    """Size classes: number of bands by set size."""

    def __init__(self, percent: int):
        self.percent = percent
        # Below this size a set can only be linked with an equal one.
        least = 100 // (100 - percent) + (100 % (100 - percent) > 0)
        self.bounds, self.bands = [1], [1]
        while self.bands[-1] < WIDEST:
            low = max(least, self.bounds[-1] * 3 // 2)
            differ = self.spread(low * 3 // 2 - 1)
            self.bounds.append(low)
            self.bands.append(min(WIDEST, max(FEWEST, differ + 6)))

    def spread(self, size: int) -> int:
        """By how many shingles a set can differ from a linked one."""
        return (100 - self.percent) * size // self.percent

    def of(self, size: int) -> list[int]:
        """The size class of a set and, if it differs, that of the largest sets it can be linked with."""
        own, most = np.searchsorted(self.bounds, [size, size * 100 // self.percent], side="right") - 1
        return [int(own)] if own == most else [int(own), int(most)]


def registers(shingles: np.ndarray, bands: int) -> np.ndarray:
    """(leading-zero count + 1) << MANTISSA | mantissa of each bucket's least value; 0 where a bucket is empty."""
    m = bands * ROWS
    least = np.full(m, 1 << 53, np.uint64)
    np.minimum.at(least, shingles % np.uint64(m), _mix(shingles ^ BASE) >> np.uint64(11))
    _, exponent = np.frexp(least.astype(np.float64))      # values of 53 bits are exact
    zeros = np.clip(53 - exponent, 0, 53)
    rest = (least << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA) & np.uint64((1 << MANTISSA) - 1)
    return np.where(least < (1 << 53), ((zeros + 1) << MANTISSA) + rest.astype(np.int64), 0).astype("<u2")


def band_keys(shingles: np.ndarray, sizes: Sizes) -> np.ndarray:
    """Keys of the non-empty bands; the low bits name band and size class."""
    out = []
    for c in sizes.of(len(shingles)) if len(shingles) else []:
        if c == 0:      # equal sets only: one key for the whole
            keys, band = _mix(np.bitwise_xor.reduce(shingles, keepdims=True) + np.uint64(len(shingles))), np.zeros(1, np.uint64)
        else:
            regs = registers(shingles, sizes.bands[c]).reshape(-1, ROWS)
            band = np.flatnonzero(regs.any(axis=1)).astype(np.uint64)
            halves = regs.view("<u8").astype(np.uint64)[band]
            keys = _mix(_mix(halves[:, 0]) + halves[:, 1] * BASE)
        out.append(keys & ~np.uint64(LOW - 1) | band << np.uint64(4) | np.uint64(c))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def collision_rate(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """Chance that the registers of a bucket agree for disjoint sets of ``a`` and ``b`` shingles, both not empty.

    The least of x values a bucket is about exponential; a register of ``z`` zeros covers 2**-(z + 1 + MANTISSA) of the range.
    """
    x, y = a[:, None] / m, b[:, None] / m
    low = 0.5 ** np.arange(1, 54)
    both = (np.exp(-(x + y) * low) - np.exp(-(x + y) * 2 * low)) * low / (1 << MANTISSA)
    return (both * x * y / (x + y)).sum(axis=1) / (-np.expm1(-x[:, 0]) * -np.expm1(-y[:, 0]))


@lru_cache(1 << 16)
def _chance(n: int, m: int) -> float:
    """Collision rate of two sets of about one size: linked sets differ by a few hundredths of it only."""
    return float(collision_rate(np.array([float(n)]), np.array([float(n)]), m)[0])


def likely(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches (rows of x and y, of sets of about ``sizes`` shingles) may belong to linked sets: those whose estimated
    Jaccard similarity is not under the threshold by ``SIGMAS``."""
    filled, full = x > 0, y > 0
    equal = ((x == y) & filled).sum(axis=1)
    used, both = (filled | full).sum(axis=1), (filled & full).sum(axis=1)
    chance = np.array([_chance(int(n), x.shape[1]) for n in sizes])
    estimate = (equal - chance * both) / np.maximum(used - chance * both, 1)
    want = percent / 100
    return estimate >= want - SIGMAS * np.sqrt(want * (1 - want) / np.maximum(used, 1))


def classes_of(df: DataFrame, key: str, text: str, width: int, sizes: Sizes) -> DataFrame:
    """(id, least, copies, n, keys) per distinct text."""
    @F.pandas_udf("n long, keys array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t, width) for t in texts]
        return pd.DataFrame({"n": [len(s) for s in sets], "keys": [band_keys(s, sizes) for s in sets]})

    rows = _slim(df, key, text).withColumn("s", sketch("text")).select("id", "key", "s.n", "s.keys")
    return rows.groupBy("id").agg(F.min("key").alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("keys").alias("keys"))


def _slim(df: DataFrame, key: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.unhex(F.md5(t.cast("binary"))).alias("id"), F.col(key).alias("key"), t.alias("text"))


def full_sets(df: DataFrame, text: str, wanted: DataFrame, width: int, sizes: Sizes) -> DataFrame:
    """(id, n, shingles, sketches) of the wanted ids: sorted hashes and the registers of each size class."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "n": [len(s) for s in sets], "shingles": [s.tobytes() for s in sets],
                                "sketches": [[{"size_class": c, "registers": registers(s, sizes.bands[c]).tobytes()} for c in sizes.of(len(s))] for s in sets]})

    texts = _slim(df, text, text).select("id", "text").join(sized_side(wanted), "id").groupBy("id").agg(F.first("text").alias("text"))
    return texts.mapInPandas(build, "id binary, n long, shingles binary, sketches array<struct<size_class:int,registers:binary>>")


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sets (ascending hashes) are similar enough."""
    both = np.concatenate([one, other])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def wanted_sets(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets of the given ids; few enough ids are sent to the sets, so that a join that follows shuffles no other set."""
    return sets.join(sized_side(ids.distinct(), max_bytes=PAIR_BYTES), "id", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of the pairs (a, b), decided on the full sets."""
    @F.pandas_udf("boolean")
    def passed(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(one, other)], dtype=bool)

    # Where the pairs are few enough to be sent to the sets, only the sets that a pair names are shuffled.
    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")).join(sized_side(pairs, max_bytes=PAIR_BYTES), "a")
    y = wanted_sets(sets, pairs.select(F.col("b").alias("id"))).select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return x.join(y, "b").where(passed("x", "y")).select("a", "b")


def _fits(n, m, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def with_center(rows: DataFrame, turn: int) -> DataFrame:
    """The rows (bucket, id, n, label) of the key groups that hold several components, with one member ``c`` of the group, by hash order of the turn."""
    center = F.min_by(F.struct("id", "label", "n"), F.xxhash64("id", F.lit(turn))).alias("c")
    groups = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), center).where("low < high")
    return rows.join(groups.select("bucket", "c"), "bucket")


def star_pairs(centered: DataFrame, percent: int, turn: int) -> DataFrame:
    """For each class one center of its key groups that is of another component."""
    met = centered.where((F.col("label") != F.col("c.label")) & _fits(F.col("n"), F.col("c.n"), percent))
    return met.groupBy(F.col("id").alias("a")).agg(F.min_by("c.id", F.xxhash64("c.id", F.lit(turn))).alias("b"))


def open_pairs(cells: pd.DataFrame, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (all a, all b) of pairs in one cell that may be linked, are of different components and share no earlier band.

    ``cells`` holds whole cells, one after the other; pairs are judged ``AT_ONCE`` at a time.
    """
    key = cells[["bucket", "i", "j"]].to_numpy()
    starts = np.append(np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))), len(key))
    size_class = key[:, 0] & 15
    n, side, label = cells["n"].to_numpy(), cells["side"].to_numpy(), pd.factorize(cells["label"])[0]
    crossing = key[:, 1] != key[:, 2]
    raw = cells["registers"].to_numpy()

    def judged(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        fit = (label[a] != label[b]) & (100 * low >= percent * high) & (~crossing[a] | (side[a] != side[b]))
        a, b = a[fit], b[fit]
        for c in np.unique(size_class[a]):
            own = size_class[a] == c
            x, y = a[own], b[own]
            rows, at = np.unique(np.concatenate([x, y]), return_inverse=True)
            regs = np.frombuffer(b"".join(raw[rows]), "<u2").reshape(len(rows), -1)
            p, q = regs[at[:len(x)]], regs[at[len(x):]]
            near = likely(p, q, n[x], percent)
            x, y, p, q = x[near], y[near], p[near], q[near]
            if len(x):
                p, q = p.reshape(len(x), -1, ROWS), q.reshape(len(x), -1, ROWS)
                shared = (p == q).all(axis=2) & p.any(axis=2)
                band = (key[x, 0] & LOW - 1) >> 4
                first = shared[np.arange(len(x)), band] & (np.argmax(shared, axis=1) == band)
                if first.any():
                    yield x[first], y[first]

    held, total = [], 0
    for lo, hi in zip(starts, starts[1:]):
        for i in range(lo, hi - 1):
            held.append((np.full(hi - i - 1, i), np.arange(i + 1, hi)))
            total += hi - i - 1
            if total >= AT_ONCE:
                yield from judged(*map(np.concatenate, zip(*held)))
                held, total = [], 0
    if held:
        yield from judged(*map(np.concatenate, zip(*held)))


def whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by cell, cut so that no cell is divided."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if len(rows):
            last = rows.iloc[-1]
            same = ((rows["bucket"] == last["bucket"]) & (rows["i"] == last["i"]) & (rows["j"] == last["j"])).to_numpy()
            begin = int(np.argmax(same))
            if begin:
                yield rows.iloc[:begin]
            rest = rows.iloc[begin:]
    if rest is not None:
        yield rest


def _cells(rows: DataFrame, sets: DataFrame, block: int, *payload: str) -> DataFrame:
    """Members of the key groups that hold several components, by blocks, once for each pair of blocks of the group, with their sketches."""
    rows = rows.select("bucket", "id", "label", "n")
    groups = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("m"),
                                        F.sum("n").alias("total")).where("low < high")
    blocks = F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("total") * 8 / SET_BYTES) if "shingles" in payload else F.lit(1))
    open_rows = cut(rows.join(groups.select("bucket", blocks.cast("int").alias("blocks")), "bucket"), "minhash-members")
    left = open_rows.withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    wanted = F.col("bucket").bitwiseAND(15).cast("int")
    known = F.get(F.filter("sketches", lambda s: s["size_class"] == wanted), 0)["registers"]
    own = wanted_sets(sets, open_rows.select("id")).select("id", "sketches", *payload)
    return left.join(own, "id").select(
        "bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "id", "label", "n", "side",
        known.alias("registers"), *payload)


def close_members(rows: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(bucket, id, label, n): the members of key groups that may be linked with one of another component there."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells in whole_cells(batches):
            hit = np.zeros(len(cells), bool)
            for a, b in open_pairs(cells, percent):
                hit[a] = hit[b] = True
            yield cells.loc[hit, ["bucket", "id", "label", "n"]]

    cells = _cells(rows, sets, block).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return cells.mapInPandas(compare, "bucket long, id binary, label binary, n long").distinct()


def forest_links(rows: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): links, verified on the full sets, that connect what is linked between components inside the key groups."""
    def connect(group: pd.DataFrame) -> pd.DataFrame:
        label, ids = pd.factorize(group["label"])[0], group["id"].tolist()
        members = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        parent, a, b = list(range(len(group))), [], []

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for one, other in open_pairs(group, percent):
            for i, j in zip(one.tolist(), other.tolist()):
                x, y = root(int(label[i])), root(int(label[j]))
                if x != y and linked(members[i], members[j], percent):
                    parent[max(x, y)] = min(x, y)
                    a.append(ids[i])
                    b.append(ids[j])
        return pd.DataFrame({"a": a, "b": b})

    cells = _cells(rows, sets, block, "shingles")
    return cells.groupBy("bucket", "i", "j").applyInPandas(connect, "a binary, b binary")


def near_duplicates(df: DataFrame, key: str, text: str, width: int = 5, percent: int = 85, turns: int = 2,
                    block: int = 2048) -> DataFrame:
    """One row per input row: key, ``n_shingles``, ``component_id`` (least key of its group), ``kept``."""
    sizes = Sizes(percent)
    classes = cut(classes_of(df, key, text, width, sizes), "minhash-classes")
    # Most keys belong to one class only: they are counted alone, and only what shares a key goes on.
    keys = classes.select(F.explode("keys").alias("bucket"), "id", "n")
    several = classes.select(F.explode("keys").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    shared = cut(keys.join(several, "bucket", "left_semi"), "minhash-shared")
    wanted = cut(shared.select("id").distinct(), "minhash-wanted")
    sets = cut(full_sets(df, text, wanted, width, sizes), "minhash-sets")

    links, labels = None, wanted.select("id", F.col("id").alias("label"))
    for turn in range(turns + 1):
        rows = shared.select("bucket", "id", "n").join(labels, "id") if turn else shared.withColumn("label", F.col("id"))
        if turn < turns:    # only the key groups that still hold several components go on
            shared = cut(with_center(rows, turn), "minhash-open")
            found = verified(cut(star_pairs(shared, percent, turn), "minhash-pairs"), sets, percent)
        else:
            found = forest_links(cut(close_members(rows, sets, percent, block), "minhash-close"), sets, percent, block)
        found = cut(found, "minhash-links")
        links = found if links is None else links.unionByName(found)
        if found.isEmpty():
            continue
        merged = components(links).select(F.col("v").alias("id"), F.col("label").alias("merged"))
        labels = cut(wanted.join(merged, "id", "left").select("id", F.coalesce("merged", "id").alias("label")), "minhash-labels")

    # Groups of several classes take their least key from all of them; the others from their own copies.
    joined = classes.join(labels, "id").select("id", "label", "least")
    roots = joined.groupBy("label").agg(F.min("least").alias("root"))
    roots = joined.join(roots, "label").select("id", "root", F.lit(True).alias("grouped"))
    found = classes.join(roots, "id", "left").select("id", "n", "copies", F.when(F.col("grouped"), F.col("root")).otherwise(F.col("least")).alias("root"))
    out = join_classes(_slim(df, key, text).select("id", "key"), cut(found, "minhash-found"), "id", "copies")
    component = F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("key").eqNullSafe(component).alias("kept"))
