"""Benchmark decontamination by q-gram lemma filtering (operator 6).

An item of m characters occurs in a text within k = floor(``edit_rate`` * m) edits only if the text shares
at least t = m + 1 - q * (k + 1) of the item's q-grams inside a band of k + 1 neighbouring diagonals (diagonal: text position
minus item position). For each text:

1. every character q-gram of the whole text is looked up among the items' q-grams;
2. the hits of an item are counted per diagonal band; bands are 2w wide and start every w diagonals, w > k
   a power of two, so any k + 1 neighbouring diagonals lie inside one band;
3. regions (text span of a band) with at least t hits are kept and verified by a banded alignment: the fewest
   edits of the whole item against any part of the region. Of overlapping occurrences of an item the best is reported
   (fewest edits, then the first).

q is the largest q-gram length, up to ``MAX_Q``, that gives t >= 1 for the item's k, so each item
of at least ``min_chars`` characters gets an exact filter. A shorter item occurs only verbatim and between word borders: the places
of its first q-gram are compared whole.

Text is compared lower-cased and with white space runs as one space. Items are read in blocks of at most
``block_chars`` characters; each block is broadcast to one pass over the documents.

Defined cases: a null or empty text is clean; null and empty items match nothing; an item of one word marks every
document that holds the word; equal items each report their own id; items with a null id report as null; repeated documents are judged alike; an empty
benchmark leaves all clean; an empty table gives an empty table; columns named like the added ones are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.llm.common import as_row, from_row

MAX_Q = 8
EDIT_RATE = 0.05
MIN_CHARS = 32
BLOCK_CHARS = 4_000_000
FILTER_BITS = 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

MATCH = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("edits", T.IntegerType())])


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """The q-gram at each position as one number: the low byte of each character. Equal q-grams give
    equal numbers, so the filter loses nothing; the alignment compares whole characters."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    low = (codes & 255).astype(np.uint64)
    n = len(codes) - q + 1
    out = low[:n].copy()
    for i in range(1, q):
        out |= low[i:i + n] << np.uint64(8 * i)
    return out


def _border(text: str, at: int) -> bool:
    """No word goes on from the character before ``at`` to the one there."""
    return not (0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum())


class ItemIndex:
    """The q-grams of a block of items, sorted, with a small bit table in front."""

    def __init__(self, items: list[tuple[int | None, str]], edit_rate: float, min_chars: int):
        self.ids, self.codes, self.k, self.q, self.least, self.short = [], [], [], [], [], []
        for item_id, text in items:
            t = normalise(text)
            m = len(t)
            if not m:
                continue
            k = int(edit_rate * m) if m >= min_chars else 0
            q = min(MAX_Q, m // (k + 1))
            self.ids.append(item_id)
            self.codes.append(_codes(t))
            self.k.append(k)
            self.q.append(q)
            self.least.append(m + 1 - q * (k + 1))
            self.short.append(m < min_chars)
        self.by_q, self.short_by_q = self._tables(False), self._tables(True)
        self.width = np.array([1 << int(k).bit_length() for k in self.k], np.int64)  # > k
        self.need = np.array(self.least, np.int64)
        self.length = np.array([len(c) for c in self.codes], np.int64)

    def _tables(self, short: bool) -> dict[int, tuple]:
        """Per q the sorted q-grams of the long items, or the first ones of the short items."""
        tables = {}
        for q in sorted({x for x, s in zip(self.q, self.short) if s == short}):
            own = [i for i, x in enumerate(self.q) if x == q and self.short[i] == short]
            grams = [_grams(self.codes[i], q)[:1 if short else None] for i in own]
            g = np.concatenate(grams)
            item = np.concatenate([np.full(len(x), i, np.int64) for i, x in zip(own, grams)])
            at = np.concatenate([np.arange(len(x), dtype=np.int64) for x in grams])
            order = np.argsort(g, kind="stable")
            keys, first, count = np.unique(g[order], return_index=True, return_counts=True)
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[self._slot(keys)] = True
            tables[q] = (seen, keys, first, count, item[order], at[order])
        return tables

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return (grams * MULTIPLIER) >> np.uint64(64 - FILTER_BITS)

    def _hits(self, codes: np.ndarray, q: int, table: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(item, text position minus item position) of each q-gram of a text that is in the table."""
        seen, keys, first, count, item, at = table
        grams = _grams(codes, q)
        pos = np.flatnonzero(seen[self._slot(grams)])
        g = grams[pos]
        k = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        hit = keys[k] == g
        pos, k = pos[hit], k[hit]
        n = count[k]
        each = np.repeat(np.arange(len(pos)), n)
        entry = first[k][each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        return item[entry], pos[each] - at[entry]

    def verbatim(self, text: str, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of the short items between word borders of a normalised text."""
        for q, table in self.short_by_q.items():
            for i, start in zip(*map(np.ndarray.tolist, self._hits(codes, q, table))):
                end = start + int(self.length[i])
                if np.array_equal(codes[start:end], self.codes[i]) and _border(text, start) and _border(text, end):
                    yield i, start, end

    def regions(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, from, to): parts of a text that meet an item's q-gram bound."""
        items, diagonals = [], []
        for q, table in self.by_q.items():
            item, diagonal = self._hits(codes, q, table)
            if len(item):
                items.append(item)
                diagonals.append(diagonal)
        if not items:
            return []
        item, diagonal = np.concatenate(items), np.concatenate(diagonals)
        base = diagonal + self.length[item]          # from 1 up: diagonals may be negative
        band = base // self.width[item]
        # Band b spans widths b and b + 1, so a diagonal counts for its own band and the one before.
        keys = np.concatenate([item << 40 | band, item << 40 | (band - 1)])
        keys, hits = np.unique(keys, return_counts=True)
        it = keys >> 40
        ok = hits >= self.need[it]
        out = []
        for i, b in zip(it[ok], (keys & ((1 << 40) - 1))[ok]):
            w, m = int(self.width[i]), int(self.length[i])
            lo = int(b) * w - m                       # least diagonal of the band
            out.append((int(i), max(0, lo - self.k[i]), min(len(codes), lo + 2 * w + m + self.k[i])))
        return out

    def _aligned(self, i: int, codes: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int, int, int]]:
        """(item, edits, start, end): the best occurrence in a region, and those in what is left on its sides."""
        if hi - lo < self.length[i] - self.k[i]:
            return
        edits, start, end = align(self.codes[i], codes[lo:hi], self.k[i])
        if edits <= self.k[i]:
            yield i, edits, lo + start, lo + end
            yield from self._aligned(i, codes, lo, lo + start)
            yield from self._aligned(i, codes, lo + end, hi)

    def matches(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item id, start, end, edits) of every occurrence that overlaps no better one of the same item; by item id, best first.

        Positions are characters of the normalised text."""
        text = normalise(text)
        codes = _codes(text)
        found = [(i, 0, start, end) for i, start, end in self.verbatim(text, codes)]
        for i, lo, hi in self.regions(codes):
            found += self._aligned(i, codes, lo, hi)
        kept: dict[int, Spans] = {}
        for i, edits, start, end in sorted(found):
            kept.setdefault(i, Spans()).add(start, end, edits)
        return sorted(((self.ids[i], s, e, d) for i, spans in kept.items() for s, e, d in spans),
                      key=lambda x: (x[0] is None, x[0] or 0, x[3], x[1]))


class Spans(list):
    """(start, end, edits) by start; a span that overlaps one already there is left out."""

    def add(self, start: int, end: int, edits: int) -> None:
        at = bisect_left(self, (start,))
        if (not at or self[at - 1][1] <= start) and (at == len(self) or end <= self[at][0]):
            self.insert(at, (start, end, edits))


def align(item: np.ndarray, part: np.ndarray, k: int) -> tuple[int, int, int]:
    """(edits, start, end) of the part of ``part`` nearest to the whole item; edits > k means none.

    Cell (i, d) is the fewest edits of the first i item characters ending at part position i + d; all
    diagonals d of the region are kept in one row, so a row costs a few vector operations.
    """
    m, n = len(item), len(part)
    big = m + n + 1
    at = np.arange(n + 1)
    cost = np.zeros(n + 1, np.int64)
    origin = at.copy()
    for i in range(1, m + 1):
        step = np.full(n + 1, big, np.int64)
        step[1:] = cost[:-1] + (part != item[i - 1])
        from_left = np.zeros(n + 1, np.int64)
        from_left[1:] = origin[:-1]
        down = cost + 1
        use = down < step
        new = np.where(use, down, step)
        src = np.where(use, origin, from_left)
        # Insertions of part characters: a running minimum of cost minus position.
        slope = new - at
        run = np.minimum.accumulate(slope)
        last = np.maximum.accumulate(np.where(slope == run, at, 0))
        cost, origin = run + at, src[last]
        if cost.min() > k:
            return big, 0, 0
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), end


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_chars: int) -> Iterator[list]:
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    n = size // block_chars + 1
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b) if n > 1 else items
        rows = [(r["id"], r["text"]) for r in part.collect()]  # about block_chars characters
        if rows:
            yield rows


def _matcher(items, edit_rate: float, min_chars: int):
    @F.pandas_udf(T.ArrayType(MATCH))
    def matched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = ItemIndex(items.value, edit_rate, min_chars)
        for texts in batches:
            yield pd.Series([index.matches(t) for t in texts])

    return matched


def find_matches(df: DataFrame, text: str, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text",
                 edit_rate: float = EDIT_RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``df`` with ``matches`` (array of item_id, start, end, edits) and ``contaminated``."""
    sc = df.sparkSession.sparkContext
    rows = as_row(df)
    found = []
    for items in _blocks(benchmark, item_id, item_text, block_chars):
        matched = _matcher(sc.broadcast(items), edit_rate, min_chars)
        found.append(matched(F.col("row").getField(text)))
    none = F.array().cast(T.ArrayType(MATCH))
    matches = F.sort_array(F.concat(none, *found)) if found else none
    rows = rows.withColumn("matches", matches).withColumn("contaminated", F.size("matches") > 0)
    return from_row(rows, "matches", "contaminated")
