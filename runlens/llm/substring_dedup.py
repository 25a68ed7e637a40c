"""Substring dedup by Rabin-Karp window hashes (operator 3).

A window is ``width`` consecutive words of one document. A word is removed if a window that covers it also starts earlier:
in a document with a smaller key, or earlier in the same document. Windows are judged on the input.

The hash of every window of every text is computed by rolling (Rabin-Karp over word hashes). To count them
in Spark without a row per window, neighbouring windows travel together:

1. Each window has an anchor, the ``gram`` consecutive words of it whose hash is least. Equal windows have equal
   anchors, at the same place. Windows of a document with the same anchor form a run; its context hash is made
   of the Rabin-Karp hashes of its first and last window, which together cover all its words. A
   document gives one row (anchor, context, key) per run, about one for every nine words.
2. Anchors that only one document has hold no window that repeats across documents, so their rows end here.
3. A context that occurs in several documents repeats whole: every occurrence but the least is removed whole.
4. Where an anchor has several contexts, runs match in part only (the ends of repeated passages). The least
   document of each such context sends its single windows; each window's least document is found by its hash.
5. Each text meets its repeated contexts and windows; repeats within the text are found in
   it alone. Overlapping windows merge into maximal removal intervals.

Every step is an aggregate with partial sums before the shuffle or a join, so a passage that a third of
the documents share is split; lists per document are bounded by the document.

Defined cases: a null or empty text has no words; documents with fewer than ``width`` words stay whole; rows with equal keys
take one place (an equal place is not earlier), rows without a key come after all others and share a place; an
empty table gives an empty table; only the key and the text column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import cut

WIDTH = 20
GRAM = 5
BASE = 0x9E3779B97F4A7C15
LAST = (1 << 63) - 1       # the place of rows without a key
WORDS_AT_ONCE = 1 << 20


def split_words(text: str | None) -> list[bytes]:
    """``bytes.split`` splits at the six ASCII white-space characters, and only there."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hashes (modulo 2**64) of all k neighbours, by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, size = None, 0, h, 1
    while size <= k:
        if k & size:
            # ``out`` covers the first ``done`` words, ``power`` the next ``size``.
            part = power[done:done + n]
            out = part.copy() if out is None else out[:n] * np.uint64(pow(BASE, size, 1 << 64)) + part
            done += size
        if size * 2 <= k:
            m = len(power) - size
            power = power[:m] * np.uint64(pow(BASE, size, 1 << 64)) + power[size:size + m]
        size *= 2
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


class Runs:
    """Windows, anchors and runs of some documents, laid out one after the other."""

    def __init__(self, docs: list[list[bytes]], width: int, gram: int):
        n = np.array([len(w) for w in docs], np.int64)
        h = np.fromiter((xxhash.xxh64_intdigest(w) for ws in docs for w in ws), np.uint64, int(n.sum()))
        offset = np.cumsum(n) - n
        count = np.maximum(n - width + 1, 0)
        total = int(count.sum())
        self.doc = np.repeat(np.arange(len(docs)), count)
        # Position of each window in the layout, and in its document.
        self.start = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        at = self.start + np.repeat(offset, count)
        if not total:
            self.window = self.run = self.first = np.zeros(0, np.int64)
            self.anchor = self.context = np.zeros(0, np.int64)
            return
        window = _rolling(h, width)[at]
        self.window = window.view(np.int64)
        least, place = _mix(_rolling(h, gram)), np.arange(len(h) - gram + 1)
        # Least gram of each window (leftmost on ties), by doubling.
        span, want = 1, width - gram + 1
        while span < want:
            step = min(span, want - span)
            a, b = least[:-step], least[step:]
            left = a <= b
            least, place = np.where(left, a, b), np.where(left, place[:-step], place[step:])
            span += step
        least, place = least[at], place[at]
        new = np.ones(total, bool)
        new[1:] = (place[1:] != place[:-1]) | (self.doc[1:] != self.doc[:-1])
        self.run = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        last = np.append(self.first[1:], total) - 1
        shape = ((last - self.first) << 8 | (place[self.first] - at[self.first])).astype(np.uint64)
        self.anchor = least[self.first].view(np.int64)
        self.context = _mix(_mix(window[self.first]) * np.uint64(BASE) + _mix(window[last] + shape)).view(np.int64)


def _slices(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive rows with about WORDS_AT_ONCE words together (one row at least)."""
    lo, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > WORDS_AT_ONCE:
            yield slice(lo, i)
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield slice(lo, len(sizes))


def _parts(texts, *others):
    """The rows in slices, with their words."""
    size = np.array([len(t) // 5 if t else 0 for t in texts], np.int64)
    for s in _slices(size):
        yield [split_words(t) for t in texts[s]], *[o[s] for o in others]


def _run_rows(width: int, gram: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for docs, place in _parts(batch["text"].tolist(), batch["place"].to_numpy()):
                r = Runs(docs, width, gram)
                yield pd.DataFrame({"anchor": r.anchor, "context": r.context, "place": place[r.doc[r.first]]}).drop_duplicates()

    return rows


def _window_rows(width: int, gram: int):
    """The single windows of the runs listed in ``parts``."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            wanted = batch["parts"].tolist()
            for docs, place, want in _parts(batch["text"].tolist(), batch["place"].to_numpy(), wanted):
                r = Runs(docs, width, gram)
                hit = _listed(r, want)[r.run]
                yield pd.DataFrame({"window": r.window[hit], "anchor": r.anchor[r.run[hit]],
                                    "place": place[r.doc[hit]]}).drop_duplicates()

    return rows


def _listed(r: Runs, lists) -> np.ndarray:
    """Which runs have their context in the list of their document."""
    hit = np.zeros(len(r.first), bool)
    owner = r.doc[r.first]
    bounds = np.searchsorted(owner, np.arange(len(lists) + 1))
    for i, listed in enumerate(lists):
        if listed is not None and len(listed):
            lo, hi = bounds[i], bounds[i + 1]
            hit[lo:hi] = np.isin(r.context[lo:hi], np.asarray(listed, np.int64))
    return hit


def _cleaned(width: int, gram: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            others = [batch["key"].to_numpy(dtype=object), batch["wholes"].tolist(), batch["windows"].tolist()]
            for docs, key, wholes, windows in _parts(batch["text"].tolist(), *others):
                r = Runs(docs, width, gram)
                repeated = _listed(r, wholes)[r.run] if len(r.first) else np.zeros(0, bool)
                bounds = np.searchsorted(r.doc, np.arange(len(docs) + 1))
                kept, removed, spans = [], [], []
                for i, ws in enumerate(docs):
                    own = r.window[bounds[i]:bounds[i + 1]]
                    hit = repeated[bounds[i]:bounds[i + 1]]
                    if len(own):
                        order = np.argsort(own, kind="stable")
                        hit[order[1:]] |= own[order[1:]] == own[order[:-1]]
                        if windows[i] is not None and len(windows[i]):
                            hit |= np.isin(own, np.asarray(windows[i], np.int64))
                    starts = np.flatnonzero(hit)
                    if not len(starts):
                        kept.append(b" ".join(ws))
                        removed.append(0)
                        spans.append([])
                        continue
                    # Maximal intervals: windows that overlap or touch are one.
                    gap = np.flatnonzero(starts[1:] > starts[:-1] + width) + 1
                    lo = starts[np.append(0, gap)]
                    hi = starts[np.append(gap, len(starts)) - 1] + width
                    out, at = [], 0
                    for a, b in zip(lo, hi):
                        out.extend(ws[at:a])
                        at = b
                    out.extend(ws[at:])
                    kept.append(b" ".join(out))
                    removed.append(int((hi - lo).sum()))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(lo, hi)])
                yield pd.DataFrame({"key": pd.array(key, dtype="Int64"), "n_words": [len(ws) for ws in docs], "n_removed": removed,
                                    "kept_text": [k.decode("utf-8", "surrogatepass") for k in kept], "removed": spans})

    return rows


def remove_repeats(df: DataFrame, key: str, text: str, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per row: key, n_words, n_removed, kept_text (kept words, space-joined), removed (word intervals)."""
    key_col = F.col(key).cast("long")
    docs = df.select(key_col.alias("key"), F.coalesce(key_col, F.lit(LAST)).alias("place"), F.col(text).alias("text"))
    slim = docs.select("place", "text")

    # 1. One row per run; computed anew where it is used, which is cheaper than storing it.
    runs = slim.mapInPandas(_run_rows(width, gram), "anchor long, context long, place long")
    # 2. Anchors of several documents.
    spread = F.min("place") < F.max("place")
    shared = runs.groupBy("anchor").agg(spread.alias("several")).where("several").select("anchor")
    runs = cut(runs.join(shared, "anchor"), "repeats-runs")
    # 3. Contexts of several documents.
    contexts = runs.groupBy("anchor", "context").agg(F.min("place").alias("least"), F.max("place").alias("most"))
    contexts = cut(contexts, "repeats-contexts")
    wholes = (runs.join(contexts.where("least < most").select("context", "anchor", "least"), ["anchor", "context"])
              .where("place > least").select("place", "context", F.lit(True).alias("whole")))
    # 4. Anchors of several contexts.
    mixed = contexts.groupBy("anchor").agg((F.count("*") > 1).alias("mixed")).where("mixed").select("anchor")
    parts = contexts.join(mixed, "anchor").select(F.col("least").alias("place"), "context", F.lit(False).alias("whole"))
    lists = cut(wholes.unionByName(parts).groupBy("place").agg(
        F.collect_set(F.when(F.col("whole"), F.col("context"))).alias("wholes"),
        F.collect_set(F.when(~F.col("whole"), F.col("context"))).alias("parts")), "repeats-lists")
    windows = cut(slim.join(lists.where(F.size("parts") > 0).select("place", "parts"), "place").select("place", "text", "parts")
                  .mapInPandas(_window_rows(width, gram), "window long, anchor long, place long"), "repeats-windows")
    least = windows.groupBy("window", "anchor").agg(F.min("place").alias("least"), F.max("place").alias("most")).where("least < most")
    later = windows.join(least, ["window", "anchor"]).where("place > least")
    later = later.groupBy("place").agg(F.collect_set("window").alias("windows"))
    found = cut(lists.select("place", "wholes").join(later, "place", "full"), "repeats-found")
    # 5. Each text with what repeats in it.
    out = (docs.join(found, "place", "left").select("key", "text", "wholes", "windows")
           .mapInPandas(_cleaned(width, gram),
                        "key long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"))
    return out.withColumnRenamed("key", key)
