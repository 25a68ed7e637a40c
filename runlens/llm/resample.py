"""Importance resampling towards a target distribution by hashed n-gram features (operator 11).

Features of a text are its runs of 1 to ``n`` consecutive words; a feature's bucket is the CRC-32 of its bytes modulo
``buckets``. A document's weight is the sum over its features of the log ratio of target to source bucket
frequencies; documents are drawn without replacement by weight plus Gumbel noise (the highest scores).

Scanning: separators collapse to single spaces, then one overlapped regex scan finds every run of ``n`` words between
its boundary lookarounds; overlapping matches start at every word, and since words are one space apart, a match and its
followers give the spans of the shorter runs too (two sentinel words at the end let the last words match). The spans go to the CRC directly,
each longer run continuing the sum of the shorter one.

Plan: one pass over the texts writes each document's buckets (sorted, as differences: a few bits a feature); source
counts and weights read that table. Counts leave a task as at most ``buckets`` rows, and the table of gains has ``buckets``
numbers. Ranks come from a range-partitioned sort of narrow rows plus one row count per partition; no task holds all.

Defined cases: null and empty texts have no features and weight 0; a null key hashes as the empty string and comes last
among equal scores; equal keys are separate rows, their ties go by weight, then features; documents under ``min_words`` words are
never drawn; with an empty target all gains follow from the +1 smoothing; an empty table gives an empty table. Texts are
scanned whole, in slices of bounded memory; only the key and text columns are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import cut

BUCKETS = 10_000
AT_ONCE = 1 << 16       # word starts held at a time

# A-Z become a-z; every other ASCII character but digits and a-z becomes a space.
_FOLD = bytes(c if c > 127 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if chr(c).isupper() and c < 128 else 32 for c in range(256))


def collapse(text: str | None) -> bytes:
    """The words of a text, one space apart."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split())


def scanner(n: int) -> regex.Pattern:
    """Runs of ``n`` words between separators; the match begins at the separator before its first word."""
    return regex.compile(rb"(?<=[^ ]|^)" + rb" [^ ]++" * n + rb"(?= )")


def spans(texts: list[bytes], n: int, scan: regex.Pattern) -> Iterator[tuple[bytes, np.ndarray]]:
    """Slices (padded texts, word starts): the run of k words at place i spans starts[i] : starts[i + k] - 1.

    Sentinel words close each text. Only the first len(starts) - n places of a slice are its own; the others close their runs.
    """
    padded = b"".join([b" " + words + b" \0" * n if words else b" \0" * n for words in texts]) + b" \0" * n + b" "
    found = (m.start() for m in scan.finditer(padded, overlapped=True))
    held = np.zeros(0, np.int64)
    while True:
        got = np.fromiter(islice(found, AT_ONCE), np.int64) + 1
        if not len(got):
            break
        held = np.concatenate([held, got])
        yield padded, held
        held = held[-n:]


def _byte_table() -> np.ndarray:
    """What a CRC-32 register becomes by its low byte."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


BYTE = _byte_table()


def _shift_tables() -> np.ndarray:
    """[length][byte of the sum][its value]: the part of a CRC that is left behind ``length`` more bytes."""
    now = (np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    out = [now]
    for _ in range(LONG):
        now = BYTE[now & 255] ^ (now >> 8)
        out.append(now)
    return np.stack(out)


LONG = 63               # longer words take the one-call CRC
SHIFT = _shift_tables()


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 is linear: crc(a + b) = shifted(crc(a), len(b)) ^ crc(b)."""
    crc, left = crc.copy(), length.copy()
    live = np.arange(len(crc))
    while len(live):
        step, c = np.minimum(left[live], LONG), crc[live]
        crc[live] = SHIFT[step, 0, c & 255] ^ SHIFT[step, 1, c >> 8 & 255] ^ SHIFT[step, 2, c >> 16 & 255] ^ SHIFT[step, 3, c >> 24]
        left[live] -= step
        live = live[left[live] > 0]
    return crc


def crc_words(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans, byte by byte over all spans at once."""
    raw = np.frombuffer(data, np.uint8)
    out = np.empty(len(start), np.uint32)
    long = np.flatnonzero(end - start > LONG)
    for i in long:
        out[i] = zlib.crc32(data[start[i]:end[i]])
    live = np.flatnonzero(end - start <= LONG)
    live = live[np.argsort((start - end)[live], kind="stable")]     # longest first: those still open are a prefix
    size = (end - start)[live]
    still = np.searchsorted(-size, -np.arange(LONG + 1), side="left")   # spans longer than k bytes
    at, c = start[live], np.full(len(live), 0xFFFFFFFF, np.uint32)
    for k in range(int(size[0]) if len(size) else 0):
        m = still[k]
        c[:m] = BYTE[(c[:m] ^ raw[at[:m] + k]) & 255] ^ (c[:m] >> 8)
    out[live] = c ^ np.uint32(0xFFFFFFFF)
    return out


SPACE = np.uint32(zlib.crc32(b" "))


def runs(texts: list[bytes], n: int, buckets: int, scan: regex.Pattern) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice: (byte place, bucket) of every feature and the byte places of the words."""
    for padded, starts in spans(texts, n, scan):
        own = len(starts) - n
        size = starts[1:] - 1 - starts[:-1]
        word = crc_words(padded, starts[:-1], starts[1:] - 1)
        real = np.frombuffer(padded, np.uint8)[starts[:-1]] > 0
        joined = shifted(np.full(len(word), SPACE), size) ^ word       # CRC of the word behind a space
        run, whole, places, found = word[:own], real[:own], [], []
        for k in range(n):
            if k:
                run = shifted(run, size[k:own + k] + 1) ^ joined[k:own + k]
                whole = whole & real[k:own + k]
            places.append(starts[:own][whole])
            found.append(run[whole] % np.uint32(buckets))
        yield np.concatenate(places), np.concatenate(found).astype(np.int64), places[0]


def groups(texts: list[bytes], n: int) -> Iterator[slice]:
    """Neighbouring texts that fit one slice together; a longer text alone."""
    lo, held = 0, 2 * n + 1
    for i, words in enumerate(texts):
        size = len(words) + 2 * n + 1
        if i > lo and held + size > 2 * AT_ONCE:
            yield slice(lo, i)
            lo, held = i, 2 * n + 1
        held += size
    if lo < len(texts):
        yield slice(lo, len(texts))


def packed_buckets(raw: list[str | None], n: int, buckets: int, scan: regex.Pattern) -> Iterator[tuple[int, int, bytes]]:
    """Per text: words, features, and its bucket numbers in ascending order as 16-bit differences."""
    texts = [collapse(t) for t in raw]
    for group in groups(texts, n):
        members = texts[group]
        begin = np.cumsum([0] + [len(w) + 1 + 2 * n if w else 2 * n for w in members])
        if len(members) == 1:       # perhaps of many slices: only counts are held
            total, n_words = np.zeros(buckets, np.int64), 0
            for _, ids, words in runs(members, n, buckets, scan):
                total += np.bincount(ids, minlength=buckets)
                n_words += len(words)
            hit = np.flatnonzero(total)
            keys, counts = np.repeat(hit, total[hit]), np.array([n_words])
        else:
            (place, ids, words), = runs(members, n, buckets, scan)
            keys = np.sort((np.searchsorted(begin, place, side="right") - 1) * buckets + ids)
            counts = np.bincount(np.searchsorted(begin, words, side="right") - 1, minlength=len(members))
        bounds = np.searchsorted(keys, np.arange(len(members) + 1) * buckets)
        steps = np.diff(keys, prepend=0)
        first = bounds[:-1][bounds[:-1] < bounds[1:]]
        steps[first] = keys[first] % buckets
        data = steps.astype("<u2").tobytes()
        for i in range(len(members)):
            yield int(counts[i]), int(bounds[i + 1] - bounds[i]), data[2 * bounds[i]:2 * bounds[i + 1]]


def unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, "<u2"), dtype=np.int64)


def hashed(df: DataFrame, key: str, text: str, n: int, buckets: int) -> DataFrame:
    """(key, n_words, n_features, packed) per row."""
    if buckets > 1 << 16:
        raise ValueError("bucket numbers take 16 bits")

    def scan_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scan = scanner(n)
        for batch in batches:
            if not len(batch):
                continue
            n_words, n_features, packed = zip(*packed_buckets(batch["text"].tolist(), n, buckets, scan))
            yield pd.DataFrame({"key": batch["key"], "n_words": n_words, "n_features": n_features, "packed": packed})

    return df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(
        scan_texts, "key string, n_words long, n_features long, packed binary")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows: partial counts per task, ``buckets`` numbers at the end."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch["packed"]:
                total += np.bincount(unpack(packed), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": hit, "n": total[hit]})

    out = np.zeros(buckets, np.int64)
    partial = rows.select("packed").mapInPandas(count, "bucket int, n long")
    for bucket, n in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():    # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of each bucket, rounded down."""
    b = float(len(source))
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise from a digest of seed and key, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key, F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(df: DataFrame, key: str, text: str, target: DataFrame, target_text: str, n: int = 3, buckets: int = BUCKETS,
             min_words: int = 20, percent: int = 5, seed: int = 42) -> DataFrame:
    """Per row: key, n_words, n_features, weight, score and ``rank`` (1, 2, ... for the drawn ones, else null)."""
    kind = df.schema[key].dataType
    rows = cut(hashed(df, key, text, n, buckets), "resample-buckets")
    wanted = hashed(target.withColumn("__key", F.lit(None).cast("string")), "__key", target_text, n, buckets)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))

    @F.pandas_udf("long")
    def weigh(packed: pd.Series) -> pd.Series:
        return pd.Series([int(gain[unpack(p)].sum()) for p in packed], dtype="int64")

    scored = rows.select(F.col("key").cast(kind).alias(key), "n_words", "n_features", weigh("packed").alias("weight"),
                         gumbel(F.col("key"), seed).alias("noise"))
    scored = scored.select(key, "n_words", "n_features", "weight", (F.col("weight") + F.col("noise")).alias("score"))
    drawn = percent * rows.where(F.col("n_words") >= min_words).count() // 100
    return _ranked(scored, key, F.col("n_words") >= min_words, drawn)


def _ranked(scored: DataFrame, key: str, eligible: Column, drawn: int) -> DataFrame:
    """``rank`` by descending score: sorted by ranges, each range's first number from the row counts before it."""
    order = [F.desc("__eligible"), F.desc("score"), F.asc_nulls_last(key), F.desc("weight"), F.desc("n_features"), F.asc("__tie")]
    rows = scored.withColumn("__eligible", eligible).withColumn("__tie", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    placed = cut(placed.drop("__tie"), "resample-order")
    # The id is (partition number, place in it): the ranges follow each other, so counts before a partition number its rows.
    part, within = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, first = 0, {}
    for p, n_rows in counts:    # one row per partition
        first[str(p)] = before
        before += n_rows
    table = F.from_json(F.lit(json.dumps(first)), "map<string,long>")
    rank = table[part.cast("string")] + within + 1
    return placed.withColumn("rank", F.when(F.col("__eligible") & (rank <= drawn), rank)).drop("__eligible", "__place")
