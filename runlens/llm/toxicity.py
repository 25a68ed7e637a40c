"""Toxicity by character n-grams scaled by naive Bayes log-count ratios (operator 5).

Features: the hashed character n-grams (``SHORT`` to ``LONG``, with word ends) of a document's distinct lower-cased words.
Every feature f is scaled by ``r_f = log((p_f / |p|) / (q_f / |q|))`` where p and q count the toxic and
the other training documents that hold it, plus ``SMOOTHING``. A logistic model is trained on the scaled features.

The counts cover all training rows and are summed in Spark: 2**``HASH_BITS`` features, whatever the input. The
logistic model is fitted on a bounded sample: at most ``SAMPLE_ROWS`` rows of each class, the first by hash, and
``SAMPLE_WORDS`` distinct words altogether, of one document its first ``DOCUMENT_WORDS`` (so no long document takes the place
of the others), weighted to the classes' shares of all training rows. Scoring covers all rows.

Defined cases: null and empty texts have no features and the score of the intercept; rows whose label is null or that match no
document are not learned from; several labels of a key are several rows; without labelled rows of both classes the
score is the share of label 1 among them (0.5 without any); repeated rows score alike; an empty table gives an empty table; columns named like
the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import as_row, cut, from_row
from runlens.llm.linear import Sample, Scorer, train

SHORT, LONG = 3, 5
HASH_BITS = 18
BASE, MULTIPLIER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SMOOTHING = 1.0
SAMPLE_ROWS = 3000
SAMPLE_WORDS = 3_000_000
DOCUMENT_WORDS = 100_000


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hashed feature) of the character n-grams of each word between its ends, by rolling hashes."""
    joined = "".join([f"\x02{w}\x03" for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))    # characters to the word's end
    h, rows, features = codes.copy(), [], []
    for n in range(2, LONG + 1):
        if n > len(codes):
            break
        h = h[:-1] * BASE + codes[n - 1:]
        if n >= SHORT:
            at = np.flatnonzero(left[:len(h)] >= n)
            x = (h[at] + np.uint64(n)) * MULTIPLIER
            features.append(((x ^ (x >> np.uint64(32))) * MULTIPLIER >> np.uint64(64 - HASH_BITS)).astype(np.int32))
            rows.append(word[at])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(rows), np.concatenate(features)


def distinct_words(text: str | None) -> list[str]:
    """The distinct lower-cased words of a text, in its order: sums of their weights come out the same on every run."""
    return list(dict.fromkeys((text or "").lower().split()))


def _count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents that hold each feature, by class; one row per feature seen in the task."""
    size = 1 << HASH_BITS
    counts = np.zeros((2, size), np.int64)
    for batch in batches:
        for text, label in zip(batch["words"], batch["label"]):
            counts[label, np.unique(ngrams(distinct_words(text))[1])] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"feature": seen, "others": counts[0, seen], "toxic": counts[1, seen]})


def fit(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and intercept from (key, words, label) rows."""
    shares = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = shares.get(0, 0), shares.get(1, 0)
    size = 1 << HASH_BITS
    if not n0 or not n1:
        share = 0.5 if n0 == n1 else n1 / (n0 + n1)
        share = min(max(share, 1e-6), 1 - 1e-6)
        return np.zeros(size), float(np.log(share / (1 - share)))
    summed = (labelled.select("words", "label").mapInPandas(_count_rows, "feature long, others long, toxic long")
              .groupBy("feature").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic")).toArrow())
    p, q = np.full(size, SMOOTHING), np.full(size, SMOOTHING)
    at = summed["feature"].to_numpy()     # at most ``size`` rows
    p[at] += summed["toxic"].to_numpy()
    q[at] += summed["others"].to_numpy()
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())

    sample, labels, weights = Sample(ngrams, size), [], []
    ws = F.split("words", " ")
    some = F.when(F.size(ws) > DOCUMENT_WORDS, F.array_join(F.slice(ws, 1, DOCUMENT_WORDS), " ")).otherwise(F.col("words"))
    for label, n in ((0, n0), (1, n1)):
        own = labelled.where(F.col("label") == label).withColumn("h", F.xxhash64("key", "words"))
        # The first by hash without their texts; then the texts of these few.
        upto = F.sum("n").over(Window.orderBy("h"))
        first = (own.groupBy("h").agg(F.max(F.least(F.size(ws), F.lit(DOCUMENT_WORDS))).alias("n")).orderBy("h").limit(SAMPLE_ROWS)
                 .withColumn("upto", upto).where(F.col("upto") <= SAMPLE_WORDS // 2).select("h"))
        found = 0
        drawn = own.join(F.broadcast(first), "h").groupBy("words").agg(F.min("h").alias("h"))
        for r in drawn.orderBy("h", "words").select(some.alias("words")).toLocalIterator():
            sample.add(distinct_words(r["words"]))
            found += 1
        labels += [label] * found
        weights += [n / max(1, found)] * found
    w = np.array(weights)
    return train(sample, np.array(labels, float), w * len(w) / w.sum(), scale=ratio)


def score(df: DataFrame, text: str, weights: np.ndarray, intercept: float) -> DataFrame:
    """``df`` with ``score``."""
    held = df.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(held.value, intercept, ngrams)
        for texts in batches:
            yield pd.Series(scorer.scores(texts.tolist(), distinct_words))

    rows = as_row(df)
    return from_row(rows.withColumn("score", scored(F.col("row").getField(text))), "score")


def classify(df: DataFrame, key: str, text: str, labels: DataFrame, label: str, train_on) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted``; learns from the rows of ``labels`` where ``train_on(key column)``."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    known = known.where(train_on(F.col("key")))
    # Only a text's distinct words travel to its label.
    words = F.array_join(F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+")), " ")
    texts = df.select(F.col(key).alias("key"), words.alias("words")).where(train_on(F.col("key")))
    labelled = cut(texts.hint("merge").join(known, "key"), "toxicity-labelled")
    out = score(df, text, *fit(labelled))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
