"""Quality classifier from weak labels (operator 9).

Labellers are heuristics over text measures; each votes good (1), bad (0) or abstains. A
generative model with hidden quality y and votes independent given y is fitted by
expectation-maximisation: P(y) and, per labeller, P(vote | y), so accuracies of overlapping labellers come from
their agreement alone, without labels. The model only needs how often each vote pattern occurs:
one count over all documents, at most 3**len(LABELLERS) rows.

The posterior of a document's pattern is its label (a probability). A linear model on hashed words and
word shapes, averaged over the words of a text, learns the posteriors of a bounded sample: the first ``SAMPLE_ROWS``
documents by hash on either side of 0.5, ``SAMPLE_WORDS`` words at most and of one document its first ``DOCUMENT_WORDS`` (so no
long document takes the place of the others), weighted to the sides' shares. It
scores every document.

Defined cases: a null or empty text has no words; its score is the model's intercept and its posterior that of its
pattern; repeated rows score alike; an empty table gives an empty table; columns named like the added ones are replaced. Texts are
read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.common import as_row, cut, from_row
from runlens.llm.linear import Sample, Scorer, sigmoid, train
from runlens.llm.quality_rules import apply_rules

HASH_BITS = 18
ROUNDS = 200
SMOOTHING = 0.01
SAMPLE_ROWS = 3000
SAMPLE_WORDS = 3_000_000
DOCUMENT_WORDS = 100_000
ABSTAIN = -1


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1).otherwise(ABSTAIN)


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def labellers() -> dict[str, Column]:
    """Name -> vote; columns are those of the quality rules."""
    c = F.col
    some = c("n_words") > 0
    enough = c("n_words") >= 20          # a share of fewer words says little
    repeats = _ratio("n_repeat_words", "n_words")
    return {
        "words": _vote(c("n_words") >= 50, ~some),
        "stop_words": _vote(c("stop_word_ratio") >= 0.08, enough & (c("stop_word_ratio") < 0.03)),
        "symbols": _vote(some & (c("symbol_ratio") < 0.005), c("symbol_ratio") > 0.03),
        "capitals": _vote(some & (c("capital_ratio") < 0.2), enough & (c("capital_ratio") > 0.4)),
        "repeats": _vote(some & (repeats < 0.1), repeats > 0.4),
        "word_length": _vote(c("mean_word_length").between(3.5, 8.0), ~c("mean_word_length").between(2.5, 10.0)),
        "lines": _vote(some & (c("dup_line_ratio") < 0.1), c("dup_line_ratio") > 0.4),
    }


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """(prior of good, P(vote | y) as [labeller, y, vote + 1], posterior of good per pattern).

    Starts from each pattern's share of good votes, so y = 1 is the side the labellers call good.
    """
    n, k = patterns.shape
    cast = patterns != ABSTAIN
    posterior = ((patterns == 1).sum(1) + 0.5) / (cast.sum(1) + 1.0)
    total = counts.sum()
    one_hot = np.stack([patterns == v for v in (ABSTAIN, 0, 1)], axis=2).astype(float)  # [pattern, labeller, vote]
    prior, table = 0.5, np.full((k, 2, 3), 1 / 3)
    for _ in range(rounds):
        weights = np.stack([counts * (1 - posterior), counts * posterior])               # [y, pattern]
        prior = float(np.clip(weights[1].sum() / total, 1e-6, 1 - 1e-6))
        table = np.einsum("yp,pkv->kyv", weights, one_hot) + SMOOTHING * total / 100
        table /= table.sum(axis=2, keepdims=True)
        logs = np.einsum("pkv,kyv->py", one_hot, np.log(table)) + np.log([1 - prior, prior])
        new = sigmoid(logs[:, 1] - logs[:, 0])
        done = np.abs(new - posterior).max() < 1e-10
        posterior = new
        if done:
            break
    return prior, table, posterior


AGAIN = "\x01again"


def tokens(text: str | None) -> list[str]:
    """The words, and a mark for each that repeats the word before it."""
    ws = (text or "").split()
    return ws + [AGAIN] * sum(a == b for a, b in zip(ws, ws[1:]))


# Letters to A or a, digits to 0, over the Latin blocks; other characters stand for themselves.
SHAPE = {c: "0" if chr(c).isdigit() else "A" if chr(c).isupper() else "a" for c in range(0x250) if chr(c).isalnum()}
RUN = re.compile(r"(.)\1+")


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hashed feature): each word and its shape, runs in it as one."""
    size = (1 << HASH_BITS) - 1
    own = [xxhash.xxh32_intdigest("w" + w) & size for w in words]
    shapes = [xxhash.xxh32_intdigest("s" + RUN.sub(r"\1", w.translate(SHAPE))) & size for w in words]
    n = np.arange(len(words))
    return np.concatenate([n, n]), np.array(own + shapes, np.int64)


def classify(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with ``votes`` (array, in labeller order), ``posterior``, ``score`` and ``kept`` (score >= 0.5)."""
    spark = df.sparkSession
    rows = as_row(df)
    judged = apply_rules(rows.select("row", F.col("row").getField(text).alias("t")), "t")
    voted = judged.select("row", F.array(*labellers().values()).alias("votes"))
    # Votes beside a key: later steps read these few bytes, and the texts once more.
    votes = cut(voted.select(F.col("row").getField(key).alias("key"),
                             F.xxhash64(F.col("row").getField(text)).alias("digest"), "votes"), "weak-votes")
    pattern_counts = votes.groupBy("votes").agg(F.count("*").alias("n")).collect()   # <= 3 ** labellers rows
    if not pattern_counts:
        none = rows.withColumn("votes", F.array().cast("array<int>")).withColumn("posterior", F.lit(0.5)) \
            .withColumn("score", F.lit(0.5)).withColumn("kept", F.lit(True))
        return from_row(none, "votes", "posterior", "score", "kept")
    patterns = np.array([r["votes"] for r in pattern_counts], np.int64)
    counts = np.array([r["n"] for r in pattern_counts], float)
    _, _, posterior = em(patterns, counts)
    known = spark.createDataFrame([(list(map(int, p)), float(q)) for p, q in zip(patterns, posterior)],
                                  "votes array<int>, posterior double")
    labelled = votes.join(F.broadcast(known), "votes")                               # same bound
    weights, intercept = _fit(df, key, text, labelled)
    held = spark.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(held.value, intercept, features, mean=True)
        for texts in batches:
            yield pd.Series(scorer.scores(texts.tolist(), tokens))

    one = labelled.select("key", "digest", "votes", "posterior").dropDuplicates(["key", "digest"])
    scores = rows.select("row", F.col("row").getField(key).alias("k"), F.xxhash64(F.col("row").getField(text)).alias("d"),
                         scored(F.col("row").getField(text)).alias("score"))
    out = scores.join(one, F.col("k").eqNullSafe(F.col("key")) & (F.col("d") == F.col("digest")))
    return from_row(out.withColumn("kept", F.col("score") >= 0.5), "votes", "posterior", "score", "kept")


def _fit(df: DataFrame, key: str, text: str, labelled: DataFrame) -> tuple[np.ndarray, float]:
    good = F.col("posterior") >= 0.5
    shares = {r["good"]: r["n"] for r in labelled.groupBy(good.alias("good")).agg(F.count("*").alias("n")).collect()}
    sample, labels, weights = Sample(features, 1 << HASH_BITS), [], []
    texts = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    for side, n in sorted(shares.items()):
        first = (labelled.where(good == F.lit(side)).select("key", "digest", "posterior", F.xxhash64("key", "digest").alias("h"))
                 .orderBy("h").limit(SAMPLE_ROWS))
        found = (texts.join(F.broadcast(first), F.col("k").eqNullSafe(F.col("key")) & (F.xxhash64("t") == F.col("digest")))
                 .select("h", "posterior", "t").dropDuplicates(["h"]))
        ws = F.split(F.coalesce("t", F.lit("")), r"\s+")
        long = F.size(ws) > DOCUMENT_WORDS
        found = found.select("h", "posterior", F.least(F.size(ws), F.lit(DOCUMENT_WORDS)).alias("n"),
                             F.when(long, F.array_join(F.slice(ws, 1, DOCUMENT_WORDS), " ")).otherwise(F.col("t")).alias("t"))
        upto = F.sum("n").over(Window.orderBy("h"))
        n_found = 0
        for r in found.withColumn("upto", upto).where(F.col("upto") <= SAMPLE_WORDS // 2).select("posterior", "t").toLocalIterator():
            sample.add(tokens(r["t"]))
            labels.append(r["posterior"])
            n_found += 1
        weights += [n / max(1, n_found)] * n_found
    w = np.array(weights)
    return train(sample, np.array(labels, float), w * len(w) / max(w.sum(), 1e-300), mean=True, penalty=0.01)
