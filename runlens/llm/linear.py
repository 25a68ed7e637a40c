"""A linear classifier over hashed features of words: training by L-BFGS, scoring by cached word scores.

A document's logit is a sum over its words of the words' features, so a word's share of it is one number:
scoring looks that number up, and training works on two sparse layers (documents -> words -> features)
instead of their much larger product.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np

CACHE_WORDS = 600_000
WORDS_AT_ONCE = 50_000
TEXTS_AT_ONCE = 500


# The features of some words: (number of the word, feature) pairs.
WordFeatures = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class Layer:
    """Sparse rows as (row, column) pairs."""

    def __init__(self, row: np.ndarray, of: np.ndarray, rows: int, columns: int):
        self.row, self.of, self.rows, self.columns = row, of, rows, columns

    def forward(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, x[self.of], self.rows)

    def backward(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, g[self.row], self.columns)


class Sample:
    """Training documents, kept as numbers."""

    def __init__(self, features: WordFeatures, size: int):
        self.features, self.size = features, size
        self._number: dict[str, int] = {}
        self._words, self.lengths = array("i"), array("i")

    def add(self, words) -> None:
        number = self._number
        self._words.extend([number.setdefault(w, len(number)) for w in words])
        self.lengths.append(len(words))

    def layers(self) -> tuple[Layer, Layer]:
        """documents -> words, words -> features."""
        n, v = len(self.lengths), len(self._number)
        doc = np.repeat(np.arange(n, dtype=np.int32), np.array(self.lengths, np.int32))
        row, of = self.features(list(self._number))
        return Layer(doc, np.array(self._words, np.int32), n, v), Layer(row.astype(np.int32), of.astype(np.int32), v, self.size)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def lbfgs(f: Callable, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Minimise f (returning value and gradient) from x."""
    value, grad = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ q)
            alphas.append(a)
            q -= a * y
        if pairs:
            s, y, _ = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y, rho), a in zip(pairs, reversed(alphas)):
            q += s * (a - rho * (y @ q))
        slope = -(grad @ q)
        if slope > -1e-12:
            return x
        step = 1.0 if pairs else min(1.0, 1.0 / np.sqrt(grad @ grad))
        while True:
            new = x - step * q
            new_value, new_grad = f(new)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
            if step < 1e-10:
                return x
        s, y = new - x, new_grad - grad
        if s @ y > 1e-12:
            pairs = [*pairs[1 - memory:], (s, y, 1.0 / (s @ y))] if len(pairs) >= memory else [*pairs, (s, y, 1.0 / (s @ y))]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        x, value, grad = new, new_value, new_grad
        if done:
            return x
    return x


def train(sample: Sample, labels: np.ndarray, weights: np.ndarray, scale: np.ndarray | None = None, mean: bool = False,
          penalty: float = 1.0, steps: int = 80) -> tuple[np.ndarray, float]:
    """(feature weights, intercept) of a logistic model; ``labels`` may be probabilities.

    ``scale`` multiplies each feature; ``mean`` divides a document's sum by its words.
    """
    upper, lower = sample.layers()
    size = sample.size
    scale = np.ones(size) if scale is None else scale
    div = np.maximum(np.array(sample.lengths), 1) if mean else np.ones(upper.rows)
    total = weights.sum()

    def loss(x):
        w, b = x[:-1], x[-1]
        z = upper.forward(lower.forward(w * scale)) / div + b
        p = sigmoid(z)
        value = (weights * (np.logaddexp(0, z) - labels * z)).sum() / total + penalty / total * (w @ w) / 2
        d = weights * (p - labels) / total
        return value, np.append(lower.backward(upper.backward(d / div)) * scale + penalty / total * w, d.sum())

    prior = np.clip((weights * labels).sum() / total, 1e-6, 1 - 1e-6) if total else 0.5
    x = np.append(np.zeros(size), np.log(prior / (1 - prior)))
    if total:
        x = lbfgs(loss, x, steps)
    return x[:-1] * scale, float(x[-1])


class Scorer:
    """Logits of documents, by the scores of their words (kept, up to a bound, per task)."""

    def __init__(self, weights: np.ndarray, intercept: float, features: WordFeatures, mean: bool = False):
        self.weights, self.intercept, self.features, self.mean = weights, intercept, features, mean
        self.known: dict[str, float] = {}

    def logits(self, docs: list) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        new = list(set().union(*docs).difference(known))
        for at in range(0, len(new), WORDS_AT_ONCE):
            some = new[at:at + WORDS_AT_ONCE]
            row, of = self.features(some)
            known.update(zip(some, np.bincount(row, self.weights[of], len(some)).tolist()))
        sums = np.array([sum(map(known.__getitem__, ws)) for ws in docs], float)
        if self.mean:
            sums /= np.maximum(np.array([len(ws) for ws in docs]), 1)
        return sums + self.intercept

    def scores(self, texts, words_of: Callable) -> np.ndarray:
        out = [np.zeros(0)]
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            out.append(sigmoid(self.logits([words_of(t) for t in texts[at:at + TEXTS_AT_ONCE]])))
        return np.concatenate(out)
