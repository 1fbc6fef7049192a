"""Quality classifier: Bradley-Terry pairwise ranking over text features.

Pairs of a good and a bad training text are preferences. A weight vector is
fitted by logistic loss on the differences of their features (the
Bradley-Terry model: P(a preferred to b) = sigmoid(w (f(a) - f(b)))), so
``w f(text)`` ranks texts. The cut is a quantile of the training scores: the
level that best separates the two labels. Scores are shifted so that the cut
lies at ``CUT``.

Only the fit sees a sample: at most ``MAX_PER_CLASS`` labelled texts of each
class, those with the least hash of their id. Every text is scored whole.

Defined cases: null and empty texts have all features zero and get the score
that follows from them; labels that are null, or contradict each other for one
id, are left out, repeated ones count once; a repeated labelled row is used
once; without labels of both classes every text scores ``CUT``; extra columns
pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PER_CLASS = 8_000
PAIRS_EACH = 8                 # bad texts that each good text is paired with
CUT = 0.7
RIDGE = 1e-3
BASIC = 13
_SYMBOLS = "%&$#*@^~|<>{}[]=+_\\!"
_PLAIN = frozenset(".,:;?!'\"-()")


def features(text: str) -> list[float]:
    """Shape of a text: lengths, letters, capitals, repeats, symbols and lines, each within fixed bounds."""
    words = text.split()
    if not words:
        return [0.0] * BASIC
    n, m = len(text), len(words)
    vocabulary = set(words)
    lines = text.split("\n")
    letters = sum(map(str.isalpha, text))
    digits = sum(map(str.isdigit, text))
    upper = sum(len(w) > 1 and w.isupper() for w in words)
    odd = sum(not w.isalnum() and any(not c.isalnum() and c not in _PLAIN for c in w) for w in words)
    pairs = len(set(zip(words, words[1:])))
    same = sum(a == b for a, b in zip(words, words[1:]))
    symbols = sum(map(text.count, _SYMBOLS))
    stops = sum(map(text.count, ".,;:?"))
    return [min(np.log1p(m), 12.0) / 12, letters / n, upper / m, same / m, 1 - pairs / max(1, m - 1) if m > 1 else 0.0,
            min(symbols / m, 3.0), min(stops / m, 2.0), odd / m, 1 - len(set(lines)) / len(lines), len(vocabulary) / m,
            min(n / m, 40.0) / 10, digits / n, min(len(lines) / m, 1.0)]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def feature_udf(texts: pd.Series) -> pd.Series:
    return pd.Series([features(t or "") for t in texts], dtype=object)


def held_out(key: str | Column) -> Column:
    """The fold that no label is learned from: crc32 of the id as text, modulo 4, is 2."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(c.cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Ranking:
    """A fitted model: standardised features and their squares, weights, and the cut."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack((z, z * z))

    def latent(self, x: np.ndarray) -> np.ndarray:
        """Score above the cut (log-odds)."""
        return self._design(x) @ self.weights - self.cut


def fit(x: np.ndarray, good: np.ndarray) -> Ranking:
    """Fit on feature rows ``x`` with boolean labels ``good`` (in a fixed order of the rows)."""
    if not len(x) or good.all() or not good.any():
        return Ranking(np.zeros(BASIC), np.ones(BASIC), np.zeros(2 * BASIC), 0.0)
    model = Ranking(x.mean(axis=0), x.std(axis=0) + 1e-9, np.zeros(2 * BASIC), 0.0)
    d = model._design(x)
    win, lose = d[good], d[~good]
    i = np.arange(max(len(win), len(lose)))
    diff = np.concatenate([win[i % len(win)] - lose[(i * 7919 + k * 104729) % len(lose)] for k in range(PAIRS_EACH)])
    w = np.zeros(d.shape[1])
    for _ in range(30):                                 # Newton's method on the logistic loss of the differences
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -40, 40)))
        grad = diff.T @ (p - 1) / len(diff) + RIDGE * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = w
    s = d @ w
    order = np.argsort(s, kind="stable")
    # balanced accuracy if the lowest k training scores are rejected
    bad = np.concatenate(([0], np.cumsum(~good[order]))) / (~good).sum()
    lost = np.concatenate(([0], np.cumsum(good[order]))) / good.sum()
    gain = bad - lost
    k = np.flatnonzero(gain == gain.max())
    level = k[len(k) // 2] / len(s)                     # the quantile level of the cut
    below, above = int(round(level * len(s))) - 1, int(round(level * len(s)))
    model.cut = float((s[order[max(below, 0)]] + s[order[min(above, len(s) - 1)]]) / 2)
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Ranking:
    """Fit on the labelled texts outside the held-out fold."""
    clean = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
             .groupBy(F.col(key).alias("k")).agg(F.min(label).alias("lo"), F.max(label).alias("hi")).where("lo = hi"))
    some = [clean.where(F.col("lo") == v).orderBy(F.xxhash64("k"), "k").limit(MAX_PER_CLASS) for v in (0, 1)]
    sample = F.broadcast(some[0].union(some[1]).select("k", "lo"))       # at most 2 * MAX_PER_CLASS rows
    found = (docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("body")).join(sample, "k")
             .select("k", "lo", feature_udf("body").alias("f")))
    rows = found.groupBy("k").agg(F.min(F.struct("lo", "f")).alias("r")).select("k", "r.lo", "r.f").toArrow()
    order = np.argsort(rows.column("k").to_numpy(), kind="stable")
    x = np.array(rows.column("f").to_pylist(), float).reshape(-1, BASIC)[order]
    return fit(x, rows.column("lo").to_numpy()[order] == 1)


def score(docs: DataFrame, model: Ranking, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus ``out``: 0 to 1, at least ``CUT`` if and only if the ranking puts the text above the cut."""
    def scored(texts: pd.Series) -> pd.Series:
        x = np.array([features(t or "") for t in texts], float).reshape(-1, BASIC)
        s = model.latent(x)
        p = 1 / (1 + np.exp(-np.clip(s, -500, 500)) * (1 - CUT) / CUT)
        return pd.Series(np.where(s >= 0, np.maximum(p, CUT), np.minimum(p, np.nextafter(CUT, 0))))

    return docs.withColumn(out, F.pandas_udf(scored, "double")(F.coalesce(F.col(text), F.lit(""))))
