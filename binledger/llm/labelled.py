"""Labelled samples and the lasso-logistic fit that the two text classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier is fitted on at most (about: rows are taken by their hash).
SAMPLE = 16_000


def remainder(key: str) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5))


def held_out(key: str) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(remainder(key) == 0, F.lit(False))


def sample_of(labels: DataFrame, label: str, key: str = "doc_id", most: int = SAMPLE) -> DataFrame:
    """(key, label) of about ``most`` labelled rows that may be learned from, the same ones in every run.

    Rows with a NULL key or label, or a label other than 0 and 1, are left out. A key with several labels gives one
    row, its largest label.
    """
    given = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key)).select(
        key, F.col(label).cast("int").alias("label")
    )
    count = given.count()
    share = int(min(1.0, most / max(count, 1)) * (1 << 30))
    chosen = given.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < share)
    return chosen.groupBy(key).agg(F.max("label").alias("label"))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Rows:
    """Rows of 0/1 or signed features as (index, value) lists, with products by whole-array operations."""

    def __init__(self, rows: list[list[tuple[int, float]]], width: int) -> None:
        self.count, self.width = len(rows), width
        sizes = [len(r) for r in rows]
        self.row = np.repeat(np.arange(len(rows)), sizes)
        self.column = np.array([i for r in rows for i, _ in r], np.int64)
        self.value = np.array([v for r in rows for _, v in r], np.float64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.count) if len(self.row) else np.zeros(self.count)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], self.width) if len(self.row) else np.zeros(self.width)


def lasso_logistic(x: Rows, y: np.ndarray, penalty: float, pairs: Rows | None = None, pair_penalty: float = 0.0,
                   rounds: int = 300, balance: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise mean log loss + penalty * |w| + pair_penalty * mean((w . pair)^2).

    ``balance`` between 0 and 1 weighs the rows of a class by its share to that power, inverted; at 1 both classes
    weigh the same, and a score is then no longer the share of label 1.

    Accelerated proximal gradient with a step that is halved until the smooth part is bounded by its model. With labels
    of one class only, all weights are 0 and the intercept is the smoothed log-odds of the labels.
    """
    n = max(len(y), 1)
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    w, b = np.zeros(x.width), base
    if len(np.unique(y)) < 2 or not x.width:
        return w, base
    m = max(pairs.count, 1) if pairs is not None else 1
    share = np.where(y > 0, y.mean(), 1 - y.mean()) ** -balance
    share *= n / share.sum()

    def smooth(w: np.ndarray, b: float, slope: bool):
        z = x.dot(w) + b
        value = np.mean(share * (np.logaddexp(0, z) - y * z))
        gap = pairs.dot(w) if pairs is not None and pair_penalty else None
        if gap is not None:
            value += pair_penalty * np.sum(gap * gap) / m
        if not slope:
            return value
        r = share * (sigmoid(z) - y) / n
        g = x.back(r)
        if gap is not None:
            g += pairs.back(2 * pair_penalty * gap / m)
        return value, g, r.sum()

    vw, vb, t, step = w.copy(), b, 1.0, 64.0
    for _ in range(rounds):
        value, g, gb = smooth(vw, vb, True)
        while True:
            nw = vw - step * g
            nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
            nb = vb - step * gb
            dw, db = nw - vw, nb - vb
            if smooth(nw, nb, False) <= value + g @ dw + gb * db + (dw @ dw + db * db) / (2 * step) + 1e-12:
                break
            step /= 2
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        moved = np.abs(nw - w).max(initial=0) + abs(nb - b)
        w, b, t = nw, nb, nt
        if moved < 1e-5:
            break
    return w, b
