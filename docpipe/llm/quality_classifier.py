"""Text quality by naive Bayes support vectors.

A text is the set of its n-grams: its words, and runs of one to three word shapes (case, digits,
the very symbols, and whether a word repeats the one before). Indicators are scaled by the log
ratio of how often the n-gram occurs in good and bad texts; a linear hinge-loss model is fitted
to the scaled indicators by dual coordinate descent, and its margins are calibrated on labelled
rows set apart.

Defined cases: null and empty texts are scored like any other. Without labels of both classes the score is the
share of the class there is, or one half without any. Rows are never merged, so repeated rows and ids each get theirs; an empty table gives no
rows. Very long texts are read whole, each n-gram counts once. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.llm.common import crc_bucket
from docpipe.llm.labelled import MOST_ROWS, Rows, calibration, platt, sample_ids, sampled_rows, scored, sigmoid

BITS = 18
FOLDS = 3
_TOKEN = re.compile(r"[^\W\d_]+|\d+|\n|[^\w\s]+|_+")


@dataclass(frozen=True)
class Settings:
    most_rows: int = MOST_ROWS  # labelled documents to learn from
    least_documents: int = 4
    smoothing: float = 1.0
    cost: float = 0.1
    epochs: int = 15


def _shape(token: str, before: str) -> str:
    if token == before:
        return "="
    if token[0].isalpha():
        return "A" if len(token) > 1 and token.isupper() else "a"
    return "0" if token[0].isdigit() else token[:4]


def _number(gram: str) -> int:
    return xxhash.xxh3_64_intdigest(gram) >> (64 - BITS)


def features(text: str) -> np.ndarray:
    """The numbers of the n-grams of a whole text, each once, ascending."""
    tokens = _TOKEN.findall(text)
    shapes = list(map(_shape, tokens, ["", *tokens[:-1]]))
    grams = {f"w {t}" for t in set(map(str.lower, tokens))}
    grams.update(f"s {a}" for a in set(shapes))
    grams.update(f"s {a} {b}" for a, b in set(zip(shapes, shapes[1:])))
    grams.update(f"s {a} {b} {c}" for a, b, c in set(zip(shapes, shapes[1:], shapes[2:])))
    grams.add("n " + str(len(tokens).bit_length()))  # the length's order of magnitude, as one more indicator
    return np.unique(np.fromiter(map(_number, grams), np.int64, len(grams)))


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    offset: float

    def score(self, text: str) -> float:
        return float(sigmoid(self.slope * self.weights[features(text)].sum() + self.offset))


def log_count_ratios(rows: Rows, settings: Settings) -> np.ndarray:
    """Log ratio of each n-gram's share among good and bad texts; 0 for rare n-grams."""
    d = 1 << BITS
    good = np.bincount(rows.index[rows.y[rows.of] == 1], minlength=d) + settings.smoothing
    bad = np.bincount(rows.index[rows.y[rows.of] == 0], minlength=d) + settings.smoothing
    ratio = np.log(good / (rows.y.sum() + 2 * settings.smoothing)) - np.log(bad / ((1 - rows.y).sum() + 2 * settings.smoothing))
    return np.where(good + bad - 2 * settings.smoothing >= settings.least_documents, ratio, 0.0)


def descend(rows: Rows, ratio: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss: one multiplier per row, kept in its box.

    Both classes have the same total cost. The last weight belongs to a constant feature.
    """
    n = len(rows)
    sign = np.where(rows.y == 1, 1.0, -1.0)
    box = settings.cost * n / 2 / np.where(rows.y == 1, rows.y.sum(), n - rows.y.sum())
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(n)
    values = [ratio[rows.row(i)] for i in range(n)]
    square = np.array([v @ v for v in values]) + 1.0
    order = np.random.default_rng(7)
    for _ in range(settings.epochs):
        moved = 0.0
        for i in order.permutation(n):
            index, value = rows.row(i), values[i]
            slope = sign[i] * (w[index] @ value + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), box[i])
            change = (new - alpha[i]) * sign[i]
            if change:
                w[index] += change * value
                bias += change
                moved = max(moved, abs(change))
                alpha[i] = new
        if moved < 1e-5:
            break
    return w * ratio, bias


def train(rows: Rows, settings: Settings = Settings()) -> Model:
    share = np.average(rows.y, weights=rows.weight) if len(rows) else 0.5
    aside = calibration(rows.key)
    learn, check = rows.taken(~aside), rows.taken(aside)
    if len(set(learn.y.tolist())) < 2:
        rate = np.clip(share, 0.001, 0.999)
        return Model(np.zeros(1 << BITS, np.float32), 1.0, float(np.log(rate / (1 - rate))))
    weights, bias = descend(learn, log_count_ratios(learn, settings), settings)
    margins = np.bincount(check.of, weights[check.index], len(check)) + bias
    slope, offset = platt(margins, check.y, check.weight)
    return Model(weights.astype(np.float32), slope, offset + slope * bias)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from a bounded sample of the labels outside the held-out fold."""
    chosen = sample_ids(labels, "quality", crc_bucket(F.col("doc_id"), FOLDS) != 1, settings.most_rows)
    return train(sampled_rows(docs, chosen, features, settings.most_rows), settings)


def classified(docs: DataFrame, model: Model) -> DataFrame:
    return scored(docs, model.score, crc_bucket(F.col("doc_id"), FOLDS) == 1)
