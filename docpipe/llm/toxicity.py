"""A toxicity classifier that must not care which group a sentence names.

Logistic regression on the words of a text, trained on a bounded sample of labelled documents.
For every training text that names a group, a counterfactual text names another group of the
same kind; the square of the difference of both scores is part of the loss. So a group's name,
which is frequent where groups are insulted, gets no weight of its own that another group's
name lacks, and neutral mentions are not taken for insults.

Defined cases: null and empty texts get the score of the intercept. Without labels of both classes the score
is the share of the class there is, or one half without any. Rows are never merged, so repeated rows and ids each get theirs; an empty table gives no
rows. Very long texts are read whole, each word counts once. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.llm.common import crc_bucket
from docpipe.llm.labelled import MOST_ROWS, Rows, sample_ids, sampled_rows, scored, sigmoid

BITS = 18
# Groups whose names can stand for one another, in English, German, French and Spanish.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("she", "he"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("black", "white", "asian", "latino"),
    ("africans", "europeans", "americans", "arabs", "mexicans", "chinese"),
    ("old", "young"), ("blind", "deaf", "disabled"), ("immigrants", "refugees", "natives"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"), ("sie", "er"),
    ("christen", "muslime", "juden", "buddhisten", "atheisten"), ("schwule", "lesben"), ("einwanderer", "flüchtlinge"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"), ("elle", "il"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"), ("immigrés", "réfugiés"), ("noirs", "blancs"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("chicas", "chicos"), ("ella", "él"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"), ("inmigrantes", "refugiados"), ("negros", "blancos"),
)
MOST_NAMES = 10_000
_WORD = re.compile(r"[^\W\d_]+")
FOLDS = 5


@dataclass(frozen=True)
class Settings:
    most_rows: int = MOST_ROWS  # labelled documents to learn from
    least_documents: int = 3  # a word in fewer sampled documents is left out
    l1: float = 5e-5
    swap_penalty: float = 1.0
    rounds: int = 250
    identities: tuple[tuple[str, ...], ...] = IDENTITIES


def identities_of(names: DataFrame) -> tuple[tuple[str, ...], ...]:
    """Groups from a table of ``kind, name``; names of one kind can stand for one another.

    The names go into the training, so a table of more than ``MOST_NAMES`` is refused.
    """
    rows = names.select("kind", "name").where("kind IS NOT NULL AND name IS NOT NULL").distinct().limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names")
    kinds: dict[str, set[str]] = {}
    for r in rows:
        kinds.setdefault(r.kind, set()).add(r.name.lower())
    return tuple(tuple(sorted(kinds[k])) for k in sorted(kinds))


def _number(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - BITS)


def features(text: str) -> np.ndarray:
    """The numbers of the words of a whole text, each once, ascending."""
    words = set(_WORD.findall(text.lower()))
    return np.unique(np.fromiter(map(_number, words), np.int64, len(words)))


def counterfactuals(rows: Rows, identities: tuple[tuple[str, ...], ...] = IDENTITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per swap: the feature that goes, the one that comes instead, and whether that one is new to the text.

    Every name in a row is swapped with every other of its kind, one at a time. In a text that holds the other name
    already only the first one goes.
    """
    swaps = {_number(a): [_number(b) for b in group if b != a] for group in identities for a in group}
    named = np.isin(rows.index, np.fromiter(swaps, np.int64, len(swaps)))
    out = []
    for i, a in zip(rows.of[named].tolist(), rows.index[named].tolist()):
        held = set(rows.row(i).tolist())
        out += [(a, b, b not in held) for b in swaps[a]]
    table = np.array(out, np.int64).reshape(len(out), 3)
    return table[:, 0], table[:, 1], table[:, 2].astype(float)


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        return float(sigmoid(self.weights[features(text)].sum() + self.intercept))


def train(rows: Rows, settings: Settings = Settings()) -> Model:
    """Accelerated proximal gradient on the weighted log loss, the swap penalty and an L1 norm."""
    d = 1 << BITS
    n = len(rows)
    share = float(np.average(rows.y, weights=rows.weight)) if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        rate = np.clip(share, 0.001, 0.999)
        return Model(np.zeros(d, np.float32), float(np.log(rate / (1 - rate))))
    seen = np.bincount(rows.index, minlength=d) >= settings.least_documents
    kept = rows.only(seen)
    of, index, y, weight = kept.of, kept.index, kept.y, kept.weight / kept.weight.sum()
    gone, come, new_name = counterfactuals(kept, settings.identities)
    swaps = max(1, len(gone))
    # one step size per word: a word's curvature is bounded by the lengths of the rows that have it
    length = np.diff(kept.begin) + 1.0
    curve = np.bincount(index, (weight * length)[of], d) / 4
    curve += 2 * settings.swap_penalty / swaps * (np.bincount(gone, minlength=d) + np.bincount(come, new_name, d))
    step, step_b = 1 / np.maximum(curve, 1e-9), 4 / (weight @ length)
    w, v, t = np.zeros(d), np.zeros(d), 1.0
    b = vb = float(np.log(share / (1 - share)))
    for _ in range(settings.rounds):
        p = sigmoid(np.bincount(of, v[index], n) + vb)
        error = weight * (p - y)
        slope = np.bincount(index, error[of], d)
        # the difference of the two scores of a swap is the difference of two weights, or one weight
        apart = settings.swap_penalty * (v[gone] - new_name * v[come]) / swaps
        slope += np.bincount(gone, apart, d) - np.bincount(come, new_name * apart, d)
        new = v - step * slope
        new = np.sign(new) * np.maximum(np.abs(new) - step * settings.l1, 0)
        new_b = vb - step_b * error.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return Model(w.astype(np.float32), float(b))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from a bounded sample of the labels outside the held-out fold."""
    chosen = sample_ids(labels, "toxic", crc_bucket(F.col("doc_id"), FOLDS) != 0, settings.most_rows)
    return train(sampled_rows(docs, chosen, features, settings.most_rows), settings)


def classified(docs: DataFrame, model: Model) -> DataFrame:
    return scored(docs, model.score, crc_bucket(F.col("doc_id"), FOLDS) == 0)
