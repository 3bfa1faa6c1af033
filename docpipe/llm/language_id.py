"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF values of hashed character n-grams of one to three letters. Document
frequencies count all documents to learn from. The weights are trained by follow the regularised
leader with an elastic net (proximal form, one step size per weight) on a bounded sample, and a
temperature fitted on sampled rows set apart makes the softmax a probability.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is everything if no
language can be learned. Of equally likely languages the first by name counts. Rows are never merged, so repeated rows and ids each get theirs; an
empty table gives no rows. Very long texts are counted whole, piece by piece. Columns other than id, text and lang are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.llm.common import crc_bucket, kept_by_worker, written
from docpipe.llm.labelled import calibration

BITS = 13
FOLDS, HELD_OUT = 4, 2
CHARS_PER_STEP = 1 << 20
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass(frozen=True)
class Settings:
    most_rows: int = 4_000  # sampled documents to fit on, shared evenly among the languages
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.002


def _letters() -> np.ndarray:
    return kept_by_worker("letters", lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def counts(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text; blanks and the like are one border."""
    total = np.zeros(1 << BITS, np.int64)
    letters = _letters()
    carry = np.zeros(1, np.uint64)
    text = text.lower()
    for begin in range(0, len(text), CHARS_PER_STEP):
        codes = np.frombuffer(text[begin:begin + CHARS_PER_STEP].encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(letters[codes], codes, 0).astype(np.uint64)
        codes = np.concatenate([carry, codes])
        keep = np.ones(len(codes), bool)
        keep[len(carry):] = (codes[len(carry):] != 0) | (codes[len(carry) - 1:-1] != 0)
        codes = codes[keep]
        for n in (1, 2, 3):
            # windows that end in this step; those within the carry were counted before
            first = max(0, len(carry) - n + 1)
            ends = len(codes) - n + 1
            if ends <= first:
                continue
            h = np.full(ends - first, n, np.uint64)
            for j in range(n):
                h = (h ^ codes[first + j:ends + j]) * _ODD[j]
                h ^= h >> np.uint64(29)
            total += np.bincount((h * _ODD[0] >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
        carry = codes[-2:]
    return total


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # per language
    intercept: np.ndarray
    temperature: float = 1.0

    def vector(self, n: np.ndarray) -> np.ndarray:
        x = np.log1p(n) * self.idf
        norm = np.sqrt(x @ x)
        return x / norm if norm else x

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        z = (self.weights @ self.vector(counts(text)) + self.intercept) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of documents, and for each hashed n-gram the number that contain it.

    Each task adds up its own; what is shuffled and collected is one row per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                total += counts(text.as_py() or "") > 0
                n += 1
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array([-1, *used], pa.int32()), pa.array([n, *total[used]], pa.int64())], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r.bucket: r.n for r in written(rows, "language-frequencies").collect()}  # 2**BITS + 1 rows at most
    out = np.zeros(1 << BITS, np.int64)
    for bucket, n in found.items():
        if bucket >= 0:
            out[bucket] = n
    return found.get(-1, 0), out


def sample(known: DataFrame, settings: Settings) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    """Language, key and n-gram counts of a bounded sample, the same on every run.

    Hashes below a threshold per language are taken, so nothing is sorted; the counts of one row
    have 2**BITS entries at most.
    """
    per_lang = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per class
    if not per_lang:
        return []
    each = settings.most_rows / len(per_lang)
    at = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1) / float(1 << 63)
    threshold = F.create_map(*[F.lit(x) for lang, n in sorted(per_lang.items()) for x in (lang, min(1.0, each / n))])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts(t.as_py() or "") for t in batch.column(2)]
            used = [np.flatnonzero(r) for r in rows]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([u.tolist() for u in used], pa.list_(pa.int32())),
                 pa.array([r[u].tolist() for r, u in zip(rows, used)], pa.list_(pa.int32()))],
                names=["lang", "key", "bucket", "n"],
            )

    chosen = known.where(at < F.element_at(threshold, F.col("lang"))).select("lang", F.xxhash64("doc_id", "text").alias("key"), "text")
    rows = written(chosen.mapInArrow(made, "lang string, key long, bucket array<int>, n array<int>"), "language-sample")
    got = rows.limit(2 * settings.most_rows).toArrow().to_pylist()
    got.sort(key=lambda r: (r["key"], r["lang"], r["bucket"]))
    return [(r["lang"], r["key"], np.array(r["bucket"], np.int64), np.array(r["n"], np.int64)) for r in got]


def train(rows: list[tuple[str, int, np.ndarray, np.ndarray]], n_docs: int, frequency: np.ndarray, settings: Settings) -> Model:
    d = 1 << BITS
    languages = sorted({r[0] for r in rows})
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    # the last column is the intercept, which is not penalised
    z, squares = np.zeros((len(languages), d + 1)), np.zeros((len(languages), d + 1))
    model = Model(languages, idf, z[:, :d], z[:, d])
    if not languages:
        return model

    def weights(at) -> np.ndarray:
        l1 = np.where(at == d, 0.0, settings.l1)
        shrunk = np.sign(z[:, at]) * np.maximum(np.abs(z[:, at]) - l1, 0)
        return -shrunk / ((settings.beta + np.sqrt(squares[:, at])) / settings.alpha + settings.l2)

    examples = []
    for lang, key, bucket, n in rows:
        x = np.log1p(n) * idf[bucket]
        examples.append((np.append(bucket, d), np.append(x / max(np.sqrt(x @ x), 1e-12), 1.0), languages.index(lang)))
    aside = calibration(np.array([r[1] for r in rows], np.int64).view(np.uint64))
    order = np.random.default_rng(11)
    learn = np.flatnonzero(~aside) if len(set(np.array([e[2] for e in examples])[~aside])) == len(languages) else np.arange(len(rows))
    for _ in range(settings.epochs):
        for i in order.permutation(learn):
            at, x, y = examples[i]
            w = weights(at)
            p = np.exp((s := w @ x) - s.max())
            p /= p.sum()
            p[y] -= 1
            g = p[:, None] * x
            old = squares[:, at]
            z[:, at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / settings.alpha * w
            squares[:, at] = old + g * g
    final = weights(np.arange(d + 1))
    model.weights, model.intercept = final[:, :d], final[:, d]
    model.temperature = _temperature([(final[:, at] @ x, y) for i, (at, x, y) in enumerate(examples) if aside[i]])
    return model


def _temperature(held: list[tuple[np.ndarray, int]]) -> float:
    """The temperature that makes the rows set apart most likely, by golden section."""
    if not held:
        return 1.0
    z, y = np.array([h[0] for h in held]), np.array([h[1] for h in held])

    def loss(log_t: float) -> float:
        s = z / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from the documents outside the held-out fold whose language is known."""
    known = docs.where((crc_bucket(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    n_docs, frequency = document_frequencies(known)
    return train(sample(known, settings), n_docs, frequency, settings)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [model.predict(t.as_py()) for t in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    held_out = F.coalesce(crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
