"""Resampling towards a target: importance weights from hashed word features.

Every run of up to ``longest`` words is a feature, and the CRC-32 of its UTF-8 bytes modulo ``buckets`` is its
bucket. A bucket's gain is the log of how much more often it is used by the target texts than by the documents; a document's
weight is the sum over its features. Gumbel noise from the id's digest turns the weights into a draw without replacement.

The vocabulary has a head and a tail. The head is the most frequent words of all documents, counted
exactly, and the most frequent runs of two head words. A head word is sent to the tasks with its CRC state, which
is carried on over the next word to give longer runs, and a head pair with its bucket. Anything else is
hashed where it is met. Both ways give the same bucket, so the totals are exact whatever the head holds; its size bounds
what is broadcast, and only decides how much hashing is saved.

Features are made once and written as bucket numbers; totals and weights are computed from that table. What comes to
the driver is the head, one total per bucket and one count per partition of the ranking.

Defined cases: null and empty texts have no features, weight 0 and are never drawn unless no words are asked for. Rows without an id
have no noise, hence no score and no rank. Rows that share an id count and are ranked each. Very long texts are one row of bucket
numbers. Empty tables give no rows; without target texts the gains only reflect the documents. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpipe.llm.common import written

# Words: runs of lower-case letters, digits and anything beyond ASCII; only A to Z are lower-cased.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Settings:
    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"
    head_words: int = 32_768
    head_pairs: int = 32_768
    distinct_per_task: int = 500_000  # counts held before they are handed on


@dataclass(frozen=True)
class Head:
    """CRC-32 of frequent words, and buckets of frequent pairs of them."""

    words: dict[bytes, int] = field(default_factory=dict)
    pairs: dict[tuple[bytes, bytes], int] = field(default_factory=dict)

    def buckets(self, words: list[bytes], s: Settings) -> list[int]:
        """The bucket of every run of up to ``longest`` words: by length, then by place."""
        known = self.words
        states = [known[w] if w in known else zlib.crc32(w) for w in words]
        out = [state % s.buckets for state in states]
        for n in range(2, s.longest + 1):
            if n == 2 and self.pairs:
                pairs = self.pairs
                both = zip(words, words[1:])
                made = [pairs[p] if p in pairs else zlib.crc32(b" " + p[1], state) % s.buckets for p, state in zip(both, states)]
                out += made
                if s.longest > 2:
                    states = [zlib.crc32(b" " + w, state) for state, w in zip(states, words[1:])]
                continue
            states = [zlib.crc32(b" " + w, state) for state, w in zip(states, words[n - 1:])]
            out += [state % s.buckets for state in states]
        return out


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def _counted(texts: DataFrame, items, s: Settings) -> DataFrame:
    """``item`` and ``n`` of everything that ``items(words)`` yields, over all texts; added up per task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def handed() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["item", "n"])
            held.clear()
            return made

        for batch in batches:
            for text in batch.column(0):
                held.update(items(words_of(text.as_py())))
                if len(held) >= s.distinct_per_task:
                    yield handed()
        yield handed()

    return texts.mapInArrow(count, "item binary, n long").groupBy("item").agg(F.sum("n").alias("n"))


def head_of(texts: DataFrame, s: Settings = Settings()) -> Head:
    """The head of one column of texts; ``head_words`` and ``head_pairs`` bound what comes to the driver."""

    def most(counts: DataFrame, n: int) -> list[bytes]:
        # classes of counts from the largest down, as many as fit: no task sends more than belongs to the head
        counts = written(counts.where("n > 1").withColumn("size", F.floor(F.log2("n") * 8).cast("int")), "draw-counts")
        left, least = n, None
        for r in sorted(counts.groupBy("size").agg(F.count("*").alias("of_size")).collect(), reverse=True):  # at most 8 * 63 rows
            left -= r.of_size
            if left < 0:
                break
            least = r["size"]
        if least is None:
            return []
        return [bytes(r.item) for r in counts.where(F.col("size") >= least).select("item").collect()]

    words = {w: zlib.crc32(w) for w in most(_counted(texts, lambda found: found, s), s.head_words)}
    if s.longest < 2:
        return Head(words)
    in_head = texts.sparkSession.sparkContext.broadcast(frozenset(words))

    def pairs(found: list[bytes]) -> Iterator[bytes]:
        head = in_head.value
        return (a + b" " + b for a, b in zip(found, found[1:]) if a in head and b in head)

    frequent = most(_counted(texts, pairs, s), s.head_pairs)
    return Head(words, {tuple(p.split(b" ")): zlib.crc32(p) % s.buckets for p in frequent})


def featured(rows: DataFrame, head: Head, s: Settings) -> DataFrame:
    """``id, n_words, buckets``: the bucket of every feature, repeats included, from ``id`` and ``text``."""
    sent = rows.sparkSession.sparkContext.broadcast(head)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, offsets, values = [], [0], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                n_words.append(len(words))
                values += sent.value.buckets(words, s)
                offsets.append(len(values))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
            yield pa.record_batch([batch.column(0), pa.array(n_words, pa.int64()), lists], names=["id", "n_words", "buckets"])

    return rows.mapInArrow(make, "id long, n_words long, buckets array<int>")


def totals(features: DataFrame, s: Settings) -> np.ndarray:
    """How many features fall into each bucket."""
    out = np.zeros(s.buckets, np.int64)
    for r in features.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count().collect():  # one row per bucket
        out[r.bucket] = r[1]
    return out


def gains(of_docs: np.ndarray, of_target: np.ndarray, s: Settings) -> np.ndarray:
    all_docs, all_target = float(of_docs.sum() + s.buckets), float(of_target.sum() + s.buckets)
    ratio = ((t + 1.0) * all_docs / ((d + 1.0) * all_target) for d, t in zip(of_docs.tolist(), of_target.tolist()))
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratio], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``id, n_words, n_features, weight``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = np.concatenate([[0], np.cumsum(gain[lists.flatten().to_numpy()])])
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(offsets), pa.int64()), pa.array(ends[offsets[1:]] - ends[offsets[:-1]], pa.int64())]
            yield pa.record_batch(columns, names=["id", "n_words", "n_features", "weight"])

    return features.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: str) -> Column:
    """Gumbel noise of an id in thousandths."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, eligible: Column, *order: Column) -> DataFrame:
    """The rows with ``place``: 1, 2, 3... in the given order among eligible ones, null for others.

    Rows are sorted by ranges; a partition's first place follows from the counts of the partitions before it, so no task sees more
    than a range.
    """
    ranges = rows.withColumn("eligible", F.coalesce(eligible, F.lit(False)))
    ranges = ranges.repartitionByRange(F.desc("eligible"), *order).sortWithinPartitions(F.desc("eligible"), *order)
    # ids ascend with the rows of a partition; the partition's number is in their upper bits
    table = written(ranges.withColumn("at", F.monotonically_increasing_id()), "draw-ranges")
    part = F.shiftright("at", 33).cast("int")
    counts = {r.part: r.n for r in table.where("eligible").groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    first = F.get(F.expr("array({})".format(", ".join(f"{before.get(p, total)}L" for p in range(max(counts, default=-1) + 1)) or "0L")), part)
    in_part = F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return table.withColumn("place", F.when(F.col("eligible"), first + in_part)).drop("at", "eligible")


def drawn(docs: DataFrame, target: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn.

    ``target`` holds the texts to come near to, in a column of the same name.
    """
    s = settings
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    head = head_of(texts.select("text"), s)
    features = written(featured(texts, head, s), "draw-features")
    wanted = target.select(F.lit(0).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    gain = gains(totals(features, s), totals(featured(wanted, head, s), s), s)
    scored = weighed(features, gain).withColumn("score", F.col("weight") + noise(F.col("id"), s.seed))
    places = ranked(scored, (F.col("n_words") >= s.least_words) & F.col("score").isNotNull(), F.desc("score"), F.col("id"))
    n = places.where("place IS NOT NULL").count()
    return places.select(
        F.col("id").alias("doc_id"), "n_words", "n_features", "weight", "score",
        F.when(F.col("place") <= n * s.percent // 100, F.col("place")).alias("rank"),
    )
