"""Importance resampling against a plain computation, with and without a head."""

import hashlib
import math
import random
import re
import zlib

import pytest

from docpipe.llm import importance as im

DOCS = "doc_id long, text string, rank string, at int"
PLAIN_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, s):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = PLAIN_WORD.findall(lowered)
    return len(words), [" ".join(words[i:i + n]) for n in range(1, s.longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, s):
    bucket = lambda f: zlib.crc32(f.encode()) % s.buckets
    a, b = [0] * s.buckets, [0] * s.buckets
    for rows, into in ((docs, a), (target, b)):
        for _, text in rows:
            for f in features(text, s)[1]:
                into[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t + 1) * (sum(a) + s.buckets) / ((d + 1) * (sum(b) + s.buckets)))) for d, t in zip(a, b)]
    out = []
    for i, text in docs:
        n, fs = features(text, s)
        weight = sum(gain[bucket(f)] for f in fs)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{s.seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append((i, n, len(fs), weight, score))
    order = sorted((r for r in out if r[1] >= s.least_words and r[4] is not None), key=lambda r: (-r[4], r[0]))
    return out, order[: len(order) * s.percent // 100], order


def run(spark, docs, target, s):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS).repartition(4)
    wanted = spark.createDataFrame([(t, "x") for _, t in target], "text string, score string")
    return im.drawn(df, wanted, s).collect()


@pytest.mark.parametrize("longest, head", [(1, 0), (1, 20), (2, 20), (2, 0), (3, 10)])
def test_equals_a_plain_computation(spark, longest, head):
    random.seed(longest)
    vocabulary = [f"w{i}" for i in range(40)] + ["Été", "ÀB", "日本", "x-y", "A1"]
    text = lambda n: random.choice([" ", ", ", "\n"]).join(random.choices(vocabulary, k=n))
    docs = [(i, text(random.randint(0, 12))) for i in range(300)]
    docs += [(None, text(9)), (None, None), (400, None), (401, ""), (402, "- !"), (403, text(5000)), *[(404 + i % 3, "w1 w2 w3 w4") for i in range(9)]]
    target = [(0, text(6)) for _ in range(10)] + [(0, None)]
    s = im.Settings(longest=longest, buckets=97, least_words=4, percent=30, head_words=head, head_pairs=head, distinct_per_task=7)
    rows, chosen, order = plain(docs, target, s)
    got = run(spark, docs, target, s)
    assert sorted([(r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got], key=repr) == sorted(rows, key=repr)
    ranks = sorted((r["rank"], r.doc_id, r.score) for r in got if r["rank"] is not None)
    assert ranks == [(k + 1, r[0], r[4]) for k, r in enumerate(chosen)]
    assert len(chosen) == len(order) * 30 // 100 > 50


def test_head_holds_the_most_frequent(spark):
    texts = spark.createDataFrame([("a a a b b c",), ("A b",), (None,), ("a b",)], "text string")
    head = im.head_of(texts, im.Settings(longest=2, head_words=2, head_pairs=1))
    assert set(head.words) == {b"a", b"b"} and head.words[b"a"] == zlib.crc32(b"a")
    assert head.pairs == {(b"a", b"b"): zlib.crc32(b"a b") % 10_000}


def test_no_rows_and_no_target(spark):
    s = im.Settings(buckets=11, least_words=1)
    assert run(spark, [], [(0, "a b")], s) == []
    got = run(spark, [(i, "a b a") for i in range(20)], [], s)
    assert sum(r["rank"] is not None for r in got) == 2
    assert {r.weight for r in got} == {plain([(i, "a b a") for i in range(20)], [], s)[0][0][3]}
