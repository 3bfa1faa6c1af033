"""Classes against all pairs, and the signature against the similarity it estimates."""

import random
from collections import defaultdict

import numpy as np

import corpus_pipeline
from docpipe.llm import minhash


def brute_classes(rows, k=5, percent=80):
    """Connected components of all pairs at the threshold, over documents with an id."""
    sets, ids = {}, {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        if doc_id is not None and words:
            key = tuple(words)
            sets[key] = {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}
            ids.setdefault(key, []).append(doc_id)
    parent = {i: i for i, _ in rows if i is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    keys = list(sets)
    for members in ids.values():
        for i in members:
            join(members[0], i)
    index = defaultdict(list)
    for n, key in enumerate(keys):
        common = defaultdict(int)
        for s in sets[key]:
            for m in index[s]:
                common[m] += 1
            index[s].append(n)
        for m, c in common.items():
            if c * 100 >= percent * (len(sets[key]) + len(sets[keys[m]]) - c):
                join(ids[key][0], ids[keys[m]][0])
    return {i: find(i) for i in parent}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append((n, " ".join(words)))
        n += 1

    passage = [word() for _ in range(60)]
    for _ in range(25):
        origin = [word() for _ in range(rng.randint(60, 150))]
        copies = [origin] + [
            [word() if rng.random() < rate else w for w in origin] for rate in [0, 0.003, 0.01, 0.02, 0.03, 0.05] for _ in range(4)
        ]
        rng.shuffle(copies)
        for c in copies:
            add(c)
        add([word() for _ in range(60)] + passage)
    chain = [word() for _ in range(100)]
    for _ in range(12):  # each is close to the next, the first not to the last
        add(chain)
        chain = chain[4:] + [word() for _ in range(4)]
    for short in (["one"], ["one"], ["one", "two"], ["a", "b", "c", "d", "e"], ["a", "b", "c", "d", "e"]):
        add(short)
    rng.shuffle(rows)
    return rows


def test_classes_equal_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, id string")
    got = {r.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    assert got == brute_classes(rows)


def test_classes_of_the_table_equal_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id: r.class_id for r in minhash.classes(docs).collect()} == brute_classes(rows)


def test_nulls_repeated_ids_and_empty_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a, 1), (5, a, 1), (5, b, 2), (9, b, 3), (None, a, 4), (7, None, 5), (8, "", 6), (8, "", 6), (10, a, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, band int")
    got = sorted(((r.doc_id, r.class_id) for r in minhash.classes(docs).collect()), key=str)
    assert got == sorted([(5, 5)] * 3 + [(9, 5), (10, 5), (None, None), (7, 7), (8, 8), (8, 8)], key=str)
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted([(5, a, 1), (None, a, 4), (7, None, 5), (8, "", 6)], key=str)
    assert minhash.classes(docs.limit(0)).count() == 0


def test_copies_with_a_line_repeated_equal_all_pairs(spark):
    rng = random.Random(7)
    words = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    rows = []
    for times in (5, 30, 100, 1000):
        for _ in range(15):
            origin, line = words(104), words(15)
            for text in (origin, origin + origin[:20] * times, words(104), (new := words(104)) + line * times, new):
                rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_classes(rows)
    assert len(set(expected.values())) == 3 * 60
    assert {r.doc_id: r.class_id for r in minhash.classes(docs).collect()} == expected


def test_every_text_of_a_repeated_id_is_compared(spark):
    rng = random.Random(5)
    rows = []
    for n in range(0, 60, 6):
        for k, words in enumerate([[f"w{rng.random()}" for _ in range(60)] for _ in range(3)]):
            rows += [(n + 1, " ".join(words)), (n + 2 + k - 2 * (k == 2), " ".join(words[1:]))]
        rows.append((n + 5, " ".join(words[2:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_classes(rows)
    assert len(set(expected.values())) == 10
    got = minhash.classes(docs).collect()
    assert len(got) == len(rows) and all(r.class_id == expected[r.doc_id] for r in got)


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    pool = rng.integers(1, 2**63, 400).astype(np.uint64)
    x, y = pool[:300], pool[60:]
    wx, wy = rng.uniform(0.5, 3, len(x)), rng.uniform(0.5, 3, len(y))
    a, b = dict(zip(x.tolist(), wx)), dict(zip(y.tolist(), wy))
    true = sum(
        1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b)) for d in set(a) & set(b)
    )
    m = 4000
    same = np.mean(minhash.signature(x, wx, m) == minhash.signature(y, wy, m))
    assert abs(same - true) < 0.03
    equal = np.mean(minhash.signature(x, np.ones(300), m) == minhash.signature(y, np.ones(340), m))
    assert abs(equal - 240 / 400) < 0.03


def test_pipeline_stages_take_effect(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
        if k < 4:
            assert docs.columns == before.columns
        if k == 1:
            rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
            assert {r.doc_id for r in docs.select("doc_id").collect()} == set(brute_classes(rows).values())
    assert counts[0] > counts[1] == counts[2] and counts[3] == counts[4]
    assert docs.where("not round_trip").count() == 0


def one_arrival_a_round(elements, weights, m):
    """The signature by its definition: arrivals of all elements, one after the other."""
    first, winner, at = np.full(m, np.inf), np.zeros(m, np.uint64), np.zeros(len(elements))
    for turn in range(1, 20_000):
        seeds = minhash.STEP * np.arange(2 * turn, 2 * turn + 2, dtype=np.uint64)
        at = at - np.log1p(-(minhash.mixed(elements + seeds[0]) >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weights
        for e, time, register in zip(elements, at, minhash.mixed(elements + seeds[1]) % np.uint64(m)):
            if time < first[register]:
                first[register], winner[register] = time, e
        if at.min() >= first.max():
            return winner


def test_signature_takes_few_rounds(monkeypatch):
    draw = np.random.default_rng(3)
    for n in (1, 7, 60, 300):
        elements = np.unique(draw.integers(1, 2**62, n).astype(np.uint64))
        for weights in (np.ones(len(elements)), 1.0 + np.log(draw.integers(1, 9, len(elements)))):
            assert (minhash.signature(elements, weights, 40) == one_arrival_a_round(elements, weights, 40)).all()
    calls, plain = [], minhash.mixed
    monkeypatch.setattr(minhash, "mixed", lambda x: calls.append(1) or plain(x))
    minhash.signature(elements[:60], np.ones(60), 130)
    assert len(calls) <= 12
