"""The join of n-gram sets against all pairs."""

import random

import numpy as np
import pytest

from docpipe.llm import common
from docpipe.llm import jaccard_join as jj


def n_grams(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain(docs, s):
    """``(doc_id, n, class)`` of every row, from all pairs."""
    rows = [(i, n_grams(t, s.words)) for i, t in docs]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, x) in enumerate(rows):
        for j, (b, y) in enumerate(rows[:i]):
            if a is None or b is None or not x or not y:
                continue
            if a == b or 100 * len(x & y) >= s.percent * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (a, x) in enumerate(rows):
        if a is not None:
            least[find(i)] = min(a, least.get(find(i), a))
    return sorted(((a, len(x), least.get(find(i))) for i, (a, x) in enumerate(rows)), key=repr)


def run(spark, docs, s):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, component_id string, n long").repartition(3)
    return sorted([tuple(r) for r in jj.joined(df, s).collect()], key=repr)


def edited(words, n, vocabulary):
    words = list(words)
    for _ in range(n):
        at = random.randrange(len(words))
        random.choice([lambda: words.__setitem__(at, random.choice(vocabulary)), lambda: words.pop(at) if len(words) > 1 else None,
                       lambda: words.insert(at, random.choice(vocabulary))])()
    return words


def corpus(seed, crowd):
    """Chains of edits at all sizes, a crowd around one text, passages that many share, and odd rows."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for size in (3, 6, 9, 12, 20, 40, 90, 200, 500):
        base = random.choices(vocabulary, k=size)
        for _ in range(3):
            base = edited(base, max(1, size // 60), vocabulary)
            texts += [base, edited(base, 1, vocabulary)]
    origin = random.choices(vocabulary, k=80)
    texts += [edited(origin, random.randint(0, 6), vocabulary) for _ in range(crowd)]
    texts += [edited(origin, random.randint(0, 2), ["same"]) for _ in range(crowd // 3)]
    passage = random.choices(vocabulary, k=60)
    texts += [random.choices(vocabulary, k=random.randint(20, 60)) + passage for _ in range(25)]
    texts += [random.choices(vocabulary, k=3) + passage for _ in range(20)]
    docs = [(i * 7 % 997, " ".join(t)) for i, t in enumerate(texts)]
    docs += [(1000 + i, t) for i, t in enumerate(["", None, " \n", "a b", "A  b", "a", "A b\tc", "a b c", "É x y", "é x y"])]
    docs += [(None, docs[3][1]), (None, None), docs[4], (docs[5][0], docs[30][1]), (2000, docs[6][1].upper()), (2001, docs[6][1])]
    return docs


@pytest.mark.parametrize("percent, cold, spread, crowd", [(90, 12, 2, 60), (90, 2, 2, 90), (60, 2, 3, 40)])
def test_equals_all_pairs(spark, percent, cold, spread, crowd):
    s = jj.Settings(percent=percent, cold=cold, spread=spread)
    docs = corpus(percent + cold, crowd)
    expected = plain(docs, s)
    assert run(spark, docs, s) == expected
    assert 20 < len({c for _, _, c in expected}) < len(docs) - 60


def test_bands_hold_all_partners():
    for percent in (50, 75, 80, 90, 97):
        s = jj.Settings(percent=percent)
        lows, bounds = s.bands()
        for a in range(1, 400):
            band = int(np.searchsorted(lows, a, "right")) - 1
            for b in range(a, a * 100 // percent + 1):
                # the smallest overlap that reaches the threshold
                common_ = -(-percent * (a + b) // (100 + percent))
                apart = a + b - 2 * common_
                if band < 0:
                    assert apart <= 0
                    continue
                assert apart <= bounds[band]
                assert (band, True) in jj._places(a, lows) and band in [p for p, _ in jj._places(b, lows)]


def test_few_or_no_rows(spark):
    s = jj.Settings()
    assert run(spark, [], s) == []
    assert run(spark, [(1, None), (None, "a b c d")], s) == [(1, 0, 1), (None, 2, None)]
    same = [(i, "x y z u v") for i in range(40)]
    assert run(spark, same, s) == sorted([(i, 3, 0) for i in range(40)], key=repr)


def test_bitmap_misses_no_id(spark):
    ids = [0, -1, 2**62, 7, -2**63] + list(range(10**6, 10**6 + 300))
    test = common.among(spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long").repartition(4))
    assert test(np.array(ids)).all()
    assert test(np.arange(5 * 10**6, 5 * 10**6 + 1000)).sum() < 10


def test_crowd_beyond_the_threshold_is_not_paired(spark, monkeypatch):
    """Copies that differ from one origin each in its own way, most of them beyond the threshold from it and from each other."""
    tables = []
    kept = jj.written

    def counted(df, name):
        table = kept(df, name)
        tables.append((name, table.count()))
        return table

    monkeypatch.setattr(jj, "written", counted)
    origin = [f"w{i}" for i in range(120)]

    def copy(i):
        at = range(i % 7, 120, 120 // (i % 4 + 1))
        return " ".join(f"own{i}x{j}" if j in at else w for j, w in enumerate(origin))

    docs = [(i, copy(i)) for i in range(160)] + [(500 + i, copy(3).replace("own3x9", f"near{i}")) for i in range(4)]
    s = jj.Settings()
    assert run(spark, docs, s) == plain(docs, s)
    # work tables hold rows in proportion to the elements, and pairs in proportion to the sets (all pairs: 81 a set)
    assert max(n for _, n in tables) < sum(len(n_grams(t, 3)) for _, t in docs)
    assert sum(n for name, n in tables if "pairs" in name) < 5 * len(docs)
