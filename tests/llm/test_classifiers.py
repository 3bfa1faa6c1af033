"""The trained models: held-out accuracy, what they must ignore, and their defined cases."""

import os

import numpy as np
import pytest

from docpipe.llm import labelled, language_id, quality_classifier, toxicity
from docpipe.llm.labelled import Rows
from docpipe.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def larger(sf_dir):
    return LARGER if os.path.isdir(LARGER) else sf_dir


def auc(scores, y):
    order = np.argsort(np.argsort(scores))
    n = y.sum()
    return (order[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_language_of_held_out_documents(spark, sf_dir):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = QUERIES["op5_language_id"](spark, sf_dir).collect()
    assert len(out) == len(docs)
    held = [r for r in out if r.held_out]
    assert 0 < len(held) < len(out) and np.mean([docs[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


@pytest.mark.parametrize(("name", "label", "least"), [("op7_toxicity", "toxic", 0.85), ("op8_quality_classifier", "quality", 0.9)])
def test_scores_of_held_out_documents(spark, larger, name, label, least):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    out = QUERIES[name](spark, larger).collect()
    held = [r for r in out if r.held_out and r.doc_id in labels]
    y = np.array([labels[r.doc_id] for r in held])
    assert auc(np.array([r.score for r in held]), y) > least
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_fold_and_labels_do_not_leak(spark):
    """Labels and languages of the held-out fold change nothing."""
    rows = [(i, ["der hund und die katze", "the dog and the cat"][i % 2], ["de", "en"][i % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id.identified(docs, language_id.fit(docs)).collect()}
    held = {i for i, r in out.items() if r.held_out}
    wrong = spark.createDataFrame([(i, t, "xx" if i in held else lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    again = {r.doc_id: r for r in language_id.identified(wrong, language_id.fit(wrong)).collect()}
    assert held and out == again


def test_null_empty_and_letterless_texts(spark):
    rows = [(1, "the dog", "en", 0), (2, None, "en", 1), (3, "", None, 0), (None, "der hund", "de", 1), (4, "123 !", "de", 0), (1, "the dog", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    out = language_id.identified(docs, language_id.fit(docs)).collect()
    assert len(out) == 6 and sorted(r.lang_pred for r in out if r.doc_id in (2, 3, 4)) == ["und"] * 3
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    none = language_id.fit(docs.limit(0))
    assert [r.lang_pred for r in language_id.identified(docs, none).collect()] == ["und"] * 6
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 1), (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality_classifier):
        for some in (labels, labels.limit(0)):
            got = module.classified(docs, module.fit(docs, some)).collect()
            assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        assert module.classified(docs.limit(0), module.fit(docs, labels)).count() == 0


def test_counts_do_not_depend_on_the_step(monkeypatch):
    text = "Élan der--Hund\n\n 中文 a1b  end. " * 40
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "CHARS_PER_STEP", 7)
    assert (language_id.counts(text) == whole).all()
    letters = [x for x in text.lower() if x.isalpha()]
    borders = whole.sum() - len(letters)
    assert borders > 0


def rows_of(texts, y, features):
    lists = [features(t) for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    return Rows(begin, np.concatenate(lists), np.array(y), np.ones(len(y)), np.arange(len(y)))


def test_swap_penalty_keeps_group_names_neutral():
    groups = ["muslims", "jews", "christians", "hindus"]
    texts, y = [], []
    for i in range(400):  # insults name one group, neutral texts the others
        texts.append(f"the {groups[0]} are stupid trash {'xyz'[i % 3]}")
        y.append(1)
        texts.append(f"the {groups[1 + i % 3]} held a feast {'xyz'[i % 3]}")
        y.append(0)
    rows = rows_of(texts, y, toxicity.features)
    plain = toxicity.train(rows, toxicity.Settings(swap_penalty=0.0))
    fair = toxicity.train(rows, toxicity.Settings(swap_penalty=5.0))
    neutral = "the muslims gathered in town"
    gap = lambda m: m.score(neutral) - m.score(neutral.replace("muslims", "jews"))
    assert gap(plain) > 0.1 and abs(gap(fair)) < gap(plain) / 4
    assert fair.score("the muslims held a feast") < 0.5 < fair.score("the jews are stupid trash")


def test_swaps_are_what_the_swapped_text_scores():
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(size=1 << toxicity.BITS), 0.0)
    margin = lambda text: model.weights[toxicity.features(text)].sum()
    groups = (("muslims", "jews"), ("frauen", "männer"))
    for text in ("the muslims met", "the muslims met jews", "frauen und männer", "jews jews frauen", "nobody"):
        gone, come, new_name = toxicity.counterfactuals(rows_of([text], [1], toxicity.features), groups)
        got = sorted(model.weights[gone] - new_name * model.weights[come])
        words = text.split()
        swaps = [(a, b) for g in groups for a in g for b in g if a != b and a in words]
        assert np.allclose(got, sorted(margin(text) - margin(" ".join(b if w == a else w for w in words)) for a, b in swaps))


def test_identity_names_come_from_a_table(spark):
    names = spark.createDataFrame([("x", "B"), ("x", "a"), ("y", "c"), (None, "d"), ("y", None)], "kind string, name string")
    assert toxicity.identities_of(names) == (("a", "b"), ("c",))


def test_dual_descent_reaches_the_optimum():
    """The primal objective is no lower at random nearby weights."""
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abcdefgh"), 4)) + (" good" if i % 2 else " bad") * (rng.random() < 0.8) for i in range(60)]
    rows = rows_of(texts, [i % 2 for i in range(60)], quality_classifier.features)
    s = quality_classifier.Settings(least_documents=1, epochs=400, cost=0.05)
    ratio = quality_classifier.log_count_ratios(rows, s)
    weights, bias = quality_classifier.descend(rows, ratio, s)
    w = np.divide(weights, ratio, out=np.zeros_like(ratio), where=ratio != 0)
    used = np.flatnonzero(ratio)
    sign = np.where(rows.y == 1, 1, -1)
    box = s.cost * 60 / 2 / np.where(rows.y == 1, rows.y.sum(), 60 - rows.y.sum())

    def loss(w, bias):
        margin = np.bincount(rows.of, (w * ratio)[rows.index], 60) + bias
        return (w @ w + bias * bias) / 2 + (box * np.maximum(0, 1 - sign * margin)).sum()

    best = loss(w, bias)
    for _ in range(200):
        near = w.copy()
        near[used] += rng.normal(0, 0.003, len(used))
        assert best <= loss(near, bias + rng.normal(0, 0.003)) + 1e-4


def test_sample_is_bounded_and_weighted(spark):
    from pyspark.sql import functions as F

    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    chosen = labelled.sample_ids(labels, "toxic", F.lit(True), 400).collect()
    assert len(chosen) <= 400 and 150 < sum(r.y for r in chosen) < 230
    assert abs(sum(r.weight for r in chosen) - 5000) < 900
    assert sorted(chosen) == sorted(labelled.sample_ids(labels.repartition(3), "toxic", F.lit(True), 400).collect())
