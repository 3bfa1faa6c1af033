"""Joins against brute force, with one key that holds a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from docpipe.operators import manifest as m
from docpipe.operators.joins import compare_names, left_join_heavy_right, natural_inner_join, pinned
from docpipe.operators.outcomes import latest_per_file


def skewed_keys(n, seed):
    rng = random.Random(seed)
    return ["hot" if rng.random() < 1 / 3 else f"k{rng.randrange(n // 4)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [("hot", "HOT")] + [(f"k{i}", f"text {i}") for i in range(100)] + [("alone", "A")]
    return spark.createDataFrame(rows, "files string, raw_text string")


@pytest.fixture(scope="module")
def mapping_rows():
    keys = skewed_keys(600, 3)
    return [(k, f"v{i}") for i, k in enumerate(keys)] + [(None, "null key")]


@pytest.fixture(scope="module")
def mapping(spark, mapping_rows):
    return spark.createDataFrame(mapping_rows, "files string, meta string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_natural_join(texts, mapping, mapping_rows):  # F16
    text = dict(rows(texts))
    expected = [(k, v, text[k]) for k, v in mapping_rows if k in text]
    assert rows(natural_inner_join(mapping, texts)) == sorted(expected, key=repr)


def test_natural_join_needs_a_common_column(texts, mapping):  # F17
    with pytest.raises(ValueError, match="no common column"):
        natural_inner_join(mapping.withColumnRenamed("files", "f"), texts)


def test_natural_join_on_all_common_columns(spark):
    a = spark.createDataFrame([(1, 2, "x"), (1, 3, "y")], "p int, q int, r string")
    b = spark.createDataFrame([(1, 2, "z")], "p int, q int, s string")
    assert rows(natural_inner_join(a, b)) == [(1, 2, "x", "z")]


def test_left_join(texts, mapping, mapping_rows):
    expected = []
    for key, text in rows(texts):
        metas = [v for k, v in mapping_rows if k == key]
        expected += [(key, text, v) for v in metas] or [(key, text, None)]
    assert rows(left_join_heavy_right(texts, mapping, "files")) == sorted(expected, key=repr)


def test_left_join_keeps_null_and_empty_keys(spark, mapping):
    left = spark.createDataFrame([(None, "n"), (None, "n"), ("", "e")], "files string, raw_text string")
    assert rows(left_join_heavy_right(left, mapping, "files")) == [("", "e", None), (None, "n", None), (None, "n", None)]
    right = spark.createDataFrame([("", "m")], "files string, meta string")
    assert rows(left_join_heavy_right(left, right, "files")) == [("", "e", "m"), (None, "n", None), (None, "n", None)]


def test_comparison(spark):
    files = spark.createDataFrame([("a",), ("a",), ("b",)], "Object_name string")
    manifest = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "Object_name string")
    assert rows(compare_names(files, manifest, "Object_name")) == [
        ("a", "file_only", 2, 0),
        ("b", "both", 1, 1),
        ("c", "meta_only", 0, 2),
    ]


def test_latest_with_ties(spark):
    rows_in = [("a", 1, "p", "old"), ("a", 2, "p", "new"), ("a", 2, "o", "other"), ("b", 1, "x", "b")]
    df = spark.createDataFrame(rows_in, "files string, at int, path string, raw_text string")
    assert rows(latest_per_file(df, "at", "path")) == [("a", 2, "p", "new"), ("b", 1, "x", "b")]


def test_latest_of_a_hot_file_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 50)).alias("files"),
        F.col("id").alias("at"),
        F.col("id").cast("string").alias("raw_text"),
    )
    latest = latest_per_file(df, "at")
    got = {r.files: r.at for r in latest.collect()}
    best = {}
    for i in range(40_000):
        key = "hot" if i % 3 == 0 else f"f{i % 50}"
        best[key] = i
    assert got == best
    plan = latest._jdf.queryExecution().executedPlan().toString()
    reduced = [line for line in plan.splitlines() if "Aggregate" in line]
    assert any("partial_max" in line for line in reduced) and not any("raw_text" in line for line in reduced)


def test_pinned_is_the_identity(mapping):
    assert rows(pinned(mapping)) == rows(mapping)
    assert pinned(mapping).columns == mapping.columns


def test_text_is_computed_once_per_file(spark, mapping):
    """A hot mapping key must not repeat the cleaning of its text."""
    counter = spark.sparkContext.accumulator(0)

    def costly(text):
        counter.add(1)
        return text.lower()

    # stands for a projection the generated code could defer
    plan = natural_inner_join(
        mapping,
        spark.createDataFrame([("hot", "HOT")], "files string, raw_text string").withColumn(
            "raw_text", F.lower(F.udf(costly)("raw_text"))
        ),
    )
    joined = plan.collect()
    assert len(joined) > 100
    assert counter.value == 1
    tree = plan._jdf.queryExecution().executedPlan().toString()
    assert tree.index("Join") < tree.index("Generate inline")


@pytest.fixture
def splitting(spark):
    """Thresholds of adaptive skew handling lowered to test size."""
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in lowered}
    for key, value in lowered.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_manifest(spark):
    return spark.range(0, 20_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("Object_name"),
        F.sha2(F.col("id").cast("string"), 256).alias("object_id"),
        F.col("id").cast("string").alias("claim_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias(
            "Prior_Version_Object_Name"
        ),
    )


def hot_texts(spark, key):
    keys = spark.range(900).select(F.concat(F.lit("k"), "id").alias(key))
    return keys.union(spark.createDataFrame([("hot",)], f"{key} string")).withColumn("raw_text", F.upper(key))


def test_hot_mapping_key_is_split(spark, splitting):
    joined = natural_inner_join(
        hot_manifest(spark).withColumnRenamed("Object_name", "files").select("files", "object_id"),
        hot_texts(spark, "files"),
    )
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 6667 + sum(1 for i in range(20_000) if i % 3 and i % 1000 < 900)


def test_hot_manifest_name_is_split(spark, splitting):
    joined = m.attach_keys(hot_texts(spark, "Object_name"), hot_manifest(spark))
    assert "skew=true" in final_plan(joined)
    assert joined.where(F.col("Object_name") == "hot").count() == 6667


def test_text_is_scanned_and_shuffled_once(spark, splitting, tmp_path):
    hot_texts(spark, "Object_name").write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    plan = m.attach_keys(texts, hot_manifest(spark))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "raw_text:string" in line]
    assert len(scans) == 1 and plan.count("upper(") <= 1


def test_filters_on_keys_reach_the_scan_of_pinned_texts(spark, tmp_path):
    spark.createDataFrame([("a", "x")], "files string, text string").write.parquet(str(tmp_path / "t"))
    texts = spark.read.parquet(str(tmp_path / "t")).select("files", F.upper("text").alias("raw_text"))
    plan = pinned(texts).where("files = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(files,a)" in plan


def test_hot_prior_name_is_split(spark, splitting):
    joined = m.prior_version_join(hot_texts(spark, "files"), hot_manifest(spark))
    assert "skew=true" in final_plan(joined)
    assert joined.where(F.col("Prior_Version_Object_Name") == "hot").count() == 6667
