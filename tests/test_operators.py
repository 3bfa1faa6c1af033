"""Report, counts, manifests and helpers on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docpipe import session
from docpipe.operators import manifest as m
from docpipe.operators.outcomes import count_outcomes, error_listing
from docpipe.operators.report import reconcile_outcomes
from docpipe.plans.stand_in import spread

OUTCOME = "files string, ext string, raw_text string, status string, error string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def outcomes(spark):
    data = [
        ("a.docx", "docx", "x", "ok", None),
        ("b.docx", "docx", None, "error", "is empty"),
        ("c.eml", "eml", None, "skipped", None),
        ("d.gz", "gz", None, "unsupported", None),
        ("e.pdf", "pdf", "y", "ok", "1 of 2 pages failed"),
    ]
    return spark.createDataFrame(data, OUTCOME)


def test_counts(outcomes):
    counts = {r.ext: r.asDict() for r in count_outcomes(outcomes).collect()}
    assert counts["docx"] == {
        "ext": "docx", "n_files": 2, "n_ok": 1, "n_partial": 0, "n_error": 1, "n_skipped": 0, "n_unsupported": 0,
    }
    assert counts["pdf"]["n_partial"] == 1 and counts["gz"]["n_unsupported"] == 1 and counts["eml"]["n_skipped"] == 1


def test_errors_include_partly_failed_files(outcomes):
    twice = outcomes.union(outcomes.where("ext = 'docx'").withColumn("error", F.concat("error", F.lit("!"))))
    assert rows(error_listing(twice)) == [("b.docx", "is empty"), ("e.pdf", "1 of 2 pages failed")]


def test_reconcile_outcomes(spark, outcomes):
    report = reconcile_outcomes(outcomes, F.col("ext") == "docx", {"csv_rows": 2, "table_rows": 1, "cluster_rows": 1})
    assert {r.stage: (r.n, r.change) for r in report.collect()} == {
        "source_total": (5, None),
        "daily_files": (2, -3),
        "extracted": (2, 0),
        "csv_rows": (2, 0),
        "table_rows": (1, -1),
        "cluster_rows": (1, 0),
        "source_less_daily": (3, 2),
        "extracted_and_errors": (3, 0),
    }


def test_report_of_nothing(spark, outcomes):
    none = outcomes.where("1 = 0")
    report = reconcile_outcomes(none, F.col("ext") == "docx", {"csv_rows": 0})
    assert {r.n for r in report.collect()} == {0}


def test_day_filters(spark):
    days = spark.sql("SELECT explode(sequence(date'2019-05-01', date'2019-05-10')) AS manifest_date")
    run_date = dt.date(2019, 5, 8)
    assert rows(m.for_day(days, run_date)) == [(dt.date(2019, 5, 7),)]
    assert [r[0].day for r in rows(m.in_backlog(days, run_date, 3))] == [5, 6, 7]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, only_a string")
    b = spark.createDataFrame([(2, "y")], "i int, only_b string")
    assert rows(m.union_manifests(a, b)) == [(1, "x", None), (2, None, "y")]


def test_unprocessed_ignores_null_days(spark):
    days = spark.sql("SELECT explode(sequence(date'2019-05-01', date'2019-05-03')) AS manifest_date")
    processed = spark.sql("SELECT date'2019-05-02' AS manifest_date UNION ALL SELECT CAST(NULL AS DATE)")
    assert [r[0].day for r in rows(m.unprocessed(days, processed))] == [1, 3]


def test_spread_only_touches_scans_of_few_splits(spark):
    few, many = spark.range(0, 100, numPartitions=2), spark.range(0, 100, numPartitions=64)
    cores = spark.sparkContext.defaultParallelism
    assert spread(few).rdd.getNumPartitions() == cores
    assert spread(many) is many


def test_cluster_without_a_shared_folder_is_an_error(spark):
    class Context:
        master = "spark://somewhere:7077"

    class Conf:
        def get(self, key, default):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
