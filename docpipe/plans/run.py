"""Folder to table: extract, snapshot, join the mapping, publish, report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.functions.names import stem
from docpipe.operators.extract.job import READERS, extract_from, extract_plain
from docpipe.operators.joins import natural_inner_join
from docpipe.operators.key_history import add_days, has_history, in_force, read_history
from docpipe.operators.manifest import attach_keys, changed, unprocessed
from docpipe.operators.outcomes import count_outcomes, error_listing
from docpipe.operators.pages import PageReader, clean_pages, page_outcomes, read_pages
from docpipe.operators.report import reconcile_outcomes
from docpipe.session import folder_exists, snapshot
from docpipe.sinks import files as sink
from docpipe.sinks.log import mark_processed, read_log
from docpipe.sinks.tables import TEXT_COLUMNS, create_table, overwrite_table
from docpipe.sources.files import converted_doc_files, raw_files
from docpipe.sources.manifests import Manifest, read_backlog
from docpipe.sources.mapping import read_mapping
from docpipe.sources.snapshots import read_outcomes, read_pages_of, read_snapshot

FORMATS = ("doc", "docx", "eml", "pdf", "rtf")


@dataclass(frozen=True)
class Folders:
    """Where a run reads and writes; any URI the cluster knows."""

    raw: str
    snapshots: str
    errors: str
    pages: str | None = None


def extract_folder(
    spark: SparkSession,
    ext: str,
    folders: Folders,
    run_date: dt.date,
    page_reader: PageReader | None = None,
    sep: str = "",
) -> DataFrame | None:
    """Extract all files of one format; returns success and failure counts.

    An unknown format does nothing. For doc the raw folder holds the converted files,
    see ``converted_doc_files``; pdf needs a page reader. Every later step reads the snapshot that is
    written here, so no file is opened twice, also when executors are lost.
    """
    if ext not in FORMATS:
        return None
    if ext == "pdf":
        if page_reader is None or folders.pages is None:
            raise ValueError("pdf needs a page_reader and a pages folder")
        raw = raw_files(spark, folders.raw, ["pdf"])
        sink.write_pages(clean_pages(read_pages(raw, page_reader)), folders.pages, run_date)
        outcomes = page_outcomes(read_pages_of(spark, folders.pages, run_date), sep=sep)
    elif ext == "doc":
        outcomes = extract_plain(converted_doc_files(spark, folders.raw))
    else:
        outcomes = extract_from(lambda exts: raw_files(spark, folders.raw, exts), [ext], READERS, sep)
    sink.write_format_snapshot(outcomes, folders.snapshots, ext, run_date)
    written = read_outcomes(spark, folders.snapshots).where(
        (F.col("ext") == ext) & (F.col("run_date") == F.lit(run_date))
    )
    sink.write_errors(error_listing(written), folders.errors, ext, run_date)
    return count_outcomes(written)


def merge_mapping(spark: SparkSession, ext: str, folders: Folders, mapping_path: str, run_date: dt.date) -> DataFrame:
    """Mapping rows with the text of their file."""
    return natural_inner_join(
        read_mapping(spark, mapping_path), read_snapshot(spark, folders.snapshots, ext, run_date)
    )


def publish(merged: DataFrame, table: str, keys: dict[str, str], ext: str) -> int:
    """Replace the table content; ``keys`` says which merged column fills which key column.

    Key columns that are not filled stay null. Returns the rows written.
    """
    create_table(merged.sparkSession, table, TEXT_COLUMNS)
    filled = {
        "filename": F.col("files"),
        "file_extension": F.lit(ext),
        "extracted_text": F.col("raw_text"),
        **{target: F.col(source) for target, source in keys.items()},
    }
    return overwrite_table(
        merged.select(*[filled.get(c, F.lit(None)).cast("string").alias(c) for c in TEXT_COLUMNS]), table
    )


def publish_and_export(
    merged: DataFrame, table: str, keys: dict[str, str], ext: str, csv_folder: str, run_date: dt.date
) -> dict[str, int]:
    """Load the table, write its CSV from it, and tell the rows of both.

    The table is loaded from the rows themselves, so an empty text stays empty; joins and
    cleaning run once.
    """
    spark = merged.sparkSession
    table_rows = publish(merged, table, keys, ext)
    _, csv_rows = sink.write_csv(spark.table(table), csv_folder, "MergedDataFrame", ext, run_date, stored=True)
    # counted where they lie, from the footers of the table's files
    return {"csv_rows": csv_rows, "table_rows": table_rows, "cluster_rows": spark.table(table).count()}


def run_format(
    spark: SparkSession,
    ext: str,
    folders: Folders,
    mapping_path: str,
    csv_folder: str,
    table: str,
    run_date: dt.date,
    keys: dict[str, str] | None = None,
    page_reader: PageReader | None = None,
) -> DataFrame:
    """One format with a mapping file; returns the published table."""
    if extract_folder(spark, ext, folders, run_date, page_reader) is None:
        raise ValueError(f"unknown format {ext}")
    merged = merge_mapping(spark, ext, folders, mapping_path, run_date)
    publish_and_export(merged, table, keys or {}, ext, csv_folder, run_date)
    return spark.table(table)


def update_keys(
    spark: SparkSession, manifest_root: str, log_path: str, history_path: str, run_date: dt.date, days: int | None = None
) -> Manifest:
    """Bring the manifests of the ``days`` days before ``run_date``, or of all, that the log does not have into the key history.

    Returns their rows, written, and what could not be taken. A history that is missing although days were logged is
    made anew from every manifest before ``run_date``. The caller logs the days when its run is done; days that
    are taken again until then say the same again.
    """
    known = has_history(spark, history_path)
    logged = folder_exists(spark, log_path)
    manifest = read_backlog(spark, manifest_root, run_date, days, extra=["object_id"])
    rows = manifest.rows.where(F.col("manifest_date") < F.lit(run_date))
    rows = snapshot(unprocessed(rows, read_log(spark, log_path)) if logged else rows, "manifest-rows")
    if logged and not known:
        every = read_backlog(spark, manifest_root, extra=["object_id"]).rows
        add_days(every.where(F.col("manifest_date") < F.lit(run_date)), history_path)
    elif rows.head(1):
        add_days(rows, history_path)
    return Manifest(rows, manifest.rejects)


def run_daily(
    spark: SparkSession,
    ext: str,
    folders: Folders,
    manifest_root: str,
    log_path: str,
    csv_folder: str,
    table: str,
    run_date: dt.date,
    days: int = 1,
    page_reader: PageReader | None = None,
    history_path: str | None = None,
) -> DataFrame | None:
    """The daily loop of one format; returns the report, or None if there is nothing to do.

    Manifests of the days before ``run_date`` that the log does not have are read into the key history, by default
    ``<log_path>_keys``. The texts of the folder get the keys that the history has in force on the day before ``run_date``, whenever
    they came, and are published. The log is written last, so a run that
    broke off is repeated and a run that is done is not. Manifest rows and files that could not be taken are
    written beside the error list.
    """
    history_path = history_path or f"{log_path}_keys"
    manifest = update_keys(spark, manifest_root, log_path, history_path, run_date, days)
    rows = manifest.rows
    sink.write_errors(manifest.rejects, folders.errors, "manifest", run_date)
    if not rows.head(1):
        return None
    if extract_folder(spark, ext, folders, run_date, page_reader) is None:
        raise ValueError(f"unknown format {ext}")
    texts = read_snapshot(spark, folders.snapshots, ext, run_date).select(stem(F.col("files")).alias("Object_name"), "files", "raw_text")
    keyed = attach_keys(texts, in_force(read_history(spark, history_path), run_date - dt.timedelta(days=1)))
    published = publish_and_export(
        keyed, table, {"object_id": "object_id", "claim_id": "claim_id"}, ext, csv_folder, run_date
    )
    outcomes = read_outcomes(spark, folders.snapshots).where((F.col("ext") == ext) & (F.col("run_date") == F.lit(run_date)))
    named = snapshot(changed(rows).select("Object_name").distinct(), "manifest-changed")
    marked = outcomes.withColumn("Object_name", stem(F.col("files"))).join(named.withColumn("daily", F.lit(True)), "Object_name", "left")
    report = snapshot(reconcile_outcomes(marked, F.coalesce("daily", F.lit(False)), published), "report")
    mark_processed(rows, log_path)
    return report
