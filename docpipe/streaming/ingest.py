"""Take files that were not seen before, once.

The checkpoint remembers which files were read. Each micro-batch is merged into the target and committed with its
number by one file, so a lost executor or a restarted driver neither loses nor doubles rows: a batch that broke off is
repeated, one that was committed is not applied again. The target holds one row per file, that of its newest version.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpipe.functions.names import basename
from docpipe.operators.extract.job import SUPPORTED, extract_in_one_pass
from docpipe.operators.outcomes import latest_per_file
from docpipe.operators.pages import PageReader, clean_pages, page_outcomes, read_pages
from docpipe.session import folder_exists, read_text, snapshot
from docpipe.sinks.state import Conflict, State, merge, read_state, reports
from docpipe.sources.files import as_converted_doc, empty_files, packed, with_content
from docpipe.sources.listing import LISTED, listed

TARGET_SCHEMA = (
    "files string, ext string, raw_text string, status string, error string, "
    "modificationTime timestamp, path string, batch_id bigint"
)


# what tells two deliveries of the same file apart
VERSION = ["modificationTime", "path"]

# the batch of empty files, whose number is never a stream's
EMPTY_BATCH = -1

# files of one batch, about
FILES_PER_BATCH = 100_000

Transform = Callable[[DataFrame], DataFrame]


def target_state(target: str, buckets: int = 64) -> State:
    """The target of an ingest: a row per file, merged by name."""
    return State(target, "files", TARGET_SCHEMA, lambda rows: latest_per_file(rows, "modificationTime", "batch_id", "path"), buckets)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """What Spark calls the stream of a checkpoint; a new checkpoint is a new stream."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


# what is counted of each batch while it is written
MEASURES = {
    "n_files": "count(1)",
    **{f"n_{status}": f"count_if(status = '{status}')" for status in ("ok", "error", "skipped", "unsupported")},
    "n_chars": "sum(length(raw_text))",
}


def merge_batch(outcomes: DataFrame, batch_id: int, target: str, source: str) -> bool:
    """Bring a batch into the target; false if it is there. A merge that another one got ahead of is tried again."""
    rows = outcomes.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    for tries_left in (2, 1, 0):
        try:
            return merge(rows, target_state(target), source, batch_id, MEASURES)
        except Conflict:
            if not tries_left:
                raise
    return False


def ingest_available(
    new_files: DataFrame,
    target: str,
    checkpoint: str,
    exts: Iterable[str] | None = SUPPORTED,
    transform: Transform | None = None,
) -> None:
    """Process everything the stream has now, then stop."""
    exts = None if exts is None else list(exts)
    transform = transform or (lambda raw: extract_in_one_pass(raw, exts, VERSION))

    def take(batch: DataFrame, batch_id: int) -> None:
        merge_batch(transform(packed(batch)), batch_id, target, stream_id(batch.sparkSession, checkpoint))

    query = new_files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def pages_transform(page_reader: PageReader, sep: str = "") -> Transform:
    """Outcomes of files that are read page by page, such as pdf.

    Files are told apart by path, since two days may bring the same name in one batch.
    """

    def transform(raw: DataFrame, listing: DataFrame | None = None) -> DataFrame:
        by_path = raw.withColumn("files", F.col("path"))
        done = page_outcomes(clean_pages(read_pages(by_path, page_reader)), sep=sep).withColumnRenamed("files", "path")
        times = (raw if listing is None else listing).select("path", "modificationTime")
        return done.join(times, "path").withColumn("files", basename(F.col("path")))

    return transform


def list_new(spark: SparkSession, folder: str, exts: Iterable[str] | None, log: str) -> None:
    """Append the files of a folder or glob that are not in the log of files, empty ones left out; names stay in the tasks.

    A part of the log holds the files of one batch. Parts of an append that broke off count, the other files are found again.
    """
    found = listed(spark, folder, exts).where("length > 0")
    if folder_exists(spark, log):
        found = found.join(spark.read.schema(LISTED).parquet(log).select("path"), "path", "left_anti")
    found = snapshot(found, "new-files")
    n = found.count()
    if n:
        found.repartition(-(-n // FILES_PER_BATCH)).write.mode("append").parquet(log)


def ingest_folder(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    exts: Iterable[str] | None = None,
    page_reader: PageReader | None = None,
    converted_doc: bool = False,
) -> None:
    """New files of a folder, or of a glob of daily folders, with a row for each as in a batch run.

    Without ``exts`` every file counts, those without a reader as ``unsupported``. With a page
    reader the files are pdf, and with ``converted_doc`` they are the text of Word files. Files of zero length,
    which are no part of the stream, are added from a listing, once per path.

    The stream is that of the log of files beside the checkpoint, to which each round adds what is new; tasks open the files. So neither
    names nor lengths of files go through the driver.
    """
    if page_reader is not None:
        exts, transform = ["pdf"], pages_transform(page_reader)
    elif converted_doc:
        exts, transform = ["csv"], lambda raw, _=None: extract_in_one_pass(as_converted_doc(raw), ["doc"], VERSION)
    else:
        exts = None if exts is None else list(exts)
        transform = lambda raw, _=None: extract_in_one_pass(raw, exts, VERSION)
    log = f"{checkpoint}/files"
    list_new(spark, folder, exts, log)
    if folder_exists(spark, log):
        parts = spark.readStream.schema(LISTED).option("maxFilesPerTrigger", 1).option("maxFileAge", "100000d").parquet(log)
        ingest_available(parts, target, checkpoint, transform=lambda listing: transform(with_content(listing), listing))
    state = target_state(target)
    empty = empty_files(spark, folder, exts)
    # only rows of empty files can stand for one; they are told by their batch, so the rest of the target is not read
    seen = read_state(spark, state).where(F.col("batch_id") == EMPTY_BATCH).select("path")
    found = snapshot(empty.join(seen, "path", "left_anti"), "empty-files")
    if found.head(1):
        merge(transform(found).withColumn("batch_id", F.lit(EMPTY_BATCH).cast("bigint")), state, measures=MEASURES)


def batch_reports(spark: SparkSession, target: str) -> DataFrame:
    """Counts of every batch, taken while it ran: files, outcomes by status, characters of text.

    They are committed with the batch, so one that was repeated counts once, and one that broke off not at all. Empty files, which
    come beside the stream, have the batch -1 of no source.
    """
    rows = reports(spark, target)
    measured = [F.coalesce(F.col("measures").getItem(name), F.lit(0)).alias(name) for name in MEASURES]
    return rows.select("version", "source", F.coalesce("batch", F.lit(EMPTY_BATCH).cast("bigint")).alias("batch_id"), *measured)


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """The newest outcome of every file: a scan of the target as of its last commit."""
    return read_state(spark, target_state(target)).drop("batch_id", *VERSION)
