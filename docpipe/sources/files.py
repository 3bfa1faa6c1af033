"""Raw document folders: tasks list them and open the files over Arrow's file systems; streams use Spark's ``binaryFile`` source."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.functions.names import basename, extension, listed_type, replace_suffix
from docpipe.session import snapshot
from docpipe.sources.listing import LISTED, arrow_file, file_opener, has_match, has_root, listed

BINARY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

# Partitions of a scan that one task reads at most, see ``packed``.
SCANS_PER_TASK = 32
# Content read before it goes to the JVM, and content for one task, of files that tasks open.
READ_BYTES = 8 * 1024 * 1024
TASK_BYTES = 64 * 1024 * 1024
# Content of the files in one part of a written listing; Spark deals up to 32 small parts to a task.
PART_BYTES = 16 * 1024 * 1024


def name_glob(exts: Iterable[str]) -> str:
    """Glob for file names with one of the extensions (no dot, case-sensitive)."""
    return "*.{" + ",".join(exts) + "}"


def with_names(binary: DataFrame) -> DataFrame:
    """Add ``files`` (base name) and ``ext`` (no dot) to binaryFile rows."""
    name = basename(F.col("path"))
    return binary.select(
        name.alias("files"),
        F.substring(extension(name), 2, 2**31 - 1).alias("ext"),
        "path",
        "modificationTime",
        "length",
        "content",
    )


def empty_files(spark: SparkSession, folder: str, exts: Iterable[str] | None = None) -> DataFrame:
    """The files of a folder or glob whose length is zero, which Spark's sources leave out; tasks list them."""
    empty = listed(spark, folder, exts).where("length = 0").withColumn("content", F.lit("").cast("binary"))
    return with_names(empty).withColumn("unread", F.lit(None).cast("string"))


def folder_scan(spark: SparkSession, folder: str, exts: Iterable[str] | None = None) -> DataFrame:
    """The binaryFile rows of a folder or glob; the extensions are matched while listing."""
    reader = spark.read.format("binaryFile")
    return (reader if exts is None else reader.option("pathGlobFilter", name_glob(exts))).load(folder)


def with_content(listing: DataFrame) -> DataFrame:
    """The files of a listing (``path, modificationTime, length``) as raw file rows; tasks open them over Arrow's file systems.

    So the driver knows no file. Above Spark's size limit ``content`` is null, and ``unread`` says so.
    """
    return _opened(_dealt(listing, TASK_BYTES))


def _dealt(listing: DataFrame, part_bytes: int) -> DataFrame:
    """The files in parts of about so much content, but several parts per core."""
    narrow = listing.select("path", "modificationTime", "length")
    total = narrow.agg(F.sum("length")).first()[0] or 0
    return narrow.repartition(max(4 * listing.sparkSession.sparkContext.defaultParallelism, -(-total // part_bytes)), "path")


def _opened(listing: DataFrame, folder: str | None = None) -> DataFrame:
    """The raw file rows of a listing as it is dealt; of one folder, all files are opened over one connection."""
    limit = int(listing.sparkSession.conf.get("spark.sql.sources.binaryFile.maxLength", str(2**31 - 1)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = (lambda path: arrow_file(path)[0]) if folder is None else file_opener(folder)
        for batch in batches:
            start, held, size = 0, [], 0
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                if size and size + length > READ_BYTES:
                    yield _filled(batch, start, held)
                    start, held, size = start + len(held), [], 0
                if not 0 < length <= limit:
                    held.append(b"" if length == 0 else None)
                    continue
                with open_(path) as file:
                    held.append(file.read())
                size += len(held[-1])
            if held:
                yield _filled(batch, start, held)

    found = with_names(listing.mapInArrow(read, f"{LISTED}, content binary"))
    why = F.concat(F.col("length").cast("string"), F.lit(f" bytes are above the limit of {limit}"))
    return found.withColumn("unread", F.when(F.col("length") > limit, why))


def _filled(batch: pa.RecordBatch, start: int, contents: list) -> pa.RecordBatch:
    part = batch.slice(start, len(contents))
    return pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary())], names=[*batch.schema.names, "content"])


def packed(scan: DataFrame) -> DataFrame:
    """The same rows in fewer tasks, without a shuffle: up to ``SCANS_PER_TASK`` partitions of a scan, but several tasks per core.

    Spark counts opening a file as much as reading 4 MB, so of small files it deals no more than 32 to a task.
    """
    parts = scan.rdd.getNumPartitions()
    tasks = max(8 * scan.sparkSession.sparkContext.defaultParallelism, -(-parts // SCANS_PER_TASK))
    return scan.coalesce(tasks) if tasks < parts else scan


def raw_files(spark: SparkSession, folder: str, exts: Iterable[str]) -> DataFrame:
    """Files of one folder with one of the extensions, empty ones included.

    Not recursive, also where a folder in it is named like a partition; the match is exact and
    case-sensitive and happens while listing, so other files are never opened. A missing folder is an
    error. The folder is listed now, by tasks, and the listing is written, in parts of about as much
    content; later steps open the files in tasks. So the driver knows no file. Above Spark's size limit
    ``content`` is null, and ``unread`` says so.
    """
    if has_root(folder):
        found = snapshot(listed(spark, folder, list(exts)), "listing")
        if not found.isEmpty() or has_match(spark, folder):
            return _opened(snapshot(_dealt(found, PART_BYTES), "listing"), folder)
    raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {folder}.")


def _oversize_unread(spark: SparkSession, found: DataFrame) -> DataFrame:
    """Null content for files Spark cannot hold in one value, instead of a failed job.

    The test on ``length`` reaches the source, so each file is opened by one side only.
    """
    limit = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str(2**31 - 1)))
    oversize = found.where(F.col("length") > limit).withColumns({
        "content": F.lit(None).cast("binary"),
        "unread": F.concat(F.col("length").cast("string"), F.lit(f" bytes are above the limit of {limit}")),
    })
    return found.where(F.col("length") <= limit).withColumn("unread", F.lit(None).cast("string")).unionByName(oversize)


def as_converted_doc(files: DataFrame) -> DataFrame:
    """Word 97 files that were converted to text: ``x.csv`` stands for ``x.doc``."""
    return files.withColumns({"files": replace_suffix(F.col("files"), ".csv", ".doc"), "ext": F.lit("doc")})


def converted_doc_files(spark: SparkSession, folder: str) -> DataFrame:
    return as_converted_doc(raw_files(spark, folder, ["csv"]))


def list_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Every file of one folder or glob, empty ones included, without its content; tasks list it."""
    return with_names(listed(spark, folder).withColumn("content", F.lit(None).cast("binary"))).drop("content")


def raw_file_stream(
    spark: SparkSession,
    folder: str,
    exts: Iterable[str] | None = None,
    max_files_per_trigger: int = 100_000,
) -> DataFrame:
    """New files of one folder, or of a glob of daily folders, as a stream.

    A path is taken once: a new version has to come under a new path, such as the
    next day's folder. Files above Spark's size limit come without content. Files of
    zero length are not seen by a stream; ``streaming.ingest.ingest_folder`` adds them.

    By default files older than a week, seen from the newest file, would be skipped
    after the first batch; the age here is beyond any file's.
    """
    stream = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("maxFileAge", "100000d")
    )
    if exts is not None:
        stream = stream.option("pathGlobFilter", name_glob(exts))
    return _oversize_unread(spark, with_names(stream.load(folder)))


def select_by_extension(files: DataFrame, ext: str, name_col: str = "files") -> DataFrame:
    """Rows whose name ends in exactly ``.ext``."""
    return files.where(extension(F.col(name_col)) == "." + ext)


def distinct_file_types(files: DataFrame, name_col: str = "files") -> DataFrame:
    """Extensions (with dot) of three to five characters."""
    return files.select(extension(F.col(name_col)).alias("ext")).where(listed_type(F.col("ext"))).distinct()


def sample_files(files: DataFrame, n: int = 100, name_col: str = "files") -> DataFrame:
    """``n`` files in an order that looks random but is the same on every run.

    A top-n by digest: each task keeps its own best ``n`` and only those meet.
    """
    return files.orderBy(F.md5(F.col(name_col)), name_col).limit(n)


def sample_per_type(files: DataFrame, n: int = 100, name_col: str = "files") -> DataFrame:
    """``n`` files of each extension, in the same random-looking order as ``sample_files``, with ``ext``.

    Each task keeps its own first ``n`` of an extension, and only those are shuffled, so an extension that most files
    have is no burden for one task. Spark does so for ``n`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``.
    """
    drawn = Window.partitionBy("ext").orderBy(F.md5(F.col(name_col)), name_col)
    typed = files.withColumn("ext", extension(F.col(name_col)))
    return typed.withColumn("nth", F.row_number().over(drawn)).where(F.col("nth") <= n).drop("nth")
