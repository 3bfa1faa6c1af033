"""Daily manifests: ``<root>/<yyyyMMdd>/Metadata/<yyyyMMdd>.csv``.

Every file is read by its own header: columns are found by name, in any order, with any others
beside them, and days may differ. A manifest of one day is usually small and read as one value, its
records and cells cut out by column expressions; large ones are read in ranges of bytes (``records``).

Nothing is lost without a word: what cannot be taken comes back as rows of its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.functions.names import DAY_STAMP
from docpipe.functions.text import decode_utf8
from docpipe.operators.joins import pinned
from docpipe.session import snapshot
from docpipe.sources.files import _oversize_unread, with_names
from docpipe.sources.listing import listed
from docpipe.sources.records import records

MANIFEST_SCHEMA = T.StructType([
    T.StructField("Object_name", T.StringType()),
    T.StructField("Prior_Version_Object_Name", T.StringType()),
    T.StructField("Document_date", T.TimestampType()),
    T.StructField("Business_segment", T.StringType()),
    T.StructField("new/changed", T.StringType()),
    T.StructField("claim_id", T.StringType()),
    T.StructField("cedent_id", T.StringType()),
])

MANIFEST_COLUMNS = MANIFEST_SCHEMA.names

# A cell in quotes may hold commas, line ends and doubled quotes; a line that breaks these rules
# is a record of its own, to be refused.
_CELL = r'(?:"(?:[^"]++|"")*+"|[^",\r\n][^,\r\n]*+|)'
_RECORD = rf"{_CELL}(?:,{_CELL})*+"
_RECORDS = rf"\G((?:{_RECORD})(?=[\r\n]|\z)|[^\r\n]*+)(?:\r\n|\n|\r|\z)"


class Manifest(NamedTuple):
    """``rows``: manifest columns and ``manifest_date``. ``rejects``: ``path, line, record, reason``."""

    rows: DataFrame
    rejects: DataFrame


def _decoded(content: Column, encoding: str) -> Column:
    name = encoding.lower()
    if name in ("windows-1252", "cp1252"):
        # Latin-1 but for the bytes 80 to 9F; Spark's decoders no longer know this charset
        codes = [bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)]
        own = [(chr(0x80 + i), c) for i, c in enumerate(codes) if c]
        return F.translate(F.decode(content, "ISO-8859-1"), "".join(a for a, _ in own), "".join(b for _, b in own))
    return decode_utf8(content) if name in ("utf-8", "utf8") else F.decode(content, encoding)


def _cells(record: Column) -> Column:
    """The cells of a record; an empty cell without quotes is null."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(rf",({_CELL})"), 1)

    def cell(c: Column) -> Column:
        inner = F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        return F.when(c.startswith('"'), inner).when(c != "", c)

    return F.transform(raw, cell)


def parse_manifests(files: DataFrame, encoding: str = "windows-1252", extra: Iterable[str] = ()) -> Manifest:
    """Manifests from raw file rows (``path, content, unread``), each file read as one value.

    ``extra`` names further columns to keep as text; they are null for files without them.
    """
    text = F.regexp_replace(_decoded(F.col("content"), encoding), "^﻿", "")
    # pinned, or the filters below would cut the whole text again for each of their conditions
    read = pinned(files.select("path", "unread", F.regexp_extract_all(text, F.lit(_RECORDS), 1).alias("records")), "records")
    first = F.array_position(F.transform("records", lambda r: r != ""), F.lit(True)).cast("int") - 1
    read = _headed(read.select("*", first.alias("first"), F.when(first >= 0, F.get("records", first)).alias("head")))
    body = read.where("file_reason IS NULL").select("path", "manifest_date", "header", "first", F.posexplode("records").alias("at", "record"))
    body = _checked(body)
    data = F.expr("record <> '' AND at > first")
    # the line of a record: one more than the line ends before it, those within quoted cells too; of good records only their line ends are moved
    refused = F.when(data, F.col("reason"))
    ends = F.regexp_count("record", F.lit(r"\r\n|\n|\r")) + 1
    counted = body.select("path", "at", ends.alias("ends"), F.when(refused.isNotNull(), F.col("record")).alias("record"), refused.alias("reason"))
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # the records of one value
    numbered = counted.withColumn("line", (F.coalesce(F.sum("ends").over(before), F.lit(0)) + 1).cast("int"))
    return Manifest(_taken(body.where(data), extra), _refused(read, numbered))


def parse_records(files: DataFrame, found: DataFrame, encoding: str = "windows-1252", extra: Iterable[str] = ()) -> Manifest:
    """The same from records cut out by many tasks (``path, at, line, record``), so a file may be of any size."""
    text = F.regexp_replace(_decoded(F.col("record"), encoding), "^﻿", "")
    body = found.select("path", "at", F.col("line").cast("int").alias("line"), text.alias("record"))
    heads = body.groupBy("path").agg(F.min(F.struct("at", "record")).alias("f")).select("path", F.col("f.at").alias("first"), F.col("f.record").alias("head"))
    heads = files.select("path", F.lit(None).cast("string").alias("unread")).join(heads, "path", "left")
    read = snapshot(_headed(heads), "manifest-heads")
    good = read.where("file_reason IS NULL").select("path", "manifest_date", "header", "first")
    body = _checked(body.join(good, "path").where("at > first"))
    return Manifest(_taken(body, extra), _refused(read, body))


def _headed(files: DataFrame) -> DataFrame:
    """Files (``path, unread, head``) with ``manifest_date``, the names in their ``header``, and why one cannot be taken."""
    stamp = F.regexp_extract("path", r"/(\d{8})/Metadata/[^/]*$", 1)
    names = F.transform(_cells(F.col("head")), lambda c: F.trim(F.coalesce(c, F.lit(""))))
    files = files.withColumns({"manifest_date": F.try_to_date(F.nullif(stamp, F.lit("")), DAY_STAMP), "header": names})
    missing = F.filter(F.array(*map(F.lit, MANIFEST_COLUMNS)), lambda c: ~F.array_contains(F.coalesce("header", F.array()), c))
    reason = (
        F.when(F.col("unread").isNotNull(), F.concat(F.lit("not read: "), F.col("unread")))
        .when(F.col("head").isNull(), "no header")
        .when(F.size(missing) > 0, F.concat(F.lit("no column "), F.array_join(missing, ", ")))
    )
    return files.withColumn("file_reason", reason)


def _value(name: str) -> Column:
    return F.get("cells", F.array_position("header", F.lit(name)).cast("int") - 1)


def _checked(body: DataFrame) -> DataFrame:
    """Records (``header, record``) with their ``cells``, and the ``reason`` why one cannot be taken."""
    body = pinned(body.withColumn("cells", _cells(F.col("record"))), "cells")
    dates = [f.name for f in MANIFEST_SCHEMA if f.dataType == T.TimestampType()]
    unread_date = F.lit(None).cast("string")
    for name in dates:
        bad = _value(name).isNotNull() & _value(name).try_cast("timestamp").isNull()
        unread_date = F.when(bad, F.concat(F.lit(f"{name} is no time: "), _value(name))).otherwise(unread_date)
    reason = (
        F.when(~F.col("record").rlike(rf"^(?:{_RECORD})\z"), "quotes do not match")
        .when(F.size("cells") != F.size("header"), F.concat_ws(" ", F.size("cells").cast("string"), F.lit("cells, not"), F.size("header").cast("string")))
        .otherwise(unread_date)
    )
    return body.withColumn("reason", reason)


def _taken(checked: DataFrame, extra: Iterable[str]) -> DataFrame:
    return checked.where("reason IS NULL").select(
        *[_value(f.name).try_cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA], *[_value(c).alias(c) for c in extra], "manifest_date"
    )


def _refused(heads: DataFrame, numbered: DataFrame) -> DataFrame:
    """Files with what is wrong with them, and the records of others that cannot be taken."""
    bad_files = heads.where("file_reason IS NOT NULL").select(
        "path", F.lit(None).cast("int").alias("line"), F.lit(None).cast("string").alias("record"), F.col("file_reason").alias("reason")
    )
    return bad_files.unionByName(numbered.where("reason IS NOT NULL").select("path", "line", "record", "reason"))


def _read(spark: SparkSession, pattern: str, encoding: str, extra: Iterable[str], range_bytes: int | None) -> Manifest:
    if range_bytes is None:
        files = _oversize_unread(spark, with_names(spark.read.format("binaryFile").load(pattern)))
        return parse_manifests(files, encoding, extra)
    files = listed(spark, pattern, ["csv"]).select("path", "length")
    return parse_records(files, records(files, range_bytes), encoding, extra)


def read_manifest_file(spark: SparkSession, path: str, encoding: str = "windows-1252", extra: Iterable[str] = ()) -> Manifest:
    """One named manifest; anything but a .csv file is refused."""
    if not path.endswith(".csv"):
        raise ValueError(f"not a manifest file: {path}")
    return _read(spark, path, encoding, extra, None)


def read_manifest(
    spark: SparkSession, root: str, run_date: dt.date, encoding: str = "windows-1252", extra: Iterable[str] = ()
) -> Manifest:
    """The manifest of the day before ``run_date``."""
    day = (run_date - dt.timedelta(days=1)).strftime("%Y%m%d")
    return read_manifest_file(spark, f"{root}/{day}/Metadata/{day}.csv", encoding, extra)


def read_backlog(
    spark: SparkSession,
    root: str,
    run_date: dt.date | None = None,
    days: int | None = None,
    encoding: str = "windows-1252",
    extra: Iterable[str] = (),
    range_bytes: int | None = None,
) -> Manifest:
    """All manifests under ``root``, or those of the ``days`` days before ``run_date``.

    One read for all folders: the date folders are pruned while listing, and folders
    that do not exist are no error. With ``range_bytes`` files are read in ranges of so many bytes by many tasks, so one file may be
    of any size; else each is read as one value.
    """
    if days is None:
        folders = "[0-9]" * 8
    else:
        if run_date is None:
            raise ValueError("days needs a run_date to count from")
        stamps = [(run_date - dt.timedelta(days=n)).strftime("%Y%m%d") for n in range(days, 0, -1)]
        folders = "{" + ",".join(stamps) + "}"
    return _read(spark, f"{root}/{folders}/Metadata/*.csv", encoding, extra, range_bytes)
