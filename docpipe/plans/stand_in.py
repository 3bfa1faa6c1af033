"""Document folders, page sets and manifests made from the test tables.

The pipeline's own inputs are binary files; these functions derive them, in Spark
and row by row, from the tables a query is given.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.functions.names import DAY_STAMP, extension

WORD_XMLNS = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """One task per core: the test tables have one row group, which would be one task.

    Only stand-ins do this; it is a shuffle of all rows.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def busy_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows cost much work each; a single row group still uses all cores."""
    return spread(table(spark, sf_dir, name))


def doc_name(suffix: str | Column = "", number: str = "doc_id") -> Column:
    suffix = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.lit("doc_"), F.col(number).cast("string"), suffix)


def file_suffix() -> Column:
    """A suffix per document, from its language and length."""
    lang, n = F.col("lang"), F.col("n_chars")
    return (
        F.when(n < 200, "")
        .when(lang == "en", F.when(n < 1000, ".DOCX").otherwise(".docx"))
        .when(lang == "de", ".rtf")
        .when(lang == "fr", ".eml")
        .otherwise(F.when(n < 1000, ".doc").otherwise(".pdf"))
    )


def files_view(spark: SparkSession, sf_dir: str, load=table) -> DataFrame:
    return load(spark, sf_dir, "documents").withColumn("files", doc_name(file_suffix()))


def plain_bytes(text: Column) -> Column:
    return F.concat(F.lit("HEADER"), text).cast("binary")


def rtf_bytes(text: Column, tail: Column | None = None) -> Column:
    """Text as rtf, a \\par per line."""
    body = text
    for plain, coded in (("\\", "\\\\"), ("{", "\\{"), ("}", "\\}"), ("\n", "\\par ")):
        body = F.replace(body, F.lit(plain), F.lit(coded))
    head = "{\\rtf1\\ansi{\\fonttbl{\\f0 Arial;}}\\uc1 "
    return F.concat(F.lit(head), body, F.lit("}"), F.lit("") if tail is None else tail).cast("binary")


def html_escape(text: Column) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def eml_bytes(html: Column) -> Column:
    """A multipart message with a plain and an html part."""
    head = (
        "From: a@example.com\r\nTo: b@example.com\r\nSubject: claim\r\nMIME-Version: 1.0\r\n"
        'Content-Type: multipart/alternative; boundary="edge"\r\n\r\n'
        "--edge\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nsee html\r\n"
        "--edge\r\nContent-Type: text/html; charset=utf-8\r\nContent-Transfer-Encoding: base64\r\n\r\n"
    )
    return F.concat(F.lit(head), F.base64(html.cast("binary")), F.lit("\r\n--edge--\r\n")).cast("binary")


def single_part_bytes(text: Column) -> Column:
    head = "From: a@example.com\r\nContent-Type: text/plain; charset=utf-8\r\n\r\n"
    return F.concat(F.lit(head), text).cast("binary")


def pack_docx(text: str) -> bytes:
    """A minimal docx, one paragraph per line."""
    lines = (f"<w:p><w:r><w:t>{escape(line)}</w:t></w:r></w:p>" for line in text.split("\n"))
    xml = f'<w:document xmlns:w="{WORD_XMLNS}"><w:body>{"".join(lines)}</w:body></w:document>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("word/document.xml", xml)
    return out.getvalue()


@F.pandas_udf(T.BinaryType())
def docx_bytes(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else pack_docx(t))


def raw_of(documents: DataFrame, ext: str, content: Column) -> DataFrame:
    """Every document as a file of one format."""
    return documents.select(
        doc_name(f".{ext}").alias("files"), F.lit(ext).alias("ext"), content.alias("content")
    )


def named_files(spark: SparkSession, sf_dir: str, load=busy_table) -> DataFrame:
    """``files, ext`` and the text behind each file of a folder of all formats."""
    files = files_view(spark, sf_dir, load)
    return files.select("files", F.substring(extension(F.col("files")), 2, 100).alias("ext"), "text", "n_chars")


def mixed_raw(spark: SparkSession, sf_dir: str, exts: list[str]) -> DataFrame:
    """The raw files of some extensions, some of them damaged; one scan.

    Short docx files are empty, short rtf files have a brace too many and short
    e-mails have no html part. Bytes are built for the extensions asked for.
    """
    text, n, ext = F.col("text"), F.col("n_chars"), F.col("ext")
    content = {
        "doc": lambda: plain_bytes(text),
        "docx": lambda: F.when(n < 1500, F.lit("").cast("binary")).otherwise(docx_bytes(F.when(ext == "docx", text))),
        "rtf": lambda: rtf_bytes(text, F.when(n < 1000, "}").otherwise("")),
        "eml": lambda: F.when(n < 1000, single_part_bytes(text)).otherwise(
            eml_bytes(F.concat(F.lit("<p>"), html_escape(text), F.lit("</p>")))
        ),
    }
    bytes_of = F.lit(None).cast("binary")
    for e in content.keys() & set(exts):
        bytes_of = F.when(ext == e, content[e]()).otherwise(bytes_of)
    return named_files(spark, sf_dir).where(ext.isin(exts)).select("files", "ext", bytes_of.alias("content"))


def pages_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pdf files of the folder, a page per line; very short lines are failed pages."""
    pdf = files_view(spark, sf_dir, busy_table).where(F.col("files").endswith(".pdf"))
    lines = pdf.select("files", F.posexplode(F.split("text", "\n")).alias("page_no", "page_text"))
    return lines.withColumn("page_error", F.when(F.length("page_text") < 20, "too short"))


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as files, turns as pages."""
    return busy_table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("files"),
        F.col("turn").cast("int").alias("page_no"),
        F.col("text").alias("page_text"),
        F.lit(None).cast("string").alias("page_error"),
    )


def manifest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as manifest rows."""
    status = F.col("o_orderstatus")
    customer = F.col("o_custkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        doc_name(number="o_custkey").alias("Object_name"),
        F.when(status != "O", doc_name(number="o_orderkey")).alias("Prior_Version_Object_Name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Document_date"),
        F.col("o_orderpriority").alias("Business_segment"),
        F.when(status == "F", "Changed").otherwise("New").alias("new/changed"),
        customer.alias("claim_id"),
        F.concat(F.lit("cedent_"), customer).alias("cedent_id"),
        F.col("o_orderkey").cast("string").alias("object_id"),
        F.col("o_orderdate").cast("date").alias("manifest_date"),
    )


def order_links(spark: SparkSession, sf_dir: str, lengths: list[int]) -> DataFrame:
    """Orders as versions of documents: in each thousand of keys chains of one length, every order replacing the one before.

    In every fourth thousand the first of a chain names its middle as its prior version: a cycle with a tail.
    """
    key = F.col("o_orderkey")
    length = F.get(F.array(*map(F.lit, lengths)), (F.floor(key / 1000) % len(lengths)).cast("int"))
    at = (key % 1000) % length
    back = F.when(at > 0, key - 1).when((F.floor(key / 1000) % 4 == 3) & (length > 1), key + F.floor(length / 2))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ord_"), key.cast("string")).alias("name"), F.concat(F.lit("ord_"), back.cast("string")).alias("prior")
    )


def mapping_view(spark: SparkSession, sf_dir: str, suffix: str = ".doc") -> DataFrame:
    """Labels as the mapping: business values by file name."""
    return table(spark, sf_dir, "labels").select(doc_name(suffix).alias("files"), "quality", "toxic")


def write_bytes(rows: DataFrame, root: str) -> None:
    """Each row (``path`` below the root, ``content``) as a file of the shared folder."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
                with fs.open_output_stream(f"{base}/{path}", compression=None) as out:
                    out.write(content)
            yield pa.record_batch([pa.array([batch.num_rows])], names=["n"])

    rows.select("path", "content").mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest file per order date. Even days have another order of columns and one more column."""
    view = manifest_view(spark, sf_dir).withColumn("Business_segment", F.concat("Business_segment", F.lit(' "€", x')))
    names = ["Object_name", "Prior_Version_Object_Name", "Document_date", "Business_segment", "new/changed", "claim_id", "cedent_id", "object_id"]

    def line(columns: list[str]) -> Column:
        cell = lambda c: F.concat(F.lit('"'), F.replace(F.col(f"`{c}`"), F.lit('"'), F.lit('""')), F.lit('"'))
        return F.concat_ws(",", *[F.coalesce(cell(c), F.lit("")) for c in columns])

    other = [*reversed(names), "claim_id"]
    even = F.dayofmonth("manifest_date") % 2 == 0
    body = F.when(even, F.concat(line(other), F.lit(","), F.col("object_id"))).otherwise(line(names))
    head = F.when(even, ",".join([*reversed(names), "again", "more"])).otherwise(",".join(names))
    days = view.select("manifest_date", head.alias("head"), body.alias("line")).groupBy("manifest_date", "head").agg(
        F.array_join(F.array_sort(F.collect_list("line")), "\r\n").alias("lines")  # the orders of one day
    )
    day = F.date_format("manifest_date", DAY_STAMP)
    text = F.concat("head", F.lit("\r\n"), "lines", F.lit("\r\n"))
    latin = F.translate(text, "€", "\x80")  # windows-1252
    return days.select(F.concat(day, F.lit("/Metadata/"), day, F.lit(".csv")).alias("path"), F.encode(latin, "ISO-8859-1").alias("content"))
