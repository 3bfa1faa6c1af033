"""Files that arrive as pages: ``files, page_no, page_text, page_error``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.functions.text import clean_page_text, collapse_whitespace
from docpipe.sources.snapshots import PAGES_SCHEMA

# Pages joined in one step. A file is put together in two rounds, so even a file
# that owns a third of all pages is spread over many tasks in the first.
PAGES_PER_BLOCK = 256

_PAGES_ARROW = pa.schema([
    ("files", pa.string()),
    ("page_no", pa.int32()),
    ("page_text", pa.string()),
    ("page_error", pa.string()),
])

PageReader = Callable[[bytes], "Iterable[tuple[int, str | None, str | None]]"]


def _page(name: str, page_no: int, text: str | None, error: str | None) -> dict:
    """A page row; a text that Arrow could not carry is an error of this page."""
    try:
        (text or "").encode()
    except UnicodeEncodeError as problem:
        text, error = None, error or str(problem)
    return {"files": name, "page_no": page_no, "page_text": text, "page_error": error}


def read_pages(raw: DataFrame, page_reader: PageReader) -> DataFrame:
    """Page rows from file bytes with a reader the caller brings.

    The reader yields ``(page_no, text, error)``. If it raises, the file gets one
    row without a page number that carries the error; a file without pages gets one
    row with neither.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("files"), batch.column("content")):
                rows, empty = [], True
                try:
                    if not content.is_valid:
                        raise ValueError("content not read")
                    for page_no, text, error in page_reader(content.as_py()):
                        empty = False
                        rows.append(_page(name.as_py(), page_no, text, error))
                        if len(rows) == PAGES_PER_BLOCK:
                            yield pa.RecordBatch.from_pylist(rows, schema=_PAGES_ARROW)
                            rows = []
                except Exception as problem:
                    empty = False
                    rows.append({"files": name.as_py(), "page_error": str(problem) or type(problem).__name__})
                if empty:
                    rows.append({"files": name.as_py()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_PAGES_ARROW)

    return raw.select("files", "content").mapInArrow(run, PAGES_SCHEMA)


def clean_pages(pages: DataFrame, strip_punctuation: bool = False) -> DataFrame:
    """Cleaned page text; a failed page keeps its error and has no text."""
    text = F.when(F.col("page_error").isNull(), clean_page_text(F.col("page_text"), strip_punctuation))
    return pages.withColumn("page_text", text)


def pages_long(pages: DataFrame) -> DataFrame:
    """``files, page, page_text`` with pages called 'page 0', 'page 1', ..."""
    good = pages.where(F.col("page_error").isNull() & F.col("page_no").isNotNull())
    return good.select("files", F.concat(F.lit("page "), F.col("page_no").cast("string")).alias("page"), "page_text")


def page_blocks(pages: DataFrame, sep: str = "") -> DataFrame:
    """Text of each run of ``PAGES_PER_BLOCK`` pages.

    Blocks are also the form to keep when a whole file would not fit into one value.
    """
    block = F.floor(F.col("page_no") / PAGES_PER_BLOCK)
    return pages.groupBy("files", block.alias("block_no")).agg(
        F.expr(f"listagg(page_text, {_literal(sep)}) within group (order by page_no)").alias("block_text"),
        F.count_if(F.col("page_no").isNotNull()).alias("n_pages"),
        F.count_if(F.col("page_error").isNotNull()).alias("n_page_errors"),
        F.min("page_error").alias("page_error"),
    )


def assemble_blocks(blocks: DataFrame, sep: str = "") -> DataFrame:
    """One row per file from its blocks, in block order."""
    return blocks.groupBy("files").agg(
        F.coalesce(
            F.expr(f"listagg(block_text, {_literal(sep)}) within group (order by block_no)"), F.lit("")
        ).alias("raw_text"),
        F.sum("n_pages").alias("n_pages"),
        F.sum("n_page_errors").alias("n_page_errors"),
        F.min("page_error").alias("page_error"),
    )


def assemble_pages(pages: DataFrame, sep: str = "") -> DataFrame:
    """One row per file: its good pages in order. A failed page leaves the file ok.

    ``error`` still tells of failed pages. A file that could not be opened at all has
    no pages and is an error.
    """
    failed = F.col("n_page_errors")
    unreadable = (F.col("n_pages") == 0) & (failed > 0)
    partly = F.concat(failed.cast("string"), F.lit(" of "), F.col("n_pages").cast("string"), F.lit(" pages failed"))
    return assemble_blocks(page_blocks(pages, sep), sep).select(
        "files",
        "raw_text",
        "n_pages",
        "n_page_errors",
        F.when(unreadable, "error").otherwise("ok").alias("status"),
        F.when(unreadable, F.col("page_error")).when(failed > 0, partly).alias("error"),
    )


def page_outcomes(pages: DataFrame, ext: str = "pdf", sep: str = "") -> DataFrame:
    """Outcome rows, as the byte formats have them, from cleaned pages."""
    return assemble_pages(pages, sep).select(
        "files",
        F.lit(ext).alias("ext"),
        F.when(F.col("status") == "ok", F.col("raw_text")).alias("raw_text"),
        "status",
        "error",
    )


def route_empty_text(texts: DataFrame) -> DataFrame:
    """Files without any text need optical character recognition.

    Null and white space of any kind are no text. Files that failed or have no reader are not
    text either; they keep their status as the route.
    """
    text = F.col("raw_text")
    empty = text.isNull() | (collapse_whitespace(text) == "")
    route = F.when(empty, "needs_ocr").otherwise("text")
    if "status" in texts.columns:
        route = F.when(F.col("status") == "ok", route).otherwise(F.col("status"))
    return texts.withColumn("route", route)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
