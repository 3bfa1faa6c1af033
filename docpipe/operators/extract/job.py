"""The extraction job: raw file rows in, one row of cleaned text per file out.

Only bytes go to Python. A reader turns the content of one file into a list of
strings (paragraphs, text nodes, ...); all cleaning happens in columns afterwards.
Plain text never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.functions.text import clean_nodes, clean_paragraphs, clean_plain_text, clean_rtf_text, decode_utf8
from docpipe.operators.extract.docx import read_docx
from docpipe.operators.extract.eml import read_eml
from docpipe.operators.extract.rtf import read_rtf

Reader = Callable[[bytes], "list[str] | None"]


def joined(parts: Column, sep: str) -> Column:
    """The parts as they are."""
    return F.array_join(parts, sep)


@dataclass(frozen=True)
class Format:
    """A byte reader, and the rule that makes one text of the parts it returns.

    A reader returns None for a file it has nothing to say about.
    """

    read: Reader
    clean: Callable[[Column, str], Column] = joined


READERS: dict[str, Format] = {
    "docx": Format(read_docx, clean_paragraphs),
    "eml": Format(read_eml, lambda parts, _: clean_nodes(parts)),
    "rtf": Format(read_rtf, lambda parts, _: clean_rtf_text(joined(parts, ""))),
}
PLAIN = ("doc", "txt")
SUPPORTED = (*PLAIN, *READERS)


def as_formats(readers: Mapping[str, Format | Reader]) -> dict[str, Format]:
    """A bare reader's parts are joined and not cleaned."""
    return {ext: f if isinstance(f, Format) else Format(f) for ext, f in readers.items()}


OUTCOME_COLUMNS = ["files", "ext", "raw_text", "status", "error"]

RESULT_FIELDS = [
    T.StructField("parts", T.ArrayType(T.StringType())),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
]

# error of a file whose content is null
NOT_READ = "content not read"

# text collected before a batch goes back to the JVM
FLUSH_CHARS = 4 * 1024 * 1024


def read_parts(readers: dict[str, Reader], ext: str, content: bytes | None):
    """``(parts, status, error)`` of one file; a failing file is a row, not a crash."""
    if ext not in readers:
        return None, "unsupported", None
    if content is None:
        return None, "error", NOT_READ
    try:
        parts = readers[ext](content)
        if parts is None:
            return None, "skipped", None
        "".join(parts).encode()  # what Arrow could not carry is an error of this file
        return parts, "ok", None
    except Exception as problem:
        return None, "error", str(problem) or type(problem).__name__


def _read_batches(readers: dict[str, Reader], keys: list[str]):
    def packed(batch, start, results):
        parts, status, error = zip(*results)
        columns = [batch.column(k).slice(start, len(results)) for k in keys]
        columns += [pa.array(parts, pa.list_(pa.string())), pa.array(status, pa.string()), pa.array(error, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*keys, "parts", "status", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, results, size = 0, [], 0
            for ext, content in zip(batch.column("ext"), batch.column("content")):
                results.append(read_parts(readers, ext.as_py(), content.as_py()))
                size += sum(map(len, results[-1][0] or ()))
                if size >= FLUSH_CHARS:
                    yield packed(batch, start, results)
                    start, results, size = start + len(results), [], 0
            if results:
                yield packed(batch, start, results)

    return run


def _outcome(raw: DataFrame, carry: Iterable[str], text: Column, status: Column, error: Column) -> DataFrame:
    return raw.select("files", "ext", text.alias("raw_text"), status.alias("status"), error.alias("error"), *carry)


def _null() -> Column:
    return F.lit(None).cast("string")


def _not_read(raw: DataFrame) -> Column:
    """Why a row has no content, as far as its source says."""
    if "unread" not in raw.columns:
        return F.lit(NOT_READ)
    return F.when(F.col("unread").isNull(), NOT_READ).otherwise(F.concat(F.lit(f"{NOT_READ}: "), F.col("unread")))


def extract_coded(
    raw: DataFrame, readers: Mapping[str, Format | Reader] = READERS, sep: str = "", carry: Iterable[str] = ()
) -> DataFrame:
    """Formats that need a byte reader. Only the columns named here go to Python."""
    formats = as_formats(readers)
    keys = ["files", "ext", *carry]
    narrow = raw.select(*keys, _not_read(raw).alias("not_read"), "content")
    schema = T.StructType([narrow.schema[k] for k in [*keys, "not_read"]] + RESULT_FIELDS)
    read = {ext: f.read for ext, f in formats.items()}
    parts = narrow.mapInArrow(_read_batches(read, [*keys, "not_read"]), schema)
    text = F.lit(None).cast("string")
    for ext, f in formats.items():
        text = F.when(F.col("ext") == ext, f.clean(F.col("parts"), sep)).otherwise(text)
    error = F.when(F.col("error") == NOT_READ, F.col("not_read")).otherwise(F.col("error"))
    return _outcome(parts, carry, F.when(F.col("status") == "ok", text), F.col("status"), error)


def extract_plain(raw: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Plain text formats, in columns only."""
    text = clean_plain_text(decode_utf8(F.col("content")))
    unread = F.col("content").isNull()
    return _outcome(
        raw, carry, text, F.when(unread, "error").otherwise("ok"), F.when(unread, _not_read(raw))
    )


def read_plain(content: bytes) -> list[str]:
    return [content.decode("utf-8", "replace")]


ONE_PASS = {
    **dict.fromkeys(PLAIN, Format(read_plain, lambda parts, _: clean_plain_text(joined(parts, "")))),
    **READERS,
}


def extract_in_one_pass(raw: DataFrame, exts: Iterable[str] | None = SUPPORTED, carry: Iterable[str] = ()) -> DataFrame:
    """Same rows as ``extract`` for a source that should be read only once.

    With several kinds of formats even plain text goes through Python then. Without a choice of
    extensions every file gets a row, those without a reader as ``unsupported``.
    """
    if exts is not None:
        exts = list(exts)
        raw = raw.where(F.col("ext").isin(exts))
        if set(exts) <= set(PLAIN):
            return extract_plain(raw, carry)
    return extract_coded(raw, ONE_PASS, carry=carry)


def unsupported(raw: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Files no reader is registered for; their content is not read."""
    return _outcome(raw, carry, _null(), F.lit("unsupported"), _null())


def extract_from(
    load: Callable[[list[str]], DataFrame],
    exts: Iterable[str] = SUPPORTED,
    readers: Mapping[str, Format | Reader] = READERS,
    sep: str = "",
    carry: Iterable[str] = (),
) -> DataFrame:
    """One outcome row per file of the given extensions.

    ``load`` returns the raw rows of some extensions, so that each branch reads
    only its own files: a glob on a folder, a partition filter on a table.
    ``carry`` names raw columns to keep.
    """
    exts, carry = list(exts), list(carry)
    unknown = [e for e in exts if e not in PLAIN and e not in readers]
    if unknown:
        raise ValueError(f"no reader for {unknown}")
    plain = [e for e in exts if e in PLAIN]
    coded = [e for e in exts if e in readers]
    branches = []
    if plain:
        branches.append(extract_plain(load(plain), carry))
    if coded:
        branches.append(extract_coded(load(coded), readers, sep, carry))
    return reduce(DataFrame.unionByName, branches)


def extract(
    raw: DataFrame,
    exts: Iterable[str] = SUPPORTED,
    readers: Mapping[str, Format | Reader] = READERS,
    sep: str = "",
    carry: Iterable[str] = (),
) -> DataFrame:
    """``extract_from`` on a DataFrame of raw rows with an ``ext`` column."""
    return extract_from(lambda some: raw.where(F.col("ext").isin(some)), exts, readers, sep, carry)


def extract_everything(
    raw: DataFrame, readers: Mapping[str, Format | Reader] = READERS, sep: str = "", carry: Iterable[str] = ()
) -> DataFrame:
    """Like ``extract``, plus an ``unsupported`` row for every other file."""
    known, carry = [*PLAIN, *readers], list(carry)
    return extract(raw, known, readers, sep, carry).unionByName(unsupported(other_files(raw, known), carry))


def other_files(raw: DataFrame, known: Iterable[str]) -> DataFrame:
    return raw.where(~F.col("ext").isin(list(known)) | F.col("ext").isNull())
