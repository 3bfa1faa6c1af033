"""The byte readers as table functions, so that SQL can call them on a column of contents.

``SELECT f.files, r.* FROM files f, LATERAL read_docx(f.content) r``
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from docpipe.operators.extract.job import READERS, Format, Reader, as_formats, read_parts
from docpipe.operators.pages import PageReader

PARTS = "part_no int, part string, status string, error string"
PAGES = "page_no int, page_text string, page_error string"


def part_function(ext: str, reader: Reader):
    """A table function of the parts a reader finds: a row each, or one row that tells why there is none."""

    class Parts:
        def eval(self, content: bytes) -> Iterator[tuple]:
            parts, status, error = read_parts({ext: reader}, ext, content)
            if not parts:
                yield None, None, status, error
            else:
                for number, part in enumerate(parts):
                    yield number, part, status, error

    return udtf(Parts, returnType=PARTS, useArrow=True)


def page_function(reader: PageReader):
    """A table function of the pages a reader finds; a file it fails on is one row with the error."""

    class Pages:
        def eval(self, content: bytes) -> Iterator[tuple]:
            if content is None:
                yield None, None, "content not read"
                return
            try:
                for number, text, error in reader(bytes(content)):
                    yield number, text, error
            except Exception as problem:
                yield None, None, str(problem) or type(problem).__name__

    return udtf(Pages, returnType=PAGES, useArrow=True)


def register_readers(
    spark: SparkSession, readers: Mapping[str, Format | Reader] = READERS, pages: Mapping[str, PageReader] | None = None
) -> list[str]:
    """Register ``read_<ext>(content)`` for every reader, and ``read_<name>_pages(content)`` for page readers; returns the names."""
    made = {f"read_{ext}": part_function(ext, f.read) for ext, f in as_formats(readers).items()}
    made |= {f"read_{name}_pages": page_function(reader) for name, reader in (pages or {}).items()}
    for name, function in made.items():
        spark.udtf.register(name, function)
    return list(made)
