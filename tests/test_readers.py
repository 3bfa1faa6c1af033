"""Byte readers on generated documents, without Spark."""

import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.functions.html import string_nodes
from docpipe.functions.table_functions import register_readers
from docpipe.operators.extract.docx import read_docx
from docpipe.operators.extract.eml import read_eml
from docpipe.operators.extract.job import READERS, read_parts
from docpipe.operators.extract.rtf import read_rtf
from docpipe.plans.stand_in import pack_docx
from tests.helpers import docx, eml, run, zipped

LETTERS = st.text(
    st.one_of(st.sampled_from(string.printable), st.characters(min_codepoint=0x20, exclude_categories=["Cs", "Cc"])),
    max_size=60,
)
PRINTABLE = LETTERS.map(lambda t: re.sub("[\x00-\x08\x0b-\x1f\x7f-\x9f￾￿]", "", t))


def rtf_of(text: str, unicode_words: bool) -> bytes:
    out = []
    for char in text:
        if char in "\\{}":
            out.append("\\" + char)
        elif char == "\n":
            out.append("\\par ")
        elif char == "\t":
            out.append("\\tab ")
        elif ord(char) > 127 and unicode_words:
            units = char.encode("utf-16-le")
            for i in range(0, len(units), 2):
                code = int.from_bytes(units[i : i + 2], "little")
                out.append(f"\\u{code - 0x10000 if code > 0x7FFF else code}?")
        else:
            out.append(char)
    return ("{\\rtf1\\ansi{\\fonttbl{\\f0 Arial;}}{\\*\\generator x;}" + "".join(out) + "}").encode()


@settings(max_examples=200, deadline=None)
@given(PRINTABLE, st.booleans())
def test_rtf_round_trip(text, unicode_words):
    text = text.replace("\r", "")
    assert read_rtf(rtf_of(text, unicode_words)) == [text]


@settings(max_examples=100, deadline=None)
@given(PRINTABLE)
def test_docx_round_trip(text):
    text = text.replace("\r", "")
    assert read_docx(pack_docx(text)) == [line for line in text.split("\n") if line]


@settings(max_examples=100, deadline=None)
@given(PRINTABLE)
def test_eml_round_trip(text):
    text = " ".join(text.split())
    escaped = text.replace("&", "&amp;").replace("<", "&lt;")
    assert "".join(read_eml(eml(("text/html", f"<p>x{escaped}</p>")))).strip() == f"x{text}"


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=200), st.sampled_from(sorted(READERS)))
def test_any_bytes_give_a_row(content, ext):
    parts, status, error = read_parts({e: f.read for e, f in READERS.items()}, ext, content)
    assert status in ("ok", "error", "skipped")
    assert (parts is not None) == (status == "ok") and (error is not None) == (status == "error")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "a", " ", "\n", "<!-- c -->", "<pre>", "</pre>", "&amp;", "<br>"]), max_size=20))
def test_nodes_keep_all_visible_characters(pieces):
    letters = sum(p == "a" for p in pieces)
    assert "".join(string_nodes("".join(pieces))).count("a") == letters


def test_readers_as_table_functions(spark):
    def pages(content):
        for n, page in enumerate(content.split(b"|")):
            if page == b"broken":
                raise ValueError("cut off")
            yield n, page.decode(), None if page else "blank"

    assert register_readers(spark, pages={"cut": pages})[-1] == "read_cut_pages"
    body = docx(f"<w:p>{run('A')}</w:p><w:p>{run('B')}</w:p>")
    files = [("a", body), ("b", b"no zip"), ("c", b""), ("d", None), ("e", zipped(other_xml="<x/>"))]
    spark.createDataFrame(files, "files string, content binary").createOrReplaceTempView("files_of_readers")
    sql = "SELECT f.files, r.part_no, r.part, r.status, r.error IS NULL FROM files_of_readers f, LATERAL read_docx(f.content) r"
    got = sorted((tuple(r) for r in spark.sql(sql).collect()), key=repr)
    assert got == [
        ("a", 0, "A", "ok", True), ("a", 1, "B", "ok", True), ("b", None, None, "error", False), ("c", None, None, "error", False),
        ("d", None, None, "error", False), ("e", None, None, "skipped", True),
    ]
    cut = [(1, b"x||y"), (2, b"x|broken|y"), (3, None)]
    spark.createDataFrame(cut, "id int, content binary").createOrReplaceTempView("cut_of_readers")
    got = spark.sql("SELECT f.id, r.* FROM cut_of_readers f, LATERAL read_cut_pages(f.content) r").collect()
    assert sorted((tuple(r) for r in got), key=repr) == [
        (1, 0, "x", None), (1, 1, "", "blank"), (1, 2, "y", None), (2, 0, "x", None), (2, None, None, "cut off"), (3, None, None, "content not read"),
    ]
