"""Cleaning functions against Python's own string functions."""

import os
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docpipe.functions import html, names, text

# characters that matter to the patterns, and any others
SPECIAL = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff|.,!AaZz\xc9\xe9"
TEXT = st.text(
    st.one_of(st.sampled_from(SPECIAL), st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs"])), max_size=40
)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select(expression(F.col("v")), "i").orderBy("i").collect()]


def check(spark, values, expression, python):
    assert apply(spark, values, expression) == [python(v) for v in values]


BATCH = st.lists(TEXT, min_size=1, max_size=60)


@SETTINGS
@given(BATCH)
def test_punctuation(spark, values):
    table = str.maketrans("", "", string.punctuation)
    check(spark, values, text.delete_chars, lambda v: v.translate(table))


def test_other_character_sets(spark):
    check(spark, ["a.b,c"], lambda c: text.delete_chars(c, "."), lambda v: "ab,c")
    check(spark, ["a.b,c"], lambda c: text.delete_chars(c, ""), lambda v: v)


def test_every_character_of_the_first_planes(spark):
    values = [chr(i) for i in range(1, 0x3001) if not 0xD800 <= i < 0xE000]
    table = str.maketrans("", "", string.punctuation)
    check(spark, values, text.delete_chars, lambda v: v.translate(table))
    check(spark, [f"a{v}b" for v in values], text.collapse_whitespace, lambda v: " ".join(v.split()))
    check(spark, [f"a{v}b" for v in values], text.join_lines, lambda v: "".join(v.splitlines()))


@SETTINGS
@given(BATCH)
def test_whitespace(spark, values):
    check(spark, values, text.collapse_whitespace, lambda v: " ".join(v.split()))


@SETTINGS
@given(BATCH)
def test_line_joining(spark, values):
    check(spark, values, text.join_lines, lambda v: "".join(v.splitlines()))


@SETTINGS
@given(st.lists(st.binary(max_size=30), min_size=1, max_size=60))
def test_decoding(spark, values):
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "i int, v binary")
    got = [r[0] for r in df.select(text.decode_utf8(F.col("v")), "i").orderBy("i").collect()]
    assert got == [v.decode("utf-8", "replace") for v in values]


def python_plain(value):
    import re

    value = re.sub("\r\n?", "\n", value)
    value = re.sub(" +", " ", value)[6:].replace("|", "")
    value = re.sub("\t+", " ", re.sub("[\r\n]+", " ", value))
    return value.translate(str.maketrans("", "", string.punctuation)).lower()


@SETTINGS
@given(st.lists(st.text(st.sampled_from(" \t\n\r|.,aB1é"), max_size=40), min_size=1, max_size=60))
def test_plain_text(spark, values):
    check(spark, values, text.clean_plain_text, python_plain)


def python_page(value):
    import re

    value = re.sub(r"(\s+|\t|\r|\n)", " ", "".join(value.splitlines())).strip().lower()
    return " ".join(value.split())


@SETTINGS
@given(st.lists(st.text(st.sampled_from(SPECIAL), max_size=40), min_size=1, max_size=60))
def test_page_text(spark, values):
    check(spark, values, text.clean_page_text, python_page)


def test_page_text_without_punctuation(spark):
    check(spark, ["a , b.\nC"], lambda c: text.clean_page_text(c, strip_punctuation=True), lambda v: "a bc")


NAMES = ["a.b.c", ".bashrc", "..a", "a.", "noext", "x.docx", "x.tar.gz", "..a.b", "", "a b.txt", "..."]


def test_extension(spark):
    check(spark, NAMES, names.extension, lambda v: os.path.splitext(v)[1])
    check(spark, NAMES, names.stem, lambda v: os.path.splitext(v)[0])


def test_listed_types(spark):
    exts = ["", ".c", ".gz", ".doc", ".docx", ".xhtml"]
    check(spark, exts, names.listed_type, lambda v: 3 <= len(v) <= 5)


def test_names(spark):
    check(spark, ["/a/b/c.docx", "c", "s3://x/y.rtf"], names.basename, os.path.basename)
    check(spark, ["docx", "PDF", "eml"], names.title_case, str.title)
    values = ["a.docx", "a.docx.docx", "a.docxx", "docx", "xdocx"]
    check(spark, values, lambda c: names.replace_suffix(c, ".docx"), lambda v: v.removesuffix(".docx"))
    check(spark, ["a.csv", "csv.x"], lambda c: names.replace_suffix(c, "csv", "doc"), lambda v: {"a.csv": "a.doc"}.get(v, v))


PAGES = {
    "<p>a</p><p>b</p>": ["a", "b"],
    "<p>a</p> \n <p>b</p>": ["a", "\n", "b"],
    "<p>a</p>   <p>b</p>": ["a", " ", "b"],
    "<pre>  </pre><p>x</p>": ["  ", "x"],
    "<!DOCTYPE html><p>x</p>": ["html", "x"],
    "<!-- note --><script>var a = '<p>';</script>": [" note ", "var a = '<p>';"],
    "a &amp; b<br>c": ["a & b", "c"],
    "caf&eacute; &#8364;<b>x": ["café €", "x"],
    "<![CDATA[raw]]>": ["raw"],
    "": [],
}


@pytest.mark.parametrize("page", PAGES)
def test_string_nodes(page):
    assert html.string_nodes(page) == PAGES[page]


def test_html_columns(spark):
    page = "<html><head><style>p{}</style><script>x < y</script></head><body><!-- no --><p>A&nbsp;&lt;b&gt;</p>c</body>"
    assert apply(spark, [page], html.visible_text) == ["A <b> c"]
    loud = "<SCRIPT>var x;</Script><STYLE>p{}</STYLE><P>A &#8364;&#x1F600;&#39;&#xD800;b&#99999999; &#;</P>"
    assert apply(spark, [loud], html.visible_text) == ["A €😀'�b&#99999999; &#;"]
    assert apply(spark, [None, "<p>x</p>"], html.all_nodes) == [None, ["x"]]
