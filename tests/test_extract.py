"""Extraction of hand-made files; the expected answers are worked out by hand."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpipe.operators.extract import job
from docpipe.operators.outcomes import count_outcomes, error_listing
from tests.helpers import docx, eml, run, zipped

RAW = T.StructType([
    T.StructField("files", T.StringType()),
    T.StructField("ext", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

HTML = "<html><body><p>Claim #7:</p><p>Paid &amp; closed.</p></body></html>"
PLAIN = "HEADERab|c\r\nD,e\tF  g".encode()
RTF = rb"{\rtf1\ansi{\fonttbl{\f0 Arial;}}\uc1 Caf\'e9 \u8364? \{x\}, OK}"

CASES = {
    # runs joined by a blank, paragraphs touch, a nested paragraph repeats
    "nested.docx": (
        docx(f"<w:p>{run('Hello,')}{run('World!')}</w:p><w:p>{run('out')}<w:p>{run('in')}</w:p></w:p>"),
        ("hello worldout inin", "ok"),
    ),
    "empty.docx": (b"", (None, "error")),  # F2
    "other.docx": (zipped(readme="x"), (None, "skipped")),  # F3
    "junk.docx": (b"not a zip", (None, "error")),  # F4
    "badxml.docx": (zipped(word__document_xml="<w:document>"), (None, "error")),
    "notext.docx": (docx("<w:p/>"), ("", "ok")),
    "dots.docx": (docx(f"<w:p>{run('...')}</w:p><w:p>{run('a')}</w:p>"), ("a", "ok")),
    "mail.eml": (eml(("text/plain", "p"), ("text/html", HTML)), ("claim 7 paid  closed", "ok")),  # F5
    "two.eml": (eml(("text/html", "<p>First</p>"), ("text/html", "<p>Second</p>")), ("first", "ok")),  # F6
    "single.eml": (eml(("text/plain", "body"), multipart=False), (None, "skipped")),  # F7
    "singlehtml.eml": (eml(("text/html", "<p>x</p>"), multipart=False), (None, "skipped")),
    "nohtml.eml": (eml(("text/plain", "a"), ("text/plain", "b")), (None, "skipped")),
    "charset.eml": (
        eml(("text/html", "<p>x</p>")).replace(b"charset=utf-8", b"charset=no-such-charset"),
        (None, "error"),
    ),
    "plain.doc": (PLAIN, ("abc de f g", "ok")),  # F8
    "short.txt": (b"short", ("", "ok")),  # F9
    "broken.doc": (b"HEADER" + bytes.fromhex("6f6bfffe21"), ("ok��", "ok")),  # F10
    "bars.doc": (b"HEADERa\n|\nb", ("a b", "ok")),
    "crlf.doc": (b"1\r\n\r\n\r\n\r\n\r\nx", ("x", "ok")),
    "nothing.doc": (b"", ("", "ok")),
    "good.rtf": (RTF, ("café € x ok", "ok")),  # F11
    "brace.rtf": (rb"{\rtf1 a}}", (None, "error")),  # F12
    "latin.rtf": (b"{\\rtf1 \xe9}", (None, "error")),
    "none.rtf": (b"", (None, "error")),
    "symbols.rtf": (
        rb"{\rtf1 a\par b\tab c\~d\emdash e{\*\unknown gone}{\pict 00ff}\line f\lquote g}",
        ("a\nb\tc d—e\nf‘g", "ok"),
    ),
    "skip.rtf": (rb"{\rtf1\uc2 \u233 ab c\uc0 \u233 d{\uc1\u233?}\u233?}", ("é cédéé", "ok")),
    "negative.rtf": (rb"{\rtf1 \u-10179?\u-8704?}", ("\U0001f600", "ok")),
    "lone.rtf": (rb"{\rtf1 a\u-10179?b}", ("a�b", "ok")),
    "hexskip.rtf": (rb"{\rtf1 \u8364\'80 x}", ("€ x", "ok")),
    "breaks.rtf": (b"{\\rtf1 a\r\nb   c}", ("ab c", "ok")),
    "nonumber.rtf": (rb"{\rtf1 \u x}", (None, "error")),
    "escape.rtf": (rb"{\rtf1 a\\b\{c\}}", ("abc", "ok")),
    "open.rtf": (rb"{\rtf1 {a", ("a", "ok")),
}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(name, name.rsplit(".", 1)[1], content) for name, (content, _) in CASES.items()]
    rows += [("a.gz", "gz", b"x"), ("b.DOCX", "DOCX", b"x"), ("noext", "", b"x")]
    return spark.createDataFrame(rows, RAW)


@pytest.fixture(scope="module")
def outcomes(raw):
    return {r.files: r for r in job.extract_everything(raw).collect()}


@pytest.mark.parametrize("name", CASES)
def test_case(outcomes, name):
    row = outcomes[name]
    assert (row.raw_text, row.status) == CASES[name][1]
    assert (row.error is not None) == (row.status == "error")


def test_empty_docx_is_named(outcomes):
    assert outcomes["empty.docx"].error == "is empty"


def test_other_files_are_unsupported(outcomes):
    assert {n for n, r in outcomes.items() if r.status == "unsupported"} == {"a.gz", "b.DOCX", "noext"}


def test_one_pass_gives_the_same_rows(raw):
    def ordered(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    assert ordered(job.extract_in_one_pass(raw)) == ordered(job.extract(raw))
    assert ordered(job.extract_in_one_pass(raw, None)) == ordered(job.extract_everything(raw))
    assert ordered(job.extract_in_one_pass(raw, ["doc"])) == ordered(job.extract(raw, ["doc"]))
    plan = job.extract_in_one_pass(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan


def test_counts_add_up(raw):
    outcomes = job.extract_everything(raw)
    for row in count_outcomes(outcomes).collect():
        assert row.n_files == row.n_ok + row.n_error + row.n_skipped + row.n_unsupported
    assert sum(r.n_files for r in count_outcomes(outcomes).collect()) == raw.count()


def test_error_listing_names_a_file_once(raw):
    outcomes = job.extract_everything(raw.union(raw))
    names = [r.files for r in error_listing(outcomes).collect()]
    assert sorted(names) == sorted(n for n, (_, (_, status)) in CASES.items() if status == "error")


def test_separator(spark):
    body = f"<w:p>{run('one')}</w:p><w:p>{run('two')}</w:p>"
    raw = spark.createDataFrame([("a.docx", "docx", docx(body))], RAW)
    assert job.extract(raw, ["docx"], sep=" ").first().raw_text == "one two"


def test_unknown_format_is_refused(raw):
    with pytest.raises(ValueError, match="no reader"):
        job.extract(raw, ["xyz"])


def test_own_reader(raw):
    readers = {**job.READERS, "gz": lambda content: ["Zipped!"]}
    assert job.extract(raw, ["gz"], readers, sep="+").first().raw_text == "Zipped!"
    readers["gz"] = job.Format(lambda content: ["Zip", "ped!"], lambda parts, sep: F.lower(F.array_join(parts, sep)))
    assert job.extract(raw, ["gz"], readers, sep="-").first().raw_text == "zip-ped!"


def test_columns_can_be_carried(raw):
    rows = job.extract(raw.withColumn("n", F.length("content")), carry=["n"]).collect()
    assert all(r.n == len(CASES[r.files][0]) for r in rows)
    assert len(rows) == len(CASES)


def test_large_files_stay_whole(spark):
    """Batches are cut by size on both sides; every file arrives complete."""
    text = "word " * 400_000
    rows = [(f"{i}.rtf", "rtf", b"{\\rtf1 " + text.encode() + b"}") for i in range(30)]
    raw = spark.createDataFrame(rows, RAW).coalesce(1)
    lengths = [len(r.raw_text) for r in job.extract(raw, ["rtf"]).collect()]
    assert lengths == [len(text)] * 30


def test_content_stays_out_of_shuffles(raw):
    plan = count_outcomes(job.extract(raw))._jdf.queryExecution().toString()
    exchange = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchange and all("content" not in line for line in exchange)
