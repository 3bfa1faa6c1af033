"""Sources and sinks on real files."""

import datetime as dt
import inspect
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F

from docpipe import session
from docpipe.operators import manifest as m
from docpipe.operators.extract.job import extract_from
from docpipe.operators.key_history import add_days, attach_keys_as_of, has_history, in_force, read_history
from docpipe.plans.run import Folders, extract_folder, run_daily, run_format
from docpipe.sinks import files as sink
from docpipe.sinks import log, state, tables
from docpipe.sources import files as source
from docpipe.sources import listing, manifests
from docpipe.sources.listing import listed
from docpipe.sources.mapping import first_lines, read_mapping
from docpipe.sources.snapshots import read_outcomes, read_snapshot, rows_of_map
from docpipe.streaming import ingest
from docpipe.streaming.ingest import TARGET_SCHEMA, batch_reports, ingest_available, ingest_folder, merge_batch, read_target, target_state
from docpipe.streaming.manifests import ingest_manifests, manifest_log, read_rejects
from tests.helpers import docx, eml, run

DAY = dt.date(2019, 5, 8)


def fill(folder, **contents):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in contents.items():
        (folder / name.replace("__", ".")).write_bytes(content)
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# files


def test_listing(spark, tmp_path):  # F18
    folder = fill(tmp_path / "raw", a__docx=b"x", b__DOCX=b"x", c__doc=b"x")
    fill(tmp_path / "raw" / "sub", d__docx=b"x")
    assert rows(source.raw_files(spark, folder, ["docx"]).select("files", "ext")) == [("a.docx", "docx")]
    found = source.list_folder(spark, folder)
    assert "content" not in found.columns
    assert rows(found.select("files")) == [("a.docx",), ("b.DOCX",), ("c.doc",)]
    assert rows(source.distinct_file_types(found)) == [(".DOCX",), (".doc",), (".docx",)]
    assert rows(source.select_by_extension(found, "docx").select("files")) == [("a.docx",)]


def test_empty_files_are_listed_once(spark, tmp_path):
    folder = fill(tmp_path / "raw", a__docx=b"", c__docx=b"xyz", d__eml=b"")
    (tmp_path / "raw" / "odd #1%.docx").write_bytes(b"")
    (tmp_path / "raw" / "odd #2%.docx").write_bytes(b"z")
    found = source.raw_files(spark, folder, ["docx"])
    assert rows(found.select("files", "length")) == [("a.docx", 0), ("c.docx", 3), ("odd #1%.docx", 0), ("odd #2%.docx", 1)]
    assert bytes(found.where("files = 'a.docx'").first().content) == b""
    assert source.list_folder(spark, folder).count() == 5


def test_file_above_the_size_limit_is_an_error_row(spark, tmp_path):
    folder = fill(tmp_path / "raw", a__rtf=b"{\\rtf1 fits}", b__rtf=b"{\\rtf1 " + b"x" * 500 + b"}", c__doc=b"y" * 500)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        outcomes = extract_from(lambda exts: source.raw_files(spark, folder, exts))
        assert rows(outcomes.select("files", "raw_text", "status", "error")) == [
            ("a.rtf", "fits", "ok", None),
            ("b.rtf", None, "error", "content not read: 508 bytes are above the limit of 100"),
            ("c.doc", None, "error", "content not read: 500 bytes are above the limit of 100"),
        ]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_files_that_arrive_late_are_never_taken_for_empty(spark, tmp_path):
    folder = fill(tmp_path / "raw", a__docx=b"x", b__docx=b"")
    found = source.raw_files(spark, folder, ["docx"])
    fill(tmp_path / "raw", late__docx=b"sixteen bytes ok")
    assert rows(found.select("files", "length")) == [("a.docx", 1), ("b.docx", 0)]
    assert rows(source.raw_files(spark, folder, ["docx"]).select("files", "length"))[-1] == ("late.docx", 16)


def test_globs_match_as_in_spark(spark, tmp_path):
    for folder in ("day0", "day1", "day12", "other", "_hidden", "day1/deep"):
        fill(tmp_path / folder, a__docx=b"x", b__doc=b"xy", _c__docx=b"x")
    for pattern in ("day[01]", "day{0,12}", "*", "day?", "d*[^2]", "day1/deep", "{other,day1}/*", "day\\[", "none*"):
        folder = f"{tmp_path}/{pattern}"
        try:
            expected = rows(source.folder_scan(spark, folder, ["docx", "doc"]).selectExpr("path", "modificationTime", "length"))
        except AnalysisException:
            expected = []
        assert rows(listed(spark, folder, ["docx", "doc"])) == expected, pattern
        assert rows(listed(spark, f"file://{folder}", ["doc"])) == [r for r in expected if r[0].endswith(".doc")]


def test_listing_of_many_names_stays_in_tasks(spark, tmp_path, monkeypatch):
    for n in range(200):
        folder = tmp_path / "raw" / f"day{n:03}"
        folder.mkdir(parents=True)
        for i in range(500):
            (folder / f"f{i}.txt").touch()
    (tmp_path / "raw" / "day007" / "full.txt").write_bytes(b"x")
    received = []
    for name in ("collect", "toLocalIterator", "toArrow", "toPandas", "first", "head", "take"):
        monkeypatch.setattr(type(spark.range(0)), name, lambda *_: received.append(_) or pytest.fail("rows came to the driver"))
    found = listed(spark, f"{tmp_path}/raw/*", ["txt"])
    empty = source.empty_files(spark, f"{tmp_path}/raw/*", ["txt"])
    assert found.count() == 100_001 and empty.count() == 100_000 and received == []
    assert found.groupBy(F.spark_partition_id()).count().count() >= 8  # many tasks listed
    assert "_jdf" not in inspect.getsource(source) + inspect.getsource(listing)


def test_folder_is_listed_without_a_join(spark, tmp_path):
    folder = fill(tmp_path / "raw", a__docx=b"x", b__docx=b"", c__doc=b"y")
    plan = extract_from(lambda exts: source.raw_files(spark, folder, exts))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_small_files_share_tasks(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for n in range(6000):
        (folder / f"f{n}.txt").write_bytes(b"HEADER" + str(n).encode())
    found = source.raw_files(spark, str(folder), ["txt"])
    assert found.rdd.getNumPartitions() <= 10 * spark.sparkContext.defaultParallelism
    assert found.selectExpr("count(*)", "count(distinct content)").first() == (6000, 6000)


def test_folder_without_a_match(spark, tmp_path):
    folder = fill(tmp_path / "raw", a__eml=b"x")
    assert source.raw_files(spark, folder, ["docx"]).count() == 0


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        source.raw_files(spark, str(tmp_path / "none"), ["docx"])


def test_driver_knows_no_file_of_a_folder(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for n in range(300):
        (folder / f"f{n}.txt").write_bytes(b"HEADER" + str(n).encode())
        (folder / f"e{n}.rtf").write_bytes(b"{\\rtf1 x}")
    outcomes = extract_from(lambda exts: source.raw_files(spark, str(folder), exts), ["txt", "rtf"])
    known = outcomes.inputFiles()
    assert len(known) <= 8 * spark.sparkContext.defaultParallelism and not [f for f in known if str(folder) in f]
    assert rows(outcomes.groupBy("ext", "status").count()) == [("rtf", "ok", 300), ("txt", "ok", 300)]


def test_raw_files_are_those_of_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source, "READ_BYTES", 10)
    names = ["a", "_a", ".a", "_a=1", "_metadata", "_metadata=1", "odd #1%20", "\u00fc [x] {y}", "b"]
    for n, name in enumerate(names):
        fill(tmp_path / f"day{n % 2}", **{f"{name}.docx": name.encode() * (1 + 9 * (n % 3)), f"{name}.doc": b"x"})
    fill(tmp_path / "day0" / "deep", a__docx=b"x")
    (tmp_path / "day1" / "folder.docx").mkdir()
    os.symlink(tmp_path / "day0" / "a.docx", tmp_path / "day1" / "linked.docx")
    os.symlink(tmp_path / "gone", tmp_path / "day1" / "broken.docx")
    for pattern in ("day0", "day1", "day[01]", "day1/*", "day?/[a-z]*"):
        folder = f"{tmp_path}/{pattern}"
        expected = [(*r[:5], bytes(r[5]), None) for r in rows(source.with_names(source.folder_scan(spark, folder, ["docx"])))]
        for found in (source.raw_files(spark, folder, ["docx"]), source.raw_files(spark, f"file://{folder}", ["docx"])):
            assert [(*r[:5], bytes(r[5]), r[6]) for r in rows(found)] == expected, pattern
    assert len(expected) == 5


def test_glob_without_a_match_is_an_error(spark, tmp_path):
    (tmp_path / "raw" / "empty").mkdir(parents=True)
    assert source.raw_files(spark, f"{tmp_path}/raw/*", ["docx"]).count() == 0
    for pattern in ("raw/none*", "raw/empty/*", "none/*", "{raw,none}/*/none"):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            source.raw_files(spark, f"{tmp_path}/{pattern}", ["docx"])


def test_listing_does_not_read_content(spark, tmp_path):
    folder = fill(tmp_path / "raw", a__docx=b"x")
    plan = source.list_folder(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_sample_is_repeatable(spark):
    names = spark.range(1000).selectExpr("concat('f', id) AS files")
    first, second = rows(source.sample_files(names, 100)), rows(source.sample_files(names.repartition(7), 100))
    assert first == second and len(first) == 100


# mapping


def test_mapping_file(spark, tmp_path):  # F15
    path = tmp_path / "m.csv"
    path.write_bytes(b"files,meta\na.docx,1,2\nb.docx\n\nc.docx,\xff\r\nd.docx,")
    df = read_mapping(spark, str(path))
    assert df.columns == ["files", "meta"]
    assert rows(df) == sorted(
        [("a.docx", "1,2"), ("b.docx", None), ("", None), ("c.docx", "�"), ("d.docx", "")], key=repr
    )


def test_mapping_names_come_from_the_first_two_fields(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("files,claim,more\na,1,2\n")
    assert read_mapping(spark, str(path)).columns == ["files", "claim"]


@pytest.mark.parametrize("block", ["128MB", "1000"])
def test_one_header_line_per_file_whatever_the_blocks(spark, tmp_path, block):
    body = [f"f{i},claim {i}" for i in range(200)]
    lines = ["files,meta", *body, "files,meta", *body, "files,meta", "x"]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.csv").write_text("\n".join(lines))
    (tmp_path / "m" / "b.csv").write_text("files,meta\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = read_mapping(spark, str(tmp_path / "m"))
        assert got.count() == 403 and got.where("files = 'files'").count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_mapping_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("files,meta\na,1\n")
    (tmp_path / "b.csv").write_text("files,claim\nb,2\nc,3\n")
    with pytest.raises(ValueError, match="different headers"):
        read_mapping(spark, str(tmp_path))


def test_header_check_sorts_nothing_and_reads_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("files,meta\na,1\n")
    lines = spark.read.text(str(tmp_path)).selectExpr("value", "_metadata.file_path AS path", "_metadata.file_block_start AS start")
    plan = first_lines(lines, lines.value == "files,meta")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "HashAggregate" in plan and plan.count("FileScan") == 1


def test_bad_mapping_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "one.csv").write_text("files\na\n")
    for name in ("empty.csv", "one.csv"):
        with pytest.raises(ValueError):
            read_mapping(spark, str(tmp_path / name))


# manifests


def write_manifest(root, day, *lines):
    folder = root / day / "Metadata"
    folder.mkdir(parents=True)
    header = "Object_name,Prior_Version_Object_Name,Document_date,Business_segment,new/changed,claim_id,cedent_id"
    (folder / f"{day}.csv").write_bytes("\n".join([header, *lines]).encode("cp1252"))


@pytest.fixture
def manifest_root(tmp_path):
    write_manifest(tmp_path, "20190506", "old,,2019-05-01 00:00:00,seg,New,1,9")
    write_manifest(
        tmp_path,
        "20190507",
        "price € – list,prior one,2019-05-02 10:00:00,seg,Changed,2,9",
        "second,,2019-05-03 00:00:00,seg,New,3,9",
    )
    write_manifest(tmp_path, "20190401", "early,,2019-04-01 00:00:00,seg,New,4,9")
    (tmp_path / "20190505").mkdir()
    return str(tmp_path)


def test_manifest_of_the_day_before(spark, manifest_root):
    df, rejects = manifests.read_manifest(spark, manifest_root, DAY)
    assert rejects.count() == 0
    assert rows(df.select("Object_name", "manifest_date")) == [
        ("price € – list", dt.date(2019, 5, 7)),
        ("second", dt.date(2019, 5, 7)),
    ]
    assert df.columns == [*manifests.MANIFEST_COLUMNS, "manifest_date"]
    assert rows(m.changed(df).select("claim_id")) == [("2",)]
    assert rows(m.has_prior(df).select("Prior_Version_Object_Name")) == [("prior one",)]
    assert rows(m.preview(df, "Object_name", n=1).select("claim_id")) == [("2",)]


def test_backlog(spark, manifest_root):
    names = lambda found: [r[0] for r in rows(found.rows.select("claim_id"))]
    assert names(manifests.read_backlog(spark, manifest_root)) == ["1", "2", "3", "4"]
    assert names(manifests.read_backlog(spark, manifest_root, DAY, 5)) == ["1", "2", "3"]
    assert names(manifests.read_backlog(spark, manifest_root, DAY, 1)) == ["2", "3"]
    days = manifests.read_backlog(spark, manifest_root).rows.select("manifest_date").distinct()
    assert [r[0] for r in rows(days)] == [dt.date(2019, 4, 1), dt.date(2019, 5, 6), dt.date(2019, 5, 7)]


def test_columns_are_found_by_name_and_rejects_come_back(spark, tmp_path):
    write_manifest(tmp_path, "20190506", "a,,2019-05-01,seg,New,1,9")
    folder = tmp_path / "20190507" / "Metadata"
    folder.mkdir(parents=True)
    header = "claim_id,more,cedent_id,new/changed,Business_segment,Document_date,Prior_Version_Object_Name,Object_name,object_id"
    (folder / "x.csv").write_bytes("\r\n".join([
        header, '77,"x, ""y""\r\nz",9,Changed,"two\nlines",2019-05-02 10:00:00,"",b €,o7', "78,m,9,New,seg,not a date,,c,o8", "79,m,9,New", '80,"m,9,New,seg,,,d,o9',
    ]).encode("cp1252"))
    (folder / "short.csv").write_bytes(b"Object_name,claim_id\na,1\n")
    found = manifests.read_backlog(spark, str(tmp_path), extra=["object_id"])
    got = {r.Object_name: r for r in found.rows.collect()}
    assert set(got) == {"a", "b €"} and got["a"].object_id is None
    b = got["b €"]
    assert (b.claim_id, b.cedent_id, b["new/changed"], b.Business_segment, b.Prior_Version_Object_Name, b.object_id) == (
        "77", "9", "Changed", "two\nlines", "", "o7"
    )
    assert b.Document_date == dt.datetime(2019, 5, 2, 10) and b.manifest_date == dt.date(2019, 5, 7)
    rejects = {(r.path.rpartition("/")[2], r.line): r.reason for r in found.rejects.collect()}
    # two line ends in quoted cells come before them
    assert rejects[("x.csv", 5)].startswith("Document_date is no time") and rejects[("x.csv", 6)] == "4 cells, not 9"
    assert rejects[("x.csv", 7)] == "quotes do not match" and "no column Prior_Version" in rejects[("short.csv", None)]
    assert len(rejects) == 4


def test_backlog_needs_a_date(spark, manifest_root):
    with pytest.raises(ValueError):
        manifests.read_backlog(spark, manifest_root, days=3)


def test_only_manifest_files(spark):
    with pytest.raises(ValueError, match="not a manifest"):
        manifests.read_manifest_file(spark, "x.xls")


def test_backlog_dates(spark):  # F22
    days = m.backlog_dates(spark.createDataFrame([(DAY,)], "run_date date"), 5).orderBy("manifest_date")
    assert [r.day_stamp for r in days.collect()] == ["20190503", "20190504", "20190505", "20190506", "20190507"]
    assert m.backlog_dates(spark.createDataFrame([(DAY,)], "run_date date"), 0).count() == 0


def test_processed_log(spark, manifest_root, tmp_path):
    path = str(tmp_path / "log")
    everything = manifests.read_backlog(spark, manifest_root).rows
    log.mark_processed(everything.where("manifest_date < '2019-05-07'"), path)
    left = m.unprocessed(everything, log.read_log(spark, path))
    assert rows(left.select("claim_id")) == [("2",), ("3",)]
    log.mark_processed(left, path)
    log.mark_processed(left, path)
    assert m.unprocessed(everything, log.read_log(spark, path)).count() == 0
    assert log.last_processed(spark, path) == dt.date(2019, 5, 7)


# CSV, snapshots, tables


def test_csv_keeps_cells(spark, tmp_path):  # F20
    cells = ['say "hi", you', "a\nb", "a\r\nb", "  blanks  ", "tab\t", "\\", 'end\\"', "", None, "=1"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, cell string")
    path, n = sink.write_csv(df, str(tmp_path), "MergedDataFrame", "docx", DAY)
    assert n == len(cells)
    assert path.endswith("/Docx_MergedDataFrame_2019_05_08.csv")
    back = [r.cell for r in sink.read_csv(spark, path, df.schema).orderBy("i").collect()]
    assert back == [c or None for c in cells]


def test_csv_parts_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "CSV_BYTES_PER_PART", 100_000)
    df = spark.range(400).selectExpr("id", "repeat('x', 5000) AS cell").coalesce(1)
    path, n = sink.write_csv(df, str(tmp_path), "MergedDataFrame", "docx", DAY)
    sizes = [f.stat().st_size for f in (tmp_path / path.rpartition("/")[2]).glob("part-*")]
    assert n == 400 and len(sizes) > 15 and max(sizes) < 300_000
    assert sink.read_csv(spark, path, df.schema).count() == 400


def test_snapshot_replaces_only_its_own_part(spark, tmp_path):
    path = str(tmp_path / "snap")
    schema = "files string, ext string, raw_text string, status string, error string"
    write = lambda r, day: sink.write_snapshot(spark.createDataFrame(r, schema), path, day)
    write([("a.doc", "doc", "old", "ok", None), ("a.rtf", "rtf", "r", "ok", None)], DAY)
    write([("a.doc", "doc", "earlier", "ok", None)], DAY - dt.timedelta(days=1))
    write([("a.doc", "doc", "new", "ok", None), ("b.doc", "doc", None, "error", "e"), ("n", "", None, "unsupported", None)], DAY)
    assert rows(read_snapshot(spark, path, "doc", DAY)) == [("a.doc", "new")]
    assert rows(read_snapshot(spark, path, "rtf", DAY)) == [("a.rtf", "r")]
    assert rows(read_snapshot(spark, path, "doc", DAY - dt.timedelta(days=1))) == [("a.doc", "earlier")]
    assert rows(read_outcomes(spark, path).where("ext = ''").select("files")) == [("n",)]
    plan = read_snapshot(spark, path, "doc", DAY)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "doc" in filters and "run_date" in filters


def test_map_to_rows(spark):
    df = spark.sql("SELECT map('a.doc', 'x', 'b.doc', '') AS texts")
    assert rows(rows_of_map(df, "texts")) == [("a.doc", "x"), ("b.doc", "")]


@pytest.fixture
def database(spark):
    name = f"db_{dt.datetime.now():%H%M%S%f}"
    tables.create_database(spark, name, session.scratch_path(spark, "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_table_is_loaded_by_name(spark, database):
    table = f"{database}.t"
    tables.create_table(spark, table)
    assert spark.table(table).dtypes == list(tables.TEXT_COLUMNS.items())
    df = spark.createDataFrame(
        [Row(extracted_text="t", file_extension="doc", filename="f", claim_id=7, object_id=1, extra="x")]
    )
    tables.overwrite_table(df, table)
    tables.overwrite_table(df, table)
    assert rows(spark.table(table)) == [("1", "7", "f", "doc", "t")]
    tables.create_table(spark, table)
    assert tables.overwrite_table(df.union(df), table) == 2
    assert tables.overwrite_table(df, table) == 1
    assert tables.run_sql(spark, "SELECT count(*) AS n", f"FROM {table}").first().n == 1
    with pytest.raises(ValueError, match="needs columns"):
        tables.overwrite_table(df.drop("filename"), table)
    tables.drop_table(spark, table)
    tables.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


# the whole run


def test_docx_run(spark, tmp_path, database):
    raw = fill(
        tmp_path / "raw",
        a__docx=docx(f"<w:p>{run('Claim, one')}</w:p>"),
        b__docx=docx(f"<w:p>{run('Two')}</w:p>"),
        c__docx=b"",
        d__docx=b"junk",
        e__eml=b"x",
    )
    (tmp_path / "m.csv").write_text("files,claim\na.docx,7\na.docx,8\nc.docx,9\nz.docx,1\n")
    folders = Folders(raw, str(tmp_path / "snap"), str(tmp_path / "err"))
    args = ("docx", folders, str(tmp_path / "m.csv"), str(tmp_path / "csv"), f"{database}.docx", DAY)
    for _ in range(2):
        table = run_format(spark, *args, keys={"claim_id": "claim"})
        assert rows(table) == [
            (None, "7", "a.docx", "docx", "claim one"),
            (None, "8", "a.docx", "docx", "claim one"),
        ]
    errors = spark.read.csv(str(tmp_path / "err" / "ErrorFileDocx_2019_05_08.csv"), header=True)
    assert [r[0] for r in rows(errors)] == ["c.docx", "d.docx"]
    counts = extract_folder(spark, "docx", folders, DAY).first()
    assert (counts.n_files, counts.n_ok, counts.n_error) == (4, 2, 2)


def test_empty_text_stays_empty_in_the_table(spark, tmp_path, database):
    raw = fill(tmp_path / "raw", a__csv=b"HEADER", b__csv=b"HEADERx")
    (tmp_path / "m.csv").write_text("files,claim\na.doc,7\nb.doc,8\n")
    folders = Folders(raw, str(tmp_path / "snap"), str(tmp_path / "err"))
    table = run_format(spark, "doc", folders, str(tmp_path / "m.csv"), str(tmp_path / "csv"), f"{database}.doc", DAY)
    assert rows(table.select("filename", "extracted_text")) == [("a.doc", ""), ("b.doc", "x")]


def test_daily_runs(spark, tmp_path, database):
    def day(stamp, *lines):
        folder = tmp_path / "in" / stamp / "Metadata"
        folder.mkdir(parents=True)
        header = "object_id,Object_name,Prior_Version_Object_Name,Document_date,Business_segment,new/changed,claim_id,cedent_id"
        (folder / f"{stamp}.csv").write_bytes("\n".join([header, *lines]).encode("cp1252"))

    day("20190505", "o1,a,,2019-05-01,s,New,1,9", "broken")
    day("20190506", "o2,a,,2019-05-02,s,Changed,2,9")
    day("20190507", "o3,b,,2019-05-03,s,New,3,9")
    raw = fill(tmp_path / "raw", a__rtf=b"{\\rtf1 A}", b__rtf=b"{\\rtf1 B}", c__rtf=b"")
    folders = Folders(raw, str(tmp_path / "snap"), str(tmp_path / "err"))

    def go(run_date, days):
        report = run_daily(
            spark, "rtf", folders, str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "csv"), f"{database}.t", run_date, days
        )
        return report and {r.stage: r.n for r in report.collect()}

    table = lambda: rows(spark.table(f"{database}.t").select("object_id", "claim_id", "filename", "extracted_text"))
    first = go(DAY, 3)
    assert table() == [("o2", "2", "a.rtf", "a"), ("o3", "3", "b.rtf", "b")]
    assert first == {
        "source_total": 3, "daily_files": 1, "extracted": 2, "csv_rows": 2, "table_rows": 2, "cluster_rows": 2,
        "source_less_daily": 2, "extracted_and_errors": 3,
    }
    rejects = spark.read.csv(str(tmp_path / "err" / "ErrorFileManifest_2019_05_08.csv"), header=True)
    assert [r.record for r in rejects.collect()] == ["broken"]
    assert go(DAY, 3) is None and log.last_processed(spark, str(tmp_path / "log")) == dt.date(2019, 5, 7)
    day("20190508", "o4,b,,2019-05-04,s,Changed,4,9")
    assert go(DAY + dt.timedelta(days=1), 2)["daily_files"] == 1
    assert table() == [("o2", "2", "a.rtf", "a"), ("o4", "4", "b.rtf", "b")]
    # a growing folder, and a day that comes late: it does not hide what later days said
    fill(tmp_path / "raw", d__rtf=b"{\\rtf1 D}", e__rtf=b"{\\rtf1 E}")
    day("20190504", "o5,d,,2019-05-04,s,New,5,9", "o0,a,,2019-05-04,s,New,0,9")
    day("20190509", "o6,e,,2019-05-09,s,New,6,9")
    go(DAY + dt.timedelta(days=2), 9)
    after = [("o2", "2", "a.rtf", "a"), ("o4", "4", "b.rtf", "b"), ("o5", "5", "d.rtf", "d"), ("o6", "6", "e.rtf", "e")]
    assert table() == after
    history = read_history(spark, str(tmp_path / "log_keys")).where("Object_name = 'a'")
    assert rows(history.selectExpr("day(valid_from)", "day(valid_to)", "object_id")) == [(4, 5, "o0"), (5, 6, "o1"), (6, None, "o2")]
    # logged days without a history: it is made anew
    session.remove(spark, str(tmp_path / "log_keys"))
    day("20190510", "o7,nobody,,2019-05-09,s,New,6,9")
    go(DAY + dt.timedelta(days=3), 1)
    assert table() == after


def manifest_rows(spark, *rows_):
    """``name, day of May, object_id`` as manifest rows."""
    values = [(n, None if d is None else dt.date(2019, 5, d), o, "c" + o, None, "New") for n, d, o in rows_]
    return spark.createDataFrame(
        values, "Object_name string, manifest_date date, object_id string, claim_id string, Prior_Version_Object_Name string, `new/changed` string"
    )


def test_key_history_in_any_order_of_days(spark, tmp_path):
    days = {1: [("a", 1, "a1"), ("b", 1, "b1")], 2: [("a", 2, "a2"), ("a", 2, "a0")], 4: [("a", 4, "a4"), ("c", 4, "c4")], 7: [("b", 7, "b7")]}
    expected = [("a", 1, 2, "a1"), ("a", 2, 4, "a2"), ("a", 4, None, "a4"), ("b", 1, 7, "b1"), ("b", 7, None, "b7"), ("c", 4, None, "c4")]
    for n, order in enumerate([[1, 2, 4, 7], [7, 4, 2, 1], [4, 4, 1, 7, 1, 2, 7]]):
        path = str(tmp_path / f"keys{n}")
        assert not has_history(spark, path)
        for day in order:
            add_days(manifest_rows(spark, *days[day], (None, day, "x"), ("z", None, "x")), path, buckets=3)
        history = read_history(spark, path)
        assert rows(history.selectExpr("Object_name", "day(valid_from)", "day(valid_to)", "object_id")) == sorted(expected, key=repr)
    add_days(manifest_rows(spark, ("a", 2, "corrected")), path)
    history = read_history(spark, path)
    got = {r.Object_name: r.object_id for r in in_force(history, dt.date(2019, 5, 3)).collect()}
    assert got == {"a": "corrected", "b": "b1"}
    texts = spark.createDataFrame(
        [(n, None if d is None else dt.date(2019, 5, d), f"{n}{d}") for n, d in [("a", 1), ("a", 3), ("a", 9), ("b", 6), ("c", 3), ("d", 3), (None, 3), ("a", None)]],
        "Object_name string, day date, raw_text string",
    )
    got = attach_keys_as_of(texts, history, "day").select("raw_text", "object_id")
    assert rows(got) == sorted(
        [("a1", "a1"), ("a3", "corrected"), ("a9", "a4"), ("b6", "b1"), ("c3", None), ("d3", None), ("None3", None), ("aNone", None)], key=repr
    )


def test_repeated_run_forgets_files_that_are_gone(spark, tmp_path):
    raw = fill(tmp_path / "raw", a__rtf=b"{\\rtf1 a}", b__eml=b"x")
    folders = Folders(raw, str(tmp_path / "snap"), str(tmp_path / "err"))
    extract_folder(spark, "rtf", folders, DAY - dt.timedelta(days=1))
    assert extract_folder(spark, "rtf", folders, DAY).first().n_ok == 1
    (tmp_path / "raw" / "a.rtf").rename(tmp_path / "raw" / "a.txt")
    assert extract_folder(spark, "rtf", folders, DAY).count() == 0
    assert read_snapshot(spark, folders.snapshots, "rtf", DAY).count() == 0
    assert read_snapshot(spark, folders.snapshots, "rtf", DAY - dt.timedelta(days=1)).count() == 1


def test_pdf_run(spark, tmp_path):
    raw = fill(tmp_path / "raw", a__pdf=b"One\fTwo", b__pdf=b"broken")

    def reader(content):
        if content == b"broken":
            raise OSError("cannot open")
        return [(i, page.decode(), None) for i, page in enumerate(content.split(b"\f"))]

    folders = Folders(raw, str(tmp_path / "snap"), str(tmp_path / "err"), str(tmp_path / "pages"))
    counts = extract_folder(spark, "pdf", folders, DAY, page_reader=reader).first()
    assert (counts.n_ok, counts.n_error) == (1, 1)
    assert rows(read_snapshot(spark, folders.snapshots, "pdf", DAY)) == [("a.pdf", "onetwo")]
    with pytest.raises(ValueError, match="page_reader"):
        extract_folder(spark, "pdf", folders, DAY)


def test_doc_run_reads_converted_files(spark, tmp_path):
    raw = fill(tmp_path / "raw", a__csv=b"HEADERSome, text", b__doc=b"binary", c__csv=b"")
    folders = Folders(raw, str(tmp_path / "snap"), str(tmp_path / "err"))
    counts = extract_folder(spark, "doc", folders, DAY).first()
    assert (counts.ext, counts.n_files, counts.n_ok) == ("doc", 2, 2)
    assert rows(read_snapshot(spark, folders.snapshots, "doc", DAY)) == [("a.doc", "some text"), ("c.doc", "")]


def test_unknown_format_does_nothing(spark, tmp_path):
    folders = Folders(str(tmp_path), str(tmp_path / "snap"), str(tmp_path / "err"))
    assert extract_folder(spark, "xyz", folders, DAY) is None
    assert not (tmp_path / "snap").exists()


# streaming


def test_stream_of_manifests_takes_late_days_once(spark, tmp_path):
    root, history, rejects = tmp_path / "in", str(tmp_path / "keys"), str(tmp_path / "rejects")

    def day(stamp, *lines, name=None):
        folder = root / stamp / "Metadata"
        folder.mkdir(parents=True, exist_ok=True)
        header = "object_id,Object_name,Prior_Version_Object_Name,Document_date,Business_segment,new/changed,claim_id,cedent_id"
        (folder / f"{name or stamp}.csv").write_bytes("\n".join([header, *lines]).encode("cp1252"))

    def go():
        ingest_manifests(spark, str(root), history, str(tmp_path / "checkpoint"), rejects)
        return rows(read_history(spark, history).selectExpr("Object_name", "day(valid_from)", "day(valid_to)", "object_id"))

    day("20190506", "o2,a,,2019-05-02,s,Changed,2,9", "broken")
    day("20190507", "o3,b,,2019-05-03,s,New,3,9")
    assert go() == [("a", 6, None, "o2"), ("b", 7, None, "o3")]
    day("20190504", "o1,a,,2019-05-01,s,New,1,9")  # an old day comes late
    expected = [("a", 4, 6, "o1"), ("a", 6, None, "o2"), ("b", 7, None, "o3")]
    assert go() == expected and go() == expected
    assert rows(manifest_log(spark, history).drop("source")) == [(0, 2, 2), (1, 1, 1)]
    assert [(r.line, r.record, r.batch_id) for r in read_rejects(spark, rejects).collect()] == [(3, "broken", 0)]
    day("20190504", "o9,a,,2019-05-01,s,New,1,9", name="again")  # a day is corrected by another file
    assert go()[0] == ("a", 4, 6, "o9")


def test_only_new_files_are_ingested(spark, tmp_path):  # F21
    folder = tmp_path / "raw"
    fill(folder, a__eml=eml(("text/html", "<p>A</p>")), b__eml=b"Subject: x\r\n\r\nplain")
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def ingest():
        ingest_available(source.raw_file_stream(spark, str(folder), ["eml"]), target, checkpoint, ["eml"])
        return rows(read_target(spark, target).select("files", "raw_text", "status"))

    assert ingest() == [("a.eml", "a", "ok"), ("b.eml", None, "skipped")]
    fill(folder, c__eml=eml(("text/html", "<p>C</p>")))
    assert ingest() == [("a.eml", "a", "ok"), ("b.eml", None, "skipped"), ("c.eml", "c", "ok")]
    assert ingest() == [("a.eml", "a", "ok"), ("b.eml", None, "skipped"), ("c.eml", "c", "ok")]
    batches = state.read_state(spark, target_state(target)).groupBy("batch_id").count()
    assert rows(batches) == [(0, 2), (1, 1)]


def test_stream_of_several_formats(spark, tmp_path):
    folder = fill(tmp_path / "raw", a__eml=eml(("text/html", "<p>A</p>")), b__txt=b"HEADERB c", c__pdf=b"x")
    target = str(tmp_path / "out")
    stream = source.raw_file_stream(spark, folder, ["eml", "txt"])
    ingest_available(stream, target, str(tmp_path / "checkpoint"), ["eml", "txt"])
    assert rows(read_target(spark, target).select("files", "raw_text")) == [("a.eml", "a"), ("b.txt", "b c")]


def test_newer_delivery_wins(spark, tmp_path):
    folder = tmp_path / "raw"
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for day, text, at in (("20190507", b"HEADERold", 1_000_000_000), ("20190508", b"HEADERnew", 1_000_000_100)):
        fill(folder / day, a__txt=text)
        os.utime(folder / day / "a.txt", (at, at))
        stream = source.raw_file_stream(spark, f"{folder}/*", ["txt"])
        ingest_available(stream, target, checkpoint, ["txt"])
    assert rows(read_target(spark, target).select("files", "raw_text")) == [("a.txt", "new")]


def test_stream_has_the_rows_of_a_batch(spark, tmp_path):
    folder = tmp_path / "raw"
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    fill(folder, a__txt=b"HEADERold", e__docx=b"", x__zip=b"x", big__txt=b"y" * 500)
    os.utime(folder / "a.txt", (0, 0))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        ingest_folder(spark, str(folder), target, checkpoint)
        fill(folder, f__docx=b"", b__txt=b"HEADERnew")
        os.utime(folder / "b.txt", (0, 0))  # far older than the newest file
        for _ in range(2):
            ingest_folder(spark, str(folder), target, checkpoint)
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert rows(read_target(spark, target).select("files", "raw_text", "status", "error")) == [
        ("a.txt", "old", "ok", None), ("b.txt", "new", "ok", None),
        ("big.txt", None, "error", "content not read: 500 bytes are above the limit of 100"),
        ("e.docx", None, "error", "is empty"), ("f.docx", None, "error", "is empty"), ("x.zip", None, "unsupported", None),
    ]
    assert read_target(spark, target).count() == 6


def test_stream_of_a_folder_names_no_file_to_the_driver(spark, tmp_path, monkeypatch):
    folder, target, checkpoint = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    fill(folder, **{f"a{n}__txt": b"HEADERa" for n in range(60)})
    monkeypatch.setattr(ingest, "FILES_PER_BATCH", 40)
    ingest_folder(spark, str(folder), target, checkpoint)
    fill(folder, b__txt=b"HEADERb", a1__txt=b"HEADERagain")  # a path is taken once
    ingest_folder(spark, str(folder), target, checkpoint)
    named = [line for log in (tmp_path / "checkpoint" / "sources" / "0").glob("[0-9]*") for line in log.read_text().splitlines()[1:]]
    assert len(named) == 3 and not any(".txt" in line for line in named)
    assert rows(read_target(spark, target).groupBy("raw_text").count()) == [("a", 60), ("b", 1)]
    assert rows(batch_reports(spark, target).select("batch_id", "n_files").where("batch_id = 2")) == [(2, 1)]


def test_stream_of_pages_and_of_converted_files(spark, tmp_path):
    def reader(content):
        return [(i, page.decode(), None) for i, page in enumerate(content.split(b"\f"))]

    fill(tmp_path / "raw" / "d1", a__pdf=b"One\fTwo", c__csv=b"HEADERText")
    fill(tmp_path / "raw" / "d2", a__pdf=b"", c__csv=b"")
    for file in (tmp_path / "raw" / "d1").iterdir():
        os.utime(file, (1_000_000_000, 1_000_000_000))
    out = lambda name: str(tmp_path / name)
    ingest_folder(spark, f"{tmp_path}/raw/*", out("pdf"), out("pdf-checkpoint"), page_reader=reader)
    ingest_folder(spark, f"{tmp_path}/raw/*", out("doc"), out("doc-checkpoint"), converted_doc=True)
    # both days bring the same name; the one that came last counts
    assert rows(read_target(spark, out("pdf")).select("files", "raw_text", "status")) == [("a.pdf", "", "ok")]
    assert rows(read_target(spark, out("doc")).select("files", "raw_text")) == [("c.doc", "")]
    assert rows(batch_reports(spark, out("doc")).select("batch_id", "n_files", "n_ok")) == [(-1, 1, 1), (0, 1, 1)]


def outcomes_of(spark, *rows_):
    """``files, raw_text, second of delivery`` as outcome rows."""
    values = [(f, "txt", t, "ok", None, dt.datetime(2020, 1, 1, 0, 0, at), f"/in/{f}") for f, t, at in rows_]
    return spark.createDataFrame(values, TARGET_SCHEMA.rpartition(",")[0])


def test_repeated_batch_is_not_applied_again(spark, tmp_path):
    target = str(tmp_path / "out")
    assert merge_batch(outcomes_of(spark, ("a", "old", 1), ("b", "b", 1)), 0, target, "s")
    assert merge_batch(outcomes_of(spark, ("a", "new", 2)), 1, target, "s")
    before = state.newest(spark, target)
    assert not merge_batch(outcomes_of(spark, ("a", "again", 3)), 1, target, "s")
    assert not merge_batch(outcomes_of(spark, ("c", "again", 3)), 0, target, "s")
    assert state.newest(spark, target) == before
    assert merge_batch(outcomes_of(spark, ("c", "c", 1), ("a", "late", 0)), 0, target, "another stream")
    assert rows(read_target(spark, target).select("files", "raw_text")) == [("a", "new"), ("b", "b"), ("c", "c")]


def test_reports_of_batches_equal_a_recount(spark, tmp_path):
    folder, target, checkpoint = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    fill(folder, a__txt=b"HEADERabc", b__eml=b"Subject: x\r\n\r\nplain", c__zip=b"x", d__rtf=b"{\\rtf1 }}", e__docx=b"")
    ingest_folder(spark, str(folder), target, checkpoint)
    fill(folder, f__txt=b"HEADERdef gh")
    for _ in range(2):
        ingest_folder(spark, str(folder), target, checkpoint)
    reports = batch_reports(spark, target)
    assert rows(reports.drop("version", "source")) == [(-1, 1, 0, 1, 0, 0, 0), (0, 4, 1, 1, 1, 1, 3), (1, 1, 1, 0, 0, 0, 6)]
    recount = read_target(spark, target).selectExpr("count(*)", "count_if(status = 'ok')", "count_if(status = 'error')", "sum(length(raw_text))").first()
    assert tuple(recount) == tuple(reports.selectExpr("sum(n_files)", "sum(n_ok)", "sum(n_error)", "sum(n_chars)").first())


def test_batch_that_breaks_off_leaves_no_trace_and_is_repeated(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    merge_batch(outcomes_of(spark, ("a", "a", 1)), 0, target, "s")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(session, "write_new", killed)
        with pytest.raises(KeyboardInterrupt):
            merge_batch(outcomes_of(spark, ("a", "b", 2), ("c", "c", 2)), 1, target, "s")
    assert rows(read_target(spark, target).select("files", "raw_text")) == [("a", "a")]
    assert merge_batch(outcomes_of(spark, ("a", "b", 2), ("c", "c", 2)), 1, target, "s")
    assert rows(read_target(spark, target).select("files", "raw_text")) == [("a", "b"), ("c", "c")]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    target = str(tmp_path / "out")
    first = [(f"f{i}", "x", 1) for i in range(200)]
    merge_batch(outcomes_of(spark, *first), 0, target, "s")
    one = state.newest(spark, target)["pieces"]
    assert len(one) > 40 and all(len(p) == 1 for p in one.values())
    merge_batch(outcomes_of(spark, ("f7", "y", 2), ("brand new", "z", 2)), 1, target, "s")
    two = state.newest(spark, target)["pieces"]
    changed = {b for b in two if two[b] != one.get(b)}
    assert len(changed) <= 2 and {len(two[b]) for b in changed} <= {1, 2}
    assert read_target(spark, target).where("files = 'f7'").first().raw_text == "y"
    plan = read_target(spark, target)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange", "Join", "Aggregate", "Sort"))
    for batch in range(2, 14):  # pieces are put together in time
        merge_batch(outcomes_of(spark, (f"more{batch}", "m", 1)), batch, target, "s")
    assert max(len(p) for p in state.newest(spark, target)["pieces"].values()) <= state.MOST_PIECES
    assert read_target(spark, target).count() == 213
    merge_batch(outcomes_of(spark, *[(f, "w", 3) for f, _, _ in first]), 14, target, "s")  # nothing is left of the first piece
    named = {p for of_bucket in state.newest(spark, target)["pieces"].values() for p in of_bucket}
    assert state.vacuum(spark, target_state(target), keep=1)
    assert read_target(spark, target).count() == 213 and set(session.names_in(spark, f"{target}/data")) == named


def test_merge_that_another_got_ahead_of_is_refused(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    stale = state.newest(spark, target)
    merge_batch(outcomes_of(spark, ("a", "a", 1)), 0, target, "s")
    with monkeypatch.context() as patch:
        patch.setattr(state, "newest", lambda *_: stale)
        with pytest.raises(state.Conflict):
            merge_batch(outcomes_of(spark, ("b", "b", 1)), 0, target, "other")
    assert rows(read_target(spark, target).select("files")) == [("a",)]


# session


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    path = session.scratch_path(spark, "x")
    assert folder is None or path.startswith(folder.rstrip("/"))
    assert path != session.scratch_path(spark, "x")


def test_work_files_and_databases_go_with_one_call(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "run_name", lambda _: "docpipe_test_clear")
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    tables.create_database(spark, "docpipe_test_clear_db", session.scratch_path(spark, "db"))
    session.clear_scratch(spark)
    assert not session.folder_exists(spark, path)
    assert "docpipe_test_clear_db" not in [d.name for d in spark.catalog.listDatabases()]


def test_set_values_stay(spark):
    before = spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "false")
    try:
        session.configure(spark)
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", before)
