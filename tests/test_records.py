"""Records cut out of ranges against one reading of the whole file."""

import random
import re

import pytest

from docpipe.sources import manifests, records as rc

WHOLE = re.compile(manifests._RECORDS.replace(r"\G", "").replace(r"\z", r"\Z").encode())
HEADER = b"Object_name,Prior_Version_Object_Name,Document_date,Business_segment,new/changed,claim_id,cedent_id"


def whole(data):
    """``place, line, record`` by the rule for files that are read as one value."""
    out, at = [], 0
    while at < len(data):
        m = WHOLE.match(data, at)
        if m.group(1):
            out.append((at, 1 + len(re.findall(rb"\r\n|\n|\r", data[:at])), m.group(1)))
        at = max(m.end(), at + 1)
    return out


def in_ranges(path, size, step):
    ranges = [(a, min(a + step, size)) for a in range(0, size, step)]
    notes = [(a, b, *rc.surveyed(path, a, b)) for a, b in ranges]
    at, lines, out = 0, 0, []
    for a, b, n, usual, odd in notes:
        out += rc.cut_out(path, a, b, at, lines)
        if at < b:
            at = dict(odd).get(at, usual)
        lines += n
    return out


def texts():
    random.seed(9)
    yield from (b"", b"\n", b"a", b"a\r\nb", b'"a\nb",c\nd', b'"a""\n,\n"b"', b'"open\nx\ny,"z"\n', b'a,"b"c\nd', b"\r\r\n\n", b'x,"\r\n\r\n",y\r\nz')
    for _ in range(150):
        yield "".join(random.choices('ab,"\r\n', weights=[3, 2, 3, 4, 1, 2], k=random.randint(1, 60))).encode()


@pytest.mark.parametrize("longest", [None, 12])
def test_every_split_gives_the_same_records(tmp_path, monkeypatch, longest):
    if longest:
        monkeypatch.setattr(rc, "MOST_RECORD_BYTES", longest)
    path = tmp_path / "f.csv"
    for data in texts():
        path.write_bytes(data)
        expected = in_ranges(f"file:{path}", len(data), max(1, len(data)))
        assert longest or expected == whole(data), data
        for step in {1, 2, 3, 5, 7, 13, 31}:
            assert in_ranges(f"file:{path}", len(data), step) == expected, (data, step)


def test_manifests_in_ranges(spark, tmp_path):
    odd = b'1,,2019-05-01,"seg\r\nment, ""x""",New,c,\x80\r\n\r\n2,broken\r\n"3,,,,,,\r\n4,,no date,s,New,c,d\n' + b"5,,,s,New,c,d\n" * 300
    days = {"20190506": HEADER + b"\n" + odd, "20190507": b"\r\n" + HEADER + b"\n6,,,,,,", "20190508": b"", "20190509": b"x,y\n1,2\n"}
    for day, data in days.items():
        folder = tmp_path / day / "Metadata"
        folder.mkdir(parents=True)
        (folder / f"{day}.csv").write_bytes(data)
    plain = manifests.read_backlog(spark, str(tmp_path))
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    expected = rows(plain.rows), rows(plain.rejects)
    assert len(expected[0]) == 302 and {r[1] for r in expected[1]} == {5, 6, 7, None}
    for size in (7, 100, 1 << 20):
        got = manifests.read_backlog(spark, str(tmp_path), range_bytes=size)
        assert rows(got.rows) == expected[0]
        assert [r for r in rows(got.rejects) if "20190508" not in r[0]] == expected[1]  # an empty file is no value


def test_a_range_reads_little_more_than_itself(tmp_path, monkeypatch):
    line = b'"a, b",,2019-05-01,"x ""y""\r\nz",New,1,9\r\n'
    path = tmp_path / "m.csv"
    path.write_bytes(line * 20_000)
    taken, plain = [], rc.arrow_file

    class Counted:
        def __init__(self, file):
            self.file = file

        def seek(self, at):
            self.file.seek(at)

        def read(self, n):
            taken.append(n)
            return self.file.read(n)

    monkeypatch.setattr(rc, "arrow_file", lambda p: (Counted(plain(p)[0]), plain(p)[1]))
    size = len(line) * 1000
    rc.surveyed(str(path), size, size + 512)
    assert len(list(rc.cut_out(str(path), size, size + 512, size, 2000))) == -(-512 // len(line))
    assert sum(taken) < 100_000


def test_a_record_longer_than_what_is_read_at_first(tmp_path):
    cell = b'"' + b'x ""\r\n' * 10_000 + b'"'
    path = tmp_path / "m.csv"
    path.write_bytes(b"h,i\r\n" + cell + b",1\r\nlast," + b"y" * 30_000 + b"\r\n" + b'z,"open\r\n')
    found = [record for _, _, record in rc.cut_out(str(path), 0, path.stat().st_size, 0, 0)]
    assert found == [b"h,i", cell + b",1", b"last," + b"y" * 30_000, b'z,"open']


def test_the_text_of_a_manifest_is_cut_once(spark, tmp_path):
    day = tmp_path / "20190506" / "Metadata"
    day.mkdir(parents=True)
    (day / "20190506.csv").write_bytes(",".join(manifests.MANIFEST_COLUMNS).encode() + b"\r\na,,2019-05-01,seg,New,1,9\r\n")
    plan = manifests.read_backlog(spark, str(tmp_path)).rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(regexp_replace(") <= 2  # files below the size limit, and those above
    assert plan.count("regexp_extract_all(concat(,, record") <= 2
