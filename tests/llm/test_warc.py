"""Archives: exact round trips, one member per record, and true offsets."""

import gzip
import io
import json

import pytest

from docpipe.llm import warc


def brute(rows):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        ids = [i for i in groups[html or ""] if i is not None]
        first = min(ids) if ids else None
        revisit = first is not None and page_id != first
        out.append((page_id, len(payload), warc.digest_of(payload), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (3, "http://a/\r\nX: y", "<p>é\r\n\r\nWARC/1.1\r\n</p>"), (1, None, "same"), (2, "u", "same"), (4, "u", None), (5, "u", ""), (6, "u", "x" * 3_000_000),
    (None, "n", "same"), (None, "n", "alone"), (None, "n", "alone"), (1, "u", "same"), (9, "u", "\x00\n"),
]


@pytest.mark.parametrize("few", [20_000, 0])
def test_pages_come_back_as_they_went(spark, few, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", few)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    pages = spark.createDataFrame([(*r, 1) for r in ROWS], "page_id long, url string, html string, digest int").repartition(3)
    out = warc.archived(pages)
    got = out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)
    assert out.select("archive").distinct().count() > 3
    assert warc.archived(pages.limit(0)).count() == 0


def monolith(rows, members=1):
    parts = [h.raw() + b + b"\r\n\r\n" for h, b in (warc.record(i, u, (t or "").encode(), warc.digest_of((t or "").encode()), None, False) for i, u, t in rows)]
    step = -(-len(parts) // members)
    return b"".join(gzip.compress(b"".join(parts[i:i + step])) for i in range(0, len(parts), step))


@pytest.mark.parametrize("members", [1, 3])
@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_normaliser_gives_each_record_its_member_and_offset(members, piece, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", piece)
    rows = [r for r in ROWS if len(r[2] or "") < 1000]
    archive, index = io.BytesIO(), io.BytesIO()
    assert warc.normalise(io.BytesIO(monolith(rows, members)), archive, index) == len(rows)
    places = [json.loads(line) for line in index.getvalue().splitlines()]
    for (page_id, _, html), place in zip(rows, places):
        raw = archive.getvalue()[place["offset"]:place["offset"] + place["length"]]
        assert gzip.decompress(raw).endswith((html or "").encode() + b"\r\n\r\n")
        header, payload = warc.read_member(io.BytesIO(archive.getvalue()), place["offset"], place["length"])
        assert payload == (html or "").encode() and warc._page(header.fields["WARC-Record-ID"]) == page_id
    assert gzip.decompress(archive.getvalue()) == gzip.decompress(monolith(rows, members))


def test_cut_streams_are_errors():
    whole = monolith(ROWS[:1])
    with pytest.raises((EOFError, ValueError)):
        warc.normalise(io.BytesIO(whole[:-30]), io.BytesIO(), io.BytesIO())
