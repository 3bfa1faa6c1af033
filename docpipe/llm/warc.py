"""WARC archives: writing whole-file gzip streams, and making them seekable.

Crawlers often leave archives as one gzip stream, which can only be read from its start. The
normaliser inflates such a stream once, writes every record again as a gzip member of its own,
and a sidecar index of where each member lies; a reader can then fetch any record alone.

All steps work on streams: a record's payload passes in pieces. Files are written to and read
from any file system that Arrow knows by URI, under names of their own for each attempt of a
task; only the files named in the manifest of the attempt that counted are read.

Defined cases: columns other than page_id, url and html are not read, whatever their names. Null html is an empty payload. Of records with equal payloads that with the smallest page_id is
the response and the others are revisits of it (rows that share this page_id are all responses;
if no row of the group has an id, all are). An empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe import session
from docpipe.llm.common import written

PIECE = 1 << 20
ARCHIVE_BYTES = 64 << 20  # bytes of records, headers included, after which a task begins another archive
LEVEL = 3
BROADCAST_ROWS = 20_000  # of two short columns: under 2 MB
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Header:
    fields: dict[str, str]

    @property
    def length(self) -> int:
        return int(self.fields["Content-Length"])

    def raw(self) -> bytes:
        lines = "".join(f"{k}: {v}\r\n" for k, v in self.fields.items())
        return f"WARC/1.1\r\n{lines}\r\n".encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> tuple[Header, bytes]:
    """The header and block of a response or revisit. A line break in a url is percent-encoded."""
    target = (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A")
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{digest}",
        # length of the full payload, which a revisit does not hold
        "X-Payload-Length": str(len(payload)),
    }
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>", "Content-Length": "0"}
        return Header(fields), b""
    fields |= {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}
    return Header(fields), payload


class Inflated(io.RawIOBase):
    """The bytes of a gzip file of one or more members, as a stream."""

    def __init__(self, source) -> None:
        self.source = source
        self.engine = zlib.decompressobj(31)
        self.ready = b""
        self.begun = False

    def _more(self) -> bool:
        while not self.ready:
            raw = self.engine.unconsumed_tail or self.engine.unused_data
            if self.engine.eof and raw:
                self.engine, self.begun = zlib.decompressobj(31), False
            raw = raw or self.source.read(PIECE)
            if not raw:
                if self.begun and not self.engine.eof:
                    raise EOFError("the gzip stream ends within a member")
                return False
            if self.engine.eof:
                self.engine, self.begun = zlib.decompressobj(31), False
            self.begun = True
            self.ready = self.engine.decompress(raw, PIECE)
        return True

    def take(self, n: int) -> bytes:
        """Up to ``n`` bytes; fewer only if a piece ends, none only at the end."""
        if not self.ready and not self._more():
            return b""
        out, self.ready = self.ready[:n], self.ready[n:]
        return out

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with ``mark``; what is left at the end of the stream otherwise."""
        held = bytearray()
        while True:
            if not self.ready and not self._more():
                return bytes(held)
            start = max(0, len(held) - len(mark) + 1)
            before = len(held)
            held += self.ready
            at = held.find(mark, start)
            if at >= 0:
                used = at + len(mark) - before
                self.ready = self.ready[used:]
                return bytes(held[: at + len(mark)])
            self.ready = b""


def records(stream: Inflated) -> Iterator[tuple[Header, Iterator[bytes]]]:
    """Headers with their blocks in pieces. A block that was not read is skipped."""
    while True:
        head = stream.until(b"\r\n\r\n")
        if not head.strip():
            return
        first, *lines = head.decode().strip("\r\n").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at {first[:40]!r}")
        header = Header(dict(line.split(": ", 1) for line in lines))
        left = header.length

        def block() -> Iterator[bytes]:
            nonlocal left
            while left:
                piece = stream.take(min(left, PIECE))
                if not piece:
                    raise EOFError("a record's block is cut short")
                left -= len(piece)
                yield piece

        yield header, block()
        for _ in block():
            pass
        stream.until(b"\r\n\r\n")


def normalise(source, archive, index) -> int:
    """One inflation of ``source``; every record a member of ``archive``, a JSON line in ``index``."""
    offset = n = 0
    for header, block in records(Inflated(source)):
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        length = archive.write(packer.compress(header.raw()))
        for piece in block:
            length += archive.write(packer.compress(piece))
        length += archive.write(packer.compress(b"\r\n\r\n") + packer.flush())
        line = {"id": header.fields["WARC-Record-ID"], "offset": offset, "length": length}
        index.write(json.dumps(line).encode() + b"\n")
        offset += length
        n += 1
    return n


def _attempt_name(kind: str, n: int) -> str:
    context = TaskContext.get()
    part, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, 0)
    return f"{kind}-{part:05d}-{attempt}-{n}"


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _opened(folder)
        names, out, packer, size = [], None, None, 0

        def closed() -> None:
            out.write(packer.flush())
            out.close()

        for batch in batches:
            for page_id, url, html, revisit, first in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    names.append(f"{_attempt_name('crawl', len(names))}.warc.gz")
                    out, packer, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), 0
                payload = (html or "").encode()
                header, block = record(page_id, url, payload, digest_of(payload), first, revisit)
                whole = header.raw() + block + b"\r\n\r\n"
                out.write(packer.compress(whole))
                size += len(whole)
                if size >= ARCHIVE_BYTES:
                    closed()
                    out = None
        if out is not None:
            closed()
        yield pa.record_batch([pa.array(names, pa.string())], names=["archive"])

    return write


def _normaliser(source_folder: str, folder: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from_fs, from_root = _opened(source_folder)
        fs, root = _opened(folder)
        for frame in frames:
            for name in frame["archive"]:
                new = f"{_attempt_name('seekable', 0)}-{name}"
                with from_fs.open_input_stream(f"{from_root}/{name}", compression=None) as source, \
                        fs.open_output_stream(f"{root}/{new}", compression=None) as archive, \
                        fs.open_output_stream(f"{root}/{new}.index", compression=None) as index:
                    n = normalise(source, archive, index)
                yield pd.DataFrame({"archive": [new], "n_records": [n]})

    return run


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_member(file, offset: int, length: int) -> tuple[Header, bytes]:
    """One record by its place in the index."""
    file.seek(offset)
    header, block = next(records(Inflated(io.BytesIO(file.read(length)))))
    return header, b"".join(block)


def _reader(folder: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _opened(folder)
        for frame in frames:
            for name in frame["archive"]:
                rows = []
                with fs.open_input_stream(f"{root}/{name}.index", compression=None) as lines, fs.open_input_file(f"{root}/{name}") as file:
                    for line in io.BufferedReader(io.BytesIO(lines.read())):
                        place = json.loads(line)
                        header, payload = read_member(file, place["offset"], place["length"])
                        f = header.fields
                        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = f["WARC-Type"] == "revisit"
                        if not revisit and (digest_of(payload) != digest or len(payload) != int(f["X-Payload-Length"])):
                            raise ValueError(f"{name}: the payload of {place['id']} is not what was written")
                        rows.append((
                            _page(place["id"]), int(f["X-Payload-Length"]), digest, f["WARC-Type"],
                            _page(f["WARC-Refers-To"]) if revisit else None, name, place["offset"], place["length"],
                        ))
                        if len(rows) == 10_000:
                            yield _frame(rows)
                            rows = []
                if rows:
                    yield _frame(rows)

    return run


ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in ROWS.split(", ")])
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def _spread(names: DataFrame) -> DataFrame:
    """One archive per task: the names are few, the work behind each is not."""
    return names.repartitionByRange(max(1, names.count()), "archive")


def deduplicated(pages: DataFrame) -> DataFrame:
    """Pages with ``revisit`` and ``first``, the page_id that a revisit refers to.

    Digests that occur once need no partner, so only the others are joined, by broadcast while
    they are few. Adaptive execution splits a payload that many pages share.
    """
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", digest.alias("digest"))
    firsts = written(
        rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
        .select("digest", "first"), "warc-firsts",
    )
    if firsts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    revisit = F.col("first").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    return rows.join(firsts, "digest", "left").select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("first"))


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages, normalise the archives, and read every record back by its index entry."""
    spark = pages.sparkSession
    crawl, seekable = (session.scratch_path(spark, name) for name in ("warc-crawl", "warc-seekable"))
    for folder in (crawl, seekable):
        fs, root = _opened(folder)
        fs.create_dir(root, recursive=True)
    names = written(deduplicated(pages).mapInArrow(_writer(crawl), "archive string"), "warc-written")
    done = written(
        _spread(names).mapInPandas(_normaliser(crawl, seekable), "archive string, n_records long"), "warc-manifest"
    )
    return _spread(done.select("archive")).mapInPandas(_reader(seekable), ROWS)
