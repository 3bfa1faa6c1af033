"""Records of CSV files cut out by many tasks, whatever the size of a file.

A quoted cell may hold line ends, so a task that begins in the middle of a file does not know where a record begins. Files are
cut into ranges of bytes, and that is settled in three steps, each a Spark job over ranges:

1. Each range is read for every line start it could be entered at, and it is noted where reading leaves it. Readings that meet at a
   boundary go on alike, so nearly all of them leave a range at one place; only others are listed.
2. Per file these notes are followed from the first byte on: where each range is really entered, and at which line. A file is as many
   short rows as it has ranges.
3. Each range is read from where it is entered; its last record may reach into the next one.

A record is cells in the manner of manifests: quoted cells may hold commas, line ends and doubled quotes. A line that breaks the rules
is a record of its own, and so is the first line of a record of more than ``MOST_RECORD_BYTES``. Encodings must keep ASCII as it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.session import snapshot
from docpipe.sources.listing import arrow_file

RANGE_BYTES = 32 * 1024 * 1024
MOST_RECORD_BYTES = 4 * 1024 * 1024
RECORDS_PER_BATCH = 20_000
# What is read at first beyond a range or for a record; more only as far as a record goes on.
READ_AHEAD = 4096
# Shorter ranges of so many bytes of a file go to one task, which opens the file once.
DEALT_BYTES = 256 * 1024

_CELL = rb'(?:"(?:[^"]++|"")*+"|[^",\r\n][^,\r\n]*+|)'
_RECORD = re.compile(rb"%s(?:,%s)*+" % (_CELL, _CELL))
_LINE = re.compile(rb"[^\r\n]*+")
_END = re.compile(rb"\r\n|\n|\r")
_QUOTE = ord('"')


class Window:
    """Bytes of a file from ``start`` on, read further as they are asked for."""

    def __init__(self, path: str, start: int, end: int, opened=None) -> None:
        self.file, self.size = opened or arrow_file(path)
        self.start = start
        self.file.seek(start)
        self.data = self.file.read(end - start + READ_AHEAD)

    def reach(self, end: int) -> None:
        """Hold the bytes up to ``end``, as far as the file has them."""
        missing = min(end, self.size) - self.start - len(self.data)
        if missing > 0:
            self.file.seek(self.start + len(self.data))
            self.data += self.file.read(missing)

    def record(self, at: int) -> tuple[int, int]:
        """Where the record that begins at a place ends, and where the next one begins."""
        here, ahead = at - self.start, READ_AHEAD
        while True:
            self.reach(at + min(ahead, MOST_RECORD_BYTES + 2))
            end = _RECORD.match(self.data, here, here + MOST_RECORD_BYTES).end()
            # a match that stops at a quote may be a cell whose closing quote is not read yet, one that stops at the last byte may go on
            seen = min(len(self.data), here + MOST_RECORD_BYTES)
            if (end < seen - 1 and self.data[end] != _QUOTE) or ahead >= MOST_RECORD_BYTES + 2 or self.start + len(self.data) >= self.size:
                break
            ahead *= 4
        if end - here >= MOST_RECORD_BYTES or (end < len(self.data) and self.data[end] not in b"\r\n"):
            while True:  # a line, however long
                end = _LINE.match(self.data, here).end()
                if end < len(self.data) - 1 or self.start + len(self.data) >= self.size:
                    break
                self.reach(self.start + 2 * len(self.data) + 1024)
        after = _END.match(self.data, end)
        return self.start + end, self.start + (after.end() if after else end)


def _line_starts(window: Window, start: int, end: int) -> list[int]:
    """Places in a range where a line begins; ``window`` holds the byte before the range too."""
    window.reach(end + 1)
    found = (window.start + m.end() for m in _END.finditer(window.data, 0, end - window.start + 1))
    starts = [at for at in found if start <= at < end]
    return [0, *starts] if start == 0 else starts


def _opened() -> Callable[[str], tuple]:
    """Opens files, and keeps the last one for ranges that follow."""
    last: dict[str, tuple] = {}

    def open_(path: str) -> tuple:
        if path not in last:
            last.clear()
            last[path] = arrow_file(path)
        return last[path]

    return open_


def surveyed(path: str, start: int, end: int, opened=None) -> tuple[int, int, list[tuple[int, int]]]:
    """Line ends in a range, the place where most readings leave it, and the entries that lead to others."""
    window = Window(path, max(0, start - 1), end, opened)
    starts = _line_starts(window, start, end)
    leaves: dict[int, int] = {}
    for entry in starts:
        way, at = [], entry
        while at < end and at not in leaves:
            way.append(at)
            after = window.record(at)[1]
            at = after if after > at else end
        exit_ = leaves.get(at, at)
        leaves.update(dict.fromkeys(way, exit_))
    usual = leaves[starts[-1]] if starts else -1
    starts_here = set(starts)
    odd = [(entry, exit_) for entry, exit_ in leaves.items() if exit_ != usual and entry in starts_here]
    return len(starts) - (start == 0), usual, odd


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_ = _opened()
    for batch in batches:
        rows = [surveyed(p, a, b, open_(p)) for p, a, b in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")))]
        lines, usual, odd = zip(*rows) if rows else ([], [], [])
        pairs = pa.list_(pa.struct([("entry", pa.int64()), ("leave", pa.int64())]))
        odd = pa.array([[{"entry": e, "leave": x} for e, x in o] for o in odd], pairs)
        columns = [batch.column(c) for c in ("path", "start", "end")]
        yield pa.record_batch([*columns, pa.array(lines, pa.int64()), pa.array(usual, pa.int64()), odd], names=["path", "start", "end", "lines", "usual", "odd"])


def _follow(ranges: pd.DataFrame) -> pd.DataFrame:
    """Where each range of one file is entered, and how many lines begin before the range."""
    out, at, lines = [], 0, 0
    for r in ranges.sort_values("start").itertuples():
        out.append((r.path, r.start, r.end, at, lines))
        if at < r.end:
            at = dict((o["entry"], o["leave"]) for o in r.odd).get(at, r.usual)
        lines += r.lines
    return pd.DataFrame(out, columns=["path", "start", "end", "entry", "lines"])


def cut_out(path: str, start: int, end: int, entry: int, lines: int, opened=None) -> Iterator[tuple[int, int, bytes]]:
    """``place, line, record`` of the records that begin in a range; empty lines are none."""
    if entry >= end:
        return
    window = Window(path, max(0, start - 1), end, opened)
    line, at = 1 + lines + sum(0 < p <= entry for p in _line_starts(window, start, end)), entry
    while at < end:
        stop, after = window.record(at)
        if stop > at:
            yield at, line, window.data[at - window.start:stop - window.start]
        line += len(_END.findall(window.data[at - window.start:after - window.start]))
        at = max(after, at + 1)


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"path": pa.string(), "at": pa.int64(), "line": pa.int64(), "record": pa.binary()}

    def handed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))

    open_ = _opened()
    for batch in batches:
        held, size = [], 0
        for r in batch.to_pylist():
            for found in cut_out(r["path"], r["start"], r["end"], r["entry"], r["lines"], open_(r["path"])):
                held.append((r["path"], *found))
                size += len(found[2])
                if len(held) == RECORDS_PER_BATCH or size >= MOST_RECORD_BYTES:
                    yield handed(held)
                    held, size = [], 0
        if held:
            yield handed(held)


def records(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, at, line, record`` of every record of the files (``path, length``): its place, its line, its bytes."""
    ends = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = files.where("length > 0").select("path", "length", F.explode(ends).alias("start")).select(
        "path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("end")
    )
    tasks = max(8, 4 * files.sparkSession.sparkContext.defaultParallelism)
    dealt = F.floor(F.col("start") / max(range_bytes, DEALT_BYTES))
    ranges = ranges.repartition(tasks, F.col("path"), dealt)
    notes = ranges.mapInArrow(_survey, "path string, start long, end long, lines long, usual long, odd array<struct<entry:long,leave:long>>")
    entered = snapshot(notes.groupBy("path").applyInPandas(_follow, "path string, start long, end long, entry long, lines long"), "ranges")
    return entered.repartition(tasks, F.col("path"), dealt).mapInArrow(_cutter, "path string, at long, line long, record binary")
