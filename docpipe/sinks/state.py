"""Tables that are kept up to date: rows in hash buckets of their key, and a commit file per merge.

A commit names, for each bucket, the folders that hold its rows. A merge writes the new rows once. Buckets where
every key has one row then only get one folder more; buckets where a key comes again, or that are in too many pieces, are reduced and
rewritten, and no others. The commit file appears by one rename, so a merge that was broken off leaves files that nothing names, and readers see the state
before it or after it. A batch that was committed is not applied again.

Reading is a plain scan of the folders that the newest commit names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docpipe import session

# A bucket in more pieces than this is put together by the merge that touches it.
MOST_PIECES = 8


@dataclass(frozen=True)
class State:
    """Where a state lies, the column that deals its rows to buckets, and its columns.

    ``reduce`` makes the rows of some keys, old and new ones, those to keep; all rows of a key are given to it together. It must
    leave a key's only row as it is, for such rows are not given to it.
    The number of buckets is fixed by the first commit. A bucket's rows should be a few files' worth.
    """

    path: str
    key: str
    schema: str
    reduce: Callable[[DataFrame], DataFrame]
    buckets: int = 64


class Conflict(RuntimeError):
    """Another merge was committed first."""


def newest(spark: SparkSession, path: str) -> dict:
    """The newest commit: ``version``, ``buckets``, ``pieces`` of each bucket, and the last batch of each source."""
    versions = [int(n.removesuffix(".json")) for n in session.names_in(spark, f"{path}/commits") if n.endswith(".json")]
    if not versions:
        return {"version": -1, "buckets": None, "pieces": {}, "applied": {}}
    return json.loads(session.read_text(spark, _commit_file(path, max(versions))))


def _commit_file(path: str, version: int) -> str:
    return f"{path}/commits/{version:020d}.json"


def _rows(spark: SparkSession, state: State, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], state.schema)
    return spark.read.schema(state.schema).parquet(*folders)


def _folders(state: State, pieces: dict[str, list[str]], buckets: list[str] | None = None) -> list[str]:
    chosen = pieces if buckets is None else {b: pieces.get(b, []) for b in buckets}
    return [f"{state.path}/data/{piece}/bucket={b}" for b, of_bucket in chosen.items() for piece in of_bucket]


def read_state(spark: SparkSession, state: State) -> DataFrame:
    """All rows as of the newest commit."""
    return _rows(spark, state, _folders(state, newest(spark, state.path)["pieces"]))


def exists(spark: SparkSession, state: State) -> bool:
    return newest(spark, state.path)["version"] >= 0


def merge(
    rows: DataFrame, state: State, source: str | None = None, batch: int | None = None, measures: dict[str, str] | None = None
) -> bool:
    """Bring rows into the state; false if this batch of the source was committed before.

    ``measures`` are aggregates of the rows in SQL, taken while they are written and kept in the commit, see ``reports``.
    Only names of buckets come to the driver. Two merges at once end in ``Conflict`` for one of them, which may be repeated.
    """
    spark = rows.sparkSession
    before = newest(spark, state.path)
    if source is not None and batch is not None and batch <= before["applied"].get(source, -1):
        return False
    n = before["buckets"] or state.buckets
    piece = f"{before['version'] + 1:010d}-{uuid.uuid4().hex}"
    rows = rows.select(*[c.name for c in spark.createDataFrame([], state.schema).schema])
    seen = Observation()
    if measures:
        rows = rows.observe(seen, *[F.expr(m).alias(name) for name, m in measures.items()])
    _write(rows, state, n, piece)
    touched = session.names_in(spark, f"{state.path}/data/{piece}")
    touched = sorted(name.removeprefix("bucket=") for name in touched if name.startswith("bucket="))
    pieces = dict(before["pieces"])
    for b in touched:
        pieces[b] = pieces.get(b, []) + [piece]
    again = _clashing(spark, state, pieces, touched, n) | {b for b in touched if len(pieces[b]) > MOST_PIECES}
    if again:
        together = f"{piece}-merged"
        _write(state.reduce(_rows(spark, state, _folders(state, pieces, sorted(again)))), state, n, together)
        pieces.update({b: [together] for b in again})
    applied = dict(before["applied"])
    if source is not None and batch is not None:
        applied[source] = batch
    after = {
        "version": before["version"] + 1, "buckets": n, "pieces": pieces, "applied": applied, "source": source, "batch": batch,
        "measures": {name: int(value or 0) for name, value in seen.get.items()} if measures else {},
    }
    if not session.write_new(spark, _commit_file(state.path, after["version"]), json.dumps(after)):
        raise Conflict(f"version {after['version']} of {state.path} was committed by another merge")
    return True


def reports(spark: SparkSession, path: str) -> DataFrame:
    """``version, source, batch, measures`` of every merge. A batch that was repeated is in it once."""
    rows = spark.read.schema("version bigint, source string, batch bigint, measures map<string,bigint>").option("multiLine", True)
    return rows.json(f"{path}/commits/*.json")


def _bucket(state: State, n: int):
    return F.pmod(F.xxhash64(F.col(state.key)), F.lit(n)).cast("int")


def _write(rows: DataFrame, state: State, n: int, piece: str) -> None:
    # a bucket goes to one task, or to several if it is large
    dealt = rows.withColumn("bucket", _bucket(state, n)).hint("rebalance", "bucket")
    dealt.write.partitionBy("bucket").parquet(f"{state.path}/data/{piece}")


def _clashing(spark: SparkSession, state: State, pieces: dict[str, list[str]], touched: list[str], n: int) -> set[str]:
    """The buckets where a key is in more than one row; only the key column is read."""
    keys = _rows(spark, state, _folders(state, pieces, touched)).select(F.col(state.key).alias("key"))
    repeated = keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    bucket = F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    return {str(r.bucket) for r in repeated.select(bucket.alias("bucket")).distinct().collect()}  # at most one row per bucket


def vacuum(spark: SparkSession, state: State, keep: int = 3) -> list[str]:
    """Remove the folders that none of the last ``keep`` commits names; returns what was removed.

    Commits stay, they are small and hold the reports. Run it when no merge runs and no reader is at an older state.
    """
    versions = sorted(n for n in session.names_in(spark, f"{state.path}/commits") if n.endswith(".json"))
    named = {
        piece for v in versions[-keep:]
        for of_bucket in json.loads(session.read_text(spark, f"{state.path}/commits/{v}"))["pieces"].values() for piece in of_bucket
    }
    gone = [f"{state.path}/data/{p}" for p in session.names_in(spark, f"{state.path}/data") if p not in named]
    for path in gone:
        session.remove(spark, path)
    return gone
