"""Folders listed by Spark tasks, over Arrow's file systems.

A folder may be a glob, as for Spark's readers. Its parts are followed level by level: each level is a table of
directories that tasks list, a directory per row, and the names that match are the next level. So names of files and of directories stay
in the tasks; the driver only knows the pattern. Unlike Spark's file sources a listing has files of zero length. A local folder, or one
that is mounted, is read name by name, so the number of its files is no matter; other stores hand over a folder at a time.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

LISTED = "path string, modificationTime timestamp, length long"
NAMES_PER_BATCH = 50_000
_SPECIAL = re.compile(r"[*?\[{\\]")


def glob_regex(pattern: str) -> str:
    """A regular expression for one part of a Hadoop glob: ``* ? [a-c] [^a] {x,y}`` and escapes."""
    out, depth, at = [], 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            at += 1
            out.append(re.escape(pattern[at]))
        elif c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and "]" in pattern[at + 2:]:
            end = pattern.index("]", at + 2)
            inner = pattern[at + 1:end]
            negated, inner = (True, inner[1:]) if inner[0] in "^!" else (False, inner)
            out.append(f"[{'^' if negated else ''}{inner.replace(chr(92), chr(92) * 2).replace('[', chr(92) + '[')}]")
            at = end
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
        at += 1
    return "".join(out)


def _parts(folder: str) -> tuple[str, list[str]]:
    """The leading directory without special characters, and the parts of the pattern below it."""
    scheme, colon, rest = folder.partition("://")
    if not colon or scheme == "file":
        scheme, colon, rest = "", "", rest or folder.removeprefix("file:")
        if not rest.startswith("/"):
            raise ValueError(f"not an absolute path: {folder}")
    pieces = rest.rstrip("/").split("/")
    special = next((i for i, p in enumerate(pieces) if _SPECIAL.search(p)), len(pieces))
    fixed = "/".join(pieces[:special]) or "/"
    return (f"{scheme}://{fixed}" if colon else fixed), pieces[special:]


def _store(root: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a directory, and its path there."""
    return pafs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))


def _prefix(folder: str) -> str:
    """What Spark's readers write before the path that an Arrow file system gives."""
    scheme, colon, rest = folder.partition("://")
    if not colon or scheme == "file":
        return "file:"
    if scheme in ("hdfs", "viewfs"):  # Arrow's paths are without the name of the service
        return f"{scheme}://{rest.split('/', 1)[0]}"
    return f"{scheme}://"


def _hidden(name: str) -> bool:
    """What Spark's file sources leave out."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


def _found(files: pafs.FileSystem, directory: str, kind: pafs.FileType, wanted: Callable[[str], bool]) -> Iterator[tuple[str, int | None, int]]:
    """``path, time, length`` of the files, or of the directories, in a directory."""
    if not isinstance(files, pafs.LocalFileSystem):
        for i in files.get_file_info(pafs.FileSelector(directory)):
            if i.type == kind and wanted(i.base_name):
                yield i.path, i.mtime_ns, i.size
        return
    with os.scandir(directory) as entries:
        for e in entries:
            if wanted(e.name) and (e.is_file() if kind == pafs.FileType.File else e.is_dir()):
                try:
                    stat = e.stat()
                except FileNotFoundError:  # gone meanwhile
                    continue
                yield e.path, stat.st_mtime_ns, stat.st_size


def _lister(root: str, kind: pafs.FileType, regex: str, named: bool):
    pattern = re.compile(regex)
    prefix = _prefix(root)

    def wanted(name: str) -> bool:
        return not (named and _hidden(name)) and pattern.fullmatch(name) is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _store(root)[0]
        for batch in batches:
            for directory in batch.column(0).to_pylist():
                found = _found(files, directory, kind, wanted)
                while part := list(islice(found, NAMES_PER_BATCH)):
                    paths, times, lengths = zip(*part)
                    columns = {"path": pa.array([prefix + p for p in paths] if named else paths, pa.string())}
                    if named:
                        # Hadoop keeps milliseconds
                        times = [None if t is None else t // 1_000_000 * 1000 for t in times]
                        columns["modificationTime"] = pa.array(times, pa.timestamp("us", "UTC"))
                        columns["length"] = pa.array(lengths, pa.int64())
                    yield pa.record_batch(columns)

    return run


def _each_alone(directories: DataFrame) -> DataFrame:
    """Directories dealt to the tasks; listing waits for the store more than it computes."""
    return directories.repartition(max(8, 4 * directories.sparkSession.sparkContext.defaultParallelism), "path")


def listed(spark: SparkSession, folder: str, exts: Iterable[str] | None = None) -> DataFrame:
    """``path, modificationTime, length`` of every file in a folder or in the folders of a glob.

    Not recursive. Names of files that begin with ``.``, or with ``_`` and have no ``=``, are left out, as Spark does. With ``exts`` a name
    must end in one of them, case-sensitive. A folder without special characters must exist.
    """
    root, below = _parts(folder)
    names = ".*" if exts is None else rf".*\.(?:{'|'.join(map(re.escape, exts))})"
    if not below:
        return _top(spark, root).mapInArrow(_lister(root, pafs.FileType.File, f"(?s){names}", True), LISTED)
    # what the last part matches may be a folder or a file
    parents, last = _parents(spark, root, below), glob_regex(below[-1])
    files = parents.mapInArrow(_lister(root, pafs.FileType.File, rf"(?s)(?=(?:{last})\Z){names}", True), LISTED)
    folders = parents.mapInArrow(_lister(root, pafs.FileType.Directory, f"(?s){last}", False), "path string")
    return _each_alone(folders).mapInArrow(_lister(root, pafs.FileType.File, f"(?s){names}", True), LISTED).union(files)


def _top(spark: SparkSession, root: str) -> DataFrame:
    return spark.createDataFrame([(_store(root)[1],)], "path string")


def _parents(spark: SparkSession, root: str, below: list[str]) -> DataFrame:
    """The directories in which the last part of a pattern is looked for."""
    directories = _top(spark, root)
    for part in below[:-1]:
        directories = _each_alone(directories).mapInArrow(_lister(root, pafs.FileType.Directory, f"(?s){glob_regex(part)}", False), "path string")
    return _each_alone(directories)


def has_root(folder: str) -> bool:
    """Whether a folder is there, of a glob the directory above its first special character."""
    files, place = _store(_parts(folder)[0])
    return files.get_file_info(place).type != pafs.FileType.NotFound


def has_match(spark: SparkSession, folder: str) -> bool:
    """Whether a folder whose root is there matches anything, if only an empty directory; tasks look."""
    root, below = _parts(folder)
    if not below:
        return True
    parents, last = _parents(spark, root, below), f"(?s){glob_regex(below[-1])}"
    kinds = [parents.mapInArrow(_lister(root, kind, last, False), "path string") for kind in (pafs.FileType.Directory, pafs.FileType.File)]
    return not kinds[0].union(kinds[1]).isEmpty()


def file_opener(folder: str) -> Callable[[str], pa.NativeFile]:
    """Opens the files that a listing of the folder names, whatever is in their names, over one connection to its store."""
    root = _parts(folder)[0]
    files, prefix = _store(root)[0], _prefix(root)
    return lambda path: files.open_input_file(path.removeprefix(prefix))


def arrow_file(path: str):
    """A file, as a listing names it, opened for reading at any place; and its length."""
    plain = path.removeprefix("file:") if path.startswith("file:") else path
    files, where = _store(plain)
    opened = files.open_input_file(where)
    return opened, opened.size()
