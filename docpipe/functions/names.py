"""File names and date stamps as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_STAMP = "yyyyMMdd"
RUN_STAMP = "yyyy_MM_dd"


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """Last suffix with its dot; '' when there is none (leading dots do not count)."""
    return F.regexp_extract(name, r"^\.*[^.].*?(\.[^.]*)$", 1)


def title_case(ext: Column) -> Column:
    return F.initcap(ext)


def replace_suffix(name: Column, old: str, new: str = "") -> Column:
    """Swap a trailing suffix; other places in the name are left alone."""
    return F.regexp_replace(name, re.escape(old) + "$", new)


def stem(name: Column) -> Column:
    """Name without its extension."""
    return F.substring(name, F.lit(1), F.length(name) - F.length(extension(name)))


def listed_type(ext: Column) -> Column:
    """True for extensions of three to five characters, dot included."""
    return F.length(ext).between(3, 5)
