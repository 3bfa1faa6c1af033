"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps what was measured and one long of
failure bits, so a new policy, or the question what a rule alone rejects, needs neither the
text nor the rules again: both are bit operations on the ledger.

Defined cases: null text counts as empty. Rows are never merged: repeated documents each get their row, an
empty table an empty ledger. Very long texts are measured whole, their repeated windows in arrays. Any further columns, whatever their
names, travel in a struct.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = UPPER + UPPER.lower()
DIGITS = b"0123456789"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_digits",
)

# Bit number, name, and when a document fails. Bits are never given to another rule.
RULES = (
    (0, "few_words", "m.n_words < 50"),
    (1, "repeated_words", "100 * m.n_repeat_words > 50 * m.n_words"),
    (2, "symbols", "100 * m.n_symbols > 50 * m.n_words"),
    (3, "repeated_lines", "100 * m.n_dup_lines > 50 * m.n_lines"),
    (4, "short_words", "m.word_chars < 2 * m.n_words"),
    (5, "long_words", "m.word_chars > 25 * m.n_words"),
    (6, "capitals", "m.n_letters >= 100 AND 100 * m.n_upper > 60 * m.n_letters"),
    (7, "digits", "100 * m.n_digits > 40 * m.word_chars"),
)
BASE = 0b11


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject under it."""

    version: str
    mask: int

    def rejects(self, bits: Column) -> Column:
        return bits.bitwiseAND(F.lit(self.mask)) != 0


POLICIES = {p.version: p for p in (
    Policy("base", BASE),
    Policy("2024-1", BASE | 0b1100),
    Policy("2024-2", 0b11111111),
)}
CURRENT = POLICIES["2024-2"]


# Texts of more words find their repeated windows in arrays, which take a tenth of the memory.
LONG_TEXT = 50_000


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs more than once in the text."""
    if len(words) > LONG_TEXT:
        return _repeated_words_of_long_text(words)
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    total = covered = 0
    for at, window in enumerate(windows):
        if found[window] > 1:
            total += at + 3 - max(at, covered)
            covered = at + 3
    return total


def _repeated_words_of_long_text(words: list[bytes]) -> int:
    """The same count: windows are numbered words in three columns, sorted so that equal ones meet."""
    numbers: dict[bytes, int] = {}
    n = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    columns = (n[2:], n[1:-1], n[:-2])
    order = np.lexsort(columns)
    same = np.logical_and.reduce([c[order[1:]] == c[order[:-1]] for c in columns])
    often = np.zeros(len(order), bool)
    often[order[1:][same]] = often[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for j in range(3):
        covered[j:len(order) + j] |= often
    return int(covered.sum())


def _without(raw: bytes, of: bytes) -> int:
    return len(raw) - len(raw.translate(None, of))


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at the six ASCII blanks and nowhere else
    seen: set[bytes] = set()
    lines = repeats = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            repeats += line in seen
            seen.add(line)
    return (
        len(words), len(text) - _without(raw, BLANKS), _without(raw, SYMBOLS), repeats, repeated_words(words),
        lines, _without(raw, UPPER), _without(raw, LETTERS), _without(raw, DIGITS),
    )


@F.pandas_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document as a struct), ``m`` (its measures) and ``fail_bits``.

    The struct keeps any column of the input, whatever its name.
    """
    measured = docs.select(F.struct("*").alias("row"), _measured(F.col(text)).alias("m"))
    bits = F.lit(0).cast("long")
    for bit, _, fails in RULES:
        bits = bits + F.when(F.expr(fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")
    return measured.withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with the verdict of one policy; the base rules always hold."""
    return entries.withColumn("base_failed", POLICIES["base"].rejects(F.col("fail_bits"))).withColumn(
        "kept", ~(F.col("base_failed") | policy.rejects(F.col("fail_bits")))
    )


def verdicts(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with the verdict of every policy version, and the rule of ``policy`` that alone rejects, if one does.

    Nothing is measured again: all of it is read off the bits.
    """
    rejected = F.col("fail_bits").bitwiseAND(F.lit(policy.mask | BASE))
    sole = F.coalesce(*[F.when(rejected == 1 << bit, name) for bit, name, _ in RULES])
    kept = [(~p.rejects(F.col("fail_bits").bitwiseAND(F.lit(p.mask | BASE)))).alias(f"kept_{p.version.replace('-', '_')}") for p in POLICIES.values()]
    return entries.select("*", *kept, sole.alias("sole_rule"))


def ablations(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects.

    Documents are first counted per bit pattern, of which there are at most 2 to the number of
    rules; the rules then read those few counts.
    """
    patterns = entries.groupBy("fail_bits").agg(F.count("*").alias("n"))
    rejected = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    rules = [(bit, name) for bit, name, _ in RULES if policy.mask >> bit & 1]
    rule = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("rule"),
            F.when(rejected.bitwiseAND(F.lit(1 << bit)) != 0, F.col("n")).otherwise(0).alias("fails"),
            F.when(rejected == (1 << bit), F.col("n")).otherwise(0).alias("alone"),
        )
        for bit, name in rules
    ])).alias("r")
    return patterns.select(rule).groupBy("r.rule").agg(
        F.sum("r.fails").alias("n_fails"), F.sum("r.alone").alias("n_only_this_rule")
    ).withColumn("version", F.lit(policy.version))


def accepted(docs: DataFrame, policy: Policy = CURRENT, text: str = "text") -> DataFrame:
    """The documents that a policy keeps, with the columns they came with."""
    return apply_policy(ledger(docs, text), policy).where("kept").select("row.*")
