"""Mixing sources to target weights by a curriculum that changes over the training run.

Each source has a weight schedule over training time. Its integral says which share of the
source's words is wanted up to a time, so the inverse of that integral gives every document
the time at which it is due; documents sorted by that time are the training order.

All of it is DataFrame operations. No source is ever in one task: prefix sums run over
buckets of (source, hash), and only the sums per bucket are put in line per source.

Defined cases: null text has no words and is never taken. Null is a source like any other, after all others.
Repeated rows are documents of their own; An empty table gives an empty mix. Very long texts are only
counted. Any further columns, whatever their names, travel in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docpipe.llm.common import word_count, written

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
# Relative weight of a source at the start and at the end of training, by its place in WEIGHTS.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
ROWS_PER_BUCKET = 4_000
HASH_VALUES = 1 << 16


def sized(docs: DataFrame, keep: Column | None = None) -> DataFrame:
    """``row`` (what to keep of a document), ``source``, ``size`` in words, and the ``key`` that
    fixes a document's place in its source's line."""
    return docs.select(
        (F.struct("*") if keep is None else keep).alias("row"), F.col("source"), word_count(F.col("text")).alias("size"),
        F.struct(F.md5(F.col("doc_id").cast("string").cast("binary")).alias("h"), F.col("doc_id").alias("id")).alias("key"),
    )


def ranked(sources: DataFrame) -> DataFrame:
    """``place`` of every source in code-point order from 0, null last, without one global sort.

    The sources are dealt by range; a place is the rank in its range plus the rows before.
    """
    dealt = written(
        sources.withColumn("last", F.col("source").isNull()).repartitionByRange("last", "source")
        .withColumn("part", F.spark_partition_id()), "mix-sources",
    )
    before = dealt.groupBy("part").count().withColumn(
        "before", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    within = Window.partitionBy("part").orderBy("last", "source")
    return dealt.join(before, "part").select(
        "source", "source_size", (F.row_number().over(within) - 1 + F.col("before")).alias("place")
    )


def targets(sources: DataFrame) -> DataFrame:
    """Adds ``place`` and ``target``: shares by weight, none above three times its source.

    What is cut off one source is shared among the rest by weight until nothing is cut. Each
    round is one aggregate over the sources, of which one row comes back.
    """
    pick = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    by_source = written(ranked(sources).withColumn("w", pick.cast("long")), "mix-ranks")
    whole = F.col("source_size").cast("decimal(38,0)")
    most = whole * MOST_REPEATS
    capped: Column = F.lit(False)
    n_before = -1
    while True:
        rest, weight, n = by_source.agg(
            F.sum(whole) - F.coalesce(F.sum(F.when(capped, most)), F.lit(0)),
            F.sum(F.when(~capped, F.col("w"))), F.count(F.when(capped, 1)),
        ).first()
        if weight is None:
            return by_source.withColumn("target", F.lit(0.0))  # no source at all
        wanted = F.lit(int(rest)).cast("decimal(38,0)") * F.col("w")
        if n == n_before:
            return by_source.withColumn("target", F.when(capped, most.cast("double")).otherwise(wanted.cast("double") / float(weight)))
        n_before = n
        # what is over a cap stays over it: the share per weight only grows
        capped = wanted > most * F.lit(int(weight))


def due(quantile: Column, place: Column) -> Column:
    """Training time in 0 to 1 at which the share ``quantile`` of a source's demand is reached.

    The demand is the integral of a weight that runs in a line from a to b; its inverse is the
    root of a quadratic.
    """
    kind = (place % len(SCHEDULES) + 1).cast("int")
    a = F.element_at(F.array(*[F.lit(s[0]) for s in SCHEDULES]), kind)
    b = F.element_at(F.array(*[F.lit(s[1]) for s in SCHEDULES]), kind)
    root = (F.sqrt(a * a + (b - a) * (a + b) * quantile) - a) / (b - a)
    return F.when(a == b, quantile).otherwise(root)


def mixed(lines: DataFrame) -> DataFrame:
    """Of documents with their sizes: ``row`` with size, source_size, target, taken, copies and ``due`` (one time per copy).

    A document's copies are whole: copy number e is in the mix if the middle of its words, in
    the line of its source's words repeated, is within the target. So a source misses its
    target by half a document at most.
    """
    narrow = written(lines.select("source", "size", "key"), "mix-sizes")
    n_rows = narrow.count()
    buckets = min(HASH_VALUES, n_rows // ROWS_PER_BUCKET + 1)
    bucket = F.floor(F.coalesce(F.conv(F.substring("key.h", 1, 4), 16, 10).cast("long"), F.lit(0)) * buckets / HASH_VALUES)
    sums = written(narrow.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "mix-buckets")
    by_source = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
    line = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("words").over(line), F.lit(0)))
    offsets = written(
        offsets.alias("o").join(by_source.alias("s"), F.col("o.source").eqNullSafe(F.col("s.source")))
        .select("o.source", "o.bucket", "o.offset", "s.source_size", "s.place", "s.target"), "mix-offsets",
    )
    within = Window.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("bucket", bucket).withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).alias("d")
    o = offsets.alias("o")
    joined = placed.join(
        o, F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.bucket") == F.col("o.bucket"))
    ).select("d.row", "d.size", "o.source_size", "o.target", "o.place", (F.col("o.offset") + F.col("d.within")).alias("begin"))
    middles = F.transform(
        F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1)),
        lambda e: (F.col("begin") + e * F.col("source_size")).cast("double") + F.col("size") / 2,
    )
    taken = F.filter(middles, lambda m: (F.col("size") > 0) & (m <= F.col("target")))
    return joined.withColumn("middles", taken).select(
        "row", "size", "source_size", "target",
        (F.size("middles") * F.col("size")).cast("long").alias("taken"),
        F.size("middles").alias("copies"),
        F.transform("middles", lambda m: due(m / F.col("target"), F.col("place"))).alias("due"),
    )


def curriculum(docs: DataFrame) -> DataFrame:
    """The documents in training order, one row per copy, with the columns they came with."""
    copies = mixed(sized(docs)).select("row", F.explode("due").alias("at"))
    return copies.sort("at", "row.doc_id").select("row.*")
