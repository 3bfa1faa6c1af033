"""Chains of earlier versions, by pointer doubling.

A manifest names for an object the one it replaces. In round k every object that is not at its end knows the object 2^k
steps back, and joins with that one's own knowledge, so a chain of a thousand versions takes ten rounds.
Chains end in every round up to the longest one; after a round in which none ends, objects left are in a cycle or lead to one, and
their rounds go on among themselves until they have gone round it.

The rounds are written tables. Objects at their end take no part any more, so a first version that very many chains lead to is
a join key in no round; other frequent ancestors are split by adaptive execution.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.session import snapshot


def links_of(manifest: DataFrame) -> DataFrame:
    """``name, prior``: the last thing a manifest said of each object. ``prior`` is null for first versions."""
    said = F.struct("manifest_date", F.col("Prior_Version_Object_Name").alias("prior"))
    named = manifest.where(F.col("Object_name").isNotNull()).groupBy("Object_name").agg(F.max(said).alias("said"))
    return named.select(F.col("Object_name").alias("name"), "said.prior")


def lineage(links: DataFrame) -> DataFrame:
    """``name, first, depth, cycle`` of every object that is named.

    ``first`` is the earliest version and ``depth`` the number of steps to it; an object that only occurs as a prior version is the first of
    its followers. For objects in a cycle or leading to one ``first`` is the least name of that cycle, ``depth`` is null, and ``cycle`` says
    ``in`` or ``to``; else it is null.
    """
    steps = snapshot(_steps(links), "lineage")
    known = steps.count()
    ends, others = steps.where("prior IS NULL").select("name"), steps.where("prior IS NOT NULL")
    # `at` is 2^turn steps back or, if that comes first, the end; `least` is the least name on the way
    start = others.join(ends.select(F.col("name").alias("prior"), F.lit(True).alias("ended")), "prior", "left").select(
        "name", F.col("prior").alias("at"), F.lit(1).cast("bigint").alias("depth"), F.least("name", "prior").alias("least"),
        F.coalesce("ended", F.lit(False)).alias("ended"),
    )
    pieces, turn = [snapshot(start, "lineage-steps")], 0
    open_, ending = pieces[0].where("NOT ended"), True
    # depths have no gaps: after a round that ends no object, none that is open has an end
    while ending and open_.head(1) and 2**turn <= known:
        # what is known of the object reached: of ended ones from the round in which they ended, of others from the last
        pieces.append(snapshot(_doubled(open_, reduce(DataFrame.union, [*[p.where("ended") for p in pieces], open_])), "lineage-steps"))
        ending = bool(pieces[-1].where("ended").head(1))
        open_ = pieces[-1].where("NOT ended")
        turn += 1
    if not ending:
        open_ = _round_cycles(open_, turn, known)
    straight = [p.where("ended").select("name", F.col("at").alias("first"), "depth") for p in pieces]
    straight.append(ends.select("name", F.col("name").alias("first"), F.lit(0).cast("bigint").alias("depth")))
    done = reduce(DataFrame.union, straight).withColumn("cycle", F.lit(None).cast("string"))
    # these steps end inside a cycle, and from every object of a cycle they end at another one of it
    inside = open_.select(F.col("at").alias("member")).distinct()
    least = open_.join(inside, F.col("name") == F.col("member")).select(F.col("name").alias("at"), F.col("least").alias("first"))
    circular = open_.join(least, "at").join(inside, F.col("name") == F.col("member"), "left").select(
        "name", "first", F.lit(None).cast("bigint").alias("depth"), F.when(F.col("member").isNull(), "to").otherwise("in").alias("cycle")
    )
    return done.union(circular)


def _doubled(open_: DataFrame, known: DataFrame) -> DataFrame:
    """Objects with twice the steps, joined with what is known of the object they reached."""
    back = known.select(
        F.col("name").alias("at"), F.col("at").alias("next"), F.col("depth").alias("more"), F.col("least").alias("lower"), F.col("ended").alias("over")
    )
    return open_.join(back, "at").select(
        "name", F.col("next").alias("at"), (F.col("depth") + F.col("more")).alias("depth"), F.least("least", "lower").alias("least"),
        F.col("over").alias("ended"),
    )


def _round_cycles(open_: DataFrame, turn: int, known: int) -> DataFrame:
    """The same objects, none of which has an end, with steps that go round every cycle.

    The objects reached are members of cycles once a round reaches as many as the one before. Their least names are those of whole cycles once
    a round changes none of them. Both come after the longest cycle with its tail, not after as many steps as there are objects.
    """
    reached, settled = open_.select("at").distinct().count(), False
    while not settled and 2**turn <= known:
        further = snapshot(_doubled(open_, open_), "lineage-cycles")
        members = further.select(F.col("at").alias("name")).distinct()
        before = open_.select("name", F.col("least").alias("old")).join(members, "name")
        now, lower = before.join(further, "name").agg(F.count("*"), F.count_if(F.col("least") < F.col("old"))).first()
        settled, reached = now == reached and lower == 0, now
        open_, turn = further, turn + 1
    return open_


def _steps(links: DataFrame) -> DataFrame:
    """One row per name, with names that only occur as a prior version; of several priors the greatest counts."""
    named = links.where(F.col("name").isNotNull()).groupBy("name").agg(F.max("prior").alias("prior"))
    priors = links.where("prior IS NOT NULL").select(F.col("prior").alias("name")).distinct()
    return named.union(priors.join(named.select("name"), "name", "left_anti").withColumn("prior", F.lit(None).cast("string")))


def earlier_versions(links: DataFrame) -> DataFrame:
    """``name, back, earlier``: every earlier version of every object, ``back`` steps before it.

    As many rows as there are such pairs. Objects in or before a cycle have none here; ``lineage`` reports them.
    """
    steps = snapshot(_steps(links), "versions")
    whole = lineage(links).where("cycle IS NULL AND depth > 0")
    deepest = whole.agg(F.max("depth")).first()[0] or 0
    jump = snapshot(steps.join(whole.select("name"), "name", "left_semi").select("name", F.col("prior").alias("at")), "versions-jump")
    pieces, reach = [jump.select("name", F.lit(1).cast("bigint").alias("back"), F.col("at").alias("earlier"))], 1
    while reach < deepest:
        # what is known of the object `reach` steps back holds for this one, further back by `reach`
        via = reduce(DataFrame.union, pieces).withColumnRenamed("name", "at")
        further = jump.join(via, "at").select("name", (F.col("back") + reach).alias("back"), "earlier")
        pieces.append(snapshot(further, "versions-found"))
        jump = snapshot(jump.join(jump.toDF("at", "next"), "at").select("name", F.col("next").alias("at")), "versions-jump")
        reach *= 2
    return reduce(DataFrame.union, pieces)
