"""Near duplicates by ProbMinHash signatures, banding, and exact verification.

Each element of a weighted set (a shingle of five words, weighted by one plus the log of how
often it occurs) is a Poisson process whose rate is its weight. Arrivals fall on the registers
of the signature at random; a register keeps the element that reached it first. Two signatures
agree in a register with the probability Jaccard similarity of the sets, which is plain Jaccard
when all weights are equal. Elements whose next arrival is later than the slowest register are
done; the pass ends when all are.

A repeated line moves the weights, and with them probability Jaccard far below plain Jaccard. So a text with
repeated shingles has a second signature, of unit weights, and is in the bands of both.

Texts whose words are the same are one text first. Of the others, signatures that agree in a
band meet in a bucket. A pair is linked if the Jaccard similarity of its distinct shingles
reaches the threshold exactly; classes are the connected components.

Each member of a bucket is verified against the bucket's hub, the
member that meets most others over all bands (the common origin of a group of copies). Pairs of
members in different classes follow only if a bound from their overlaps with the hub lets them reach the
threshold, for which most must share rare shingles outside it; every such pair is verified.

Defined cases: rows without a doc_id take no part and have a null class. Rows that share a doc_id
are one document; each of its texts is compared. Texts with one to four words are one shingle; a text without words is a class of
its own. The class id is the smallest doc_id of the class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpipe.llm.common import among, written
from docpipe.llm.sets import STEP, components, list_array, mixed, shingles, similar, verified

# Arrivals of an element in one round of a signature at most.
MOST_TURNS = 64


@dataclass(frozen=True)
class Settings:
    """Words per shingle, the threshold in hundredths, and the shape of the signature.

    With 26 bands of 5 a pair at 0.8 is missed with probability 0.00003.
    """

    words: int = 5
    percent: int = 80
    bands: int = 26
    rows: int = 5

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def signature(elements: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """ProbMinHash of distinct elements: per register the element that arrives first.

    Arrivals go on in rounds of elements that can still win a register; few elements make several arrivals in a round.
    """
    first = np.full(m, np.inf)
    winner = np.zeros(m, np.uint64)
    at = np.zeros(len(elements))
    turn = 1
    live, rate = elements, weights
    while len(live):
        turns = min(MOST_TURNS, 1 + 6 * m // len(live))
        seeds = STEP * np.arange(2 * turn, 2 * (turn + turns), dtype=np.uint64)[:, None]
        draw = mixed(live + seeds[::2])
        wait = -np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate
        wait[0] += at
        arrival = np.add.accumulate(wait, axis=0)
        register = (mixed(live + seeds[1::2]) % np.uint64(m)).astype(np.int64)
        before = first.copy()
        np.minimum.at(first, register.ravel(), arrival.ravel())
        won = (arrival == first[register]) & (arrival < before[register])
        winner[register[won]] = np.broadcast_to(live, won.shape)[won]
        keep = arrival[-1] < first.max()
        live, rate, at = live[keep], rate[keep], arrival[-1][keep]
        turn += turns
    return winner


def bands(sig: np.ndarray, s: Settings) -> np.ndarray:
    """One hash per band, the band's number included."""
    parts = sig.reshape(s.bands, s.rows)
    out = np.arange(1, s.bands + 1, dtype=np.uint64)
    for j in range(s.rows):
        out = mixed(out * STEP + parts[:, j])
    return out


def keys(elements: np.ndarray, counts: np.ndarray, s: Settings) -> np.ndarray:
    """The bands under which distinct shingles are looked up.

    Those of unit weights find what plain Jaccard decides, however often shingles occur. Those of the weighted
    set come on top; without repeats they are the same.
    """
    plain = bands(signature(elements, np.ones(len(elements)), s.registers), s)
    if counts.max() == 1:
        return plain
    return np.union1d(plain, bands(signature(elements, 1.0 + np.log(counts), s.registers), s))


def _digest(words: list[bytes]) -> bytes | None:
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def _sketcher(s: Settings):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, found = [], [], []
            for text in batch.column(1):
                words = (text.as_py() or "").encode().split()
                digests.append(_digest(words))
                elements, counts = np.unique(shingles(words, s.words), return_counts=True)
                sizes.append(len(elements))
                found.append(keys(elements, counts, s) if words else np.empty(0, np.uint64))
            yield pa.record_batch(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), list_array(found)],
                names=["doc_id", "digest", "n", "bands"],
            )

    return sketch


def _sets(s: Settings, wanted: Callable[[np.ndarray], np.ndarray]):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted(batch.column(0).to_numpy())))
            digests, rows = [], []
            for text in batch.column(1):
                words = (text.as_py() or "").encode().split()
                digests.append(_digest(words))
                rows.append(np.unique(shingles(words, s.words)))
            yield pa.record_batch([pa.array(digests, pa.binary()), list_array(rows)], names=["digest", "shingles"])

    return sets


def classes(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """``doc_id`` and ``class_id`` of every row."""
    s = settings
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = written(
        texts.mapInArrow(_sketcher(s), "doc_id long, digest binary, n long, bands array<long>"), "near-sketches"
    )
    known = sketches.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    # one node per text, numbered as it is written; documents with several texts have several
    groups = written(
        known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min(F.struct("n", "bands")).alias("s"))
        .withColumn("id", F.monotonically_increasing_id()), "near-texts",
    )
    nodes = groups.select("digest", "id", "first")
    members = groups.select(F.explode("s.bands").alias("band"), "id", F.col("s.n").alias("n"))
    # written first, so that the join meets two plain shuffles and a hot bucket can be split
    crowds = written(members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "near-crowds")
    met = written(members.join(crowds, "band"), "near-buckets")
    met_by = met.groupBy("id").agg(F.sum("size").alias("met"))
    # struct order: most meetings first, then the smallest id
    rank = F.struct("met", (-F.col("id")).alias("neg"), "n")
    hubs = written(met.join(met_by, "id").groupBy("band").agg(F.max(rank).alias("hub")), "near-centres")
    to_hub = written(
        met.join(hubs, "band").select(
            "band", "size", "id", "n", (-F.col("hub.neg")).alias("hub"), F.col("hub.n").alias("hub_n")
        ), "near-hubs",
    )
    pairs = written(
        to_hub.where((F.col("id") != F.col("hub")) & similar(F.col("n"), F.col("hub_n"), F.least("n", "hub_n"), s.percent))
        .select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), "near-pairs",
    )
    # the texts in question, once; only their shingles leave the tasks that read them
    in_question = written(nodes.join(met.select("id").distinct(), "id", "left_semi"), "near-question")
    made = texts.where("doc_id IS NOT NULL").mapInArrow(_sets(s, among(in_question.select("first"))), "digest binary, shingles array<long>")
    sets = written(
        made.join(in_question.select("digest", "id"), "digest").groupBy("id").agg(F.any_value("shingles").alias("shingles")), "near-sets"
    )
    links = written(verified(pairs, sets, s.percent), "near-links")
    roots = components(links)
    rest = written(_rest(to_hub, roots, sets, s), "near-rest")
    more = written(verified(rest, sets, s.percent), "near-links")
    roots = components(_same_id(known, nodes).union(links).union(more))
    linked = written(nodes.join(roots, "id").select("id", "root", "first"), "near-linked")
    least = linked.groupBy("root").agg(F.min("first").alias("class_id"))
    named = written(linked.join(least, "root").select("id", "class_id"), "near-named")
    of_text = nodes.join(named, "id", "left").select("digest", F.coalesce("class_id", "first").alias("class_id"))
    found = known.select("doc_id", "digest").join(written(of_text, "near-classes"), "digest").select("doc_id", "class_id")
    # rows without words or id meet nothing, however many there are
    alone = sketches.where("doc_id IS NULL OR digest IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    return found.union(alone)


def _same_id(known: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the texts of rows that share a doc_id."""
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    rows = known.join(repeated, "doc_id").select("doc_id", "digest").distinct().join(nodes, "digest").select("doc_id", "id")
    least = rows.groupBy("doc_id").agg(F.min("id").alias("b"))
    return rows.join(least, "doc_id").where("id <> b").select(F.col("id").alias("a"), "b")


def _rest(to_hub: DataFrame, roots: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs that share a bucket and a hub, are in different classes, and could be similar.

    For a hub h, what two members a and b have in common is at most the smaller of their overlaps
    with h, plus the shingles outside h that both have. So a pair has one of two forms:

    - the overlaps with h suffice alone. Since one of the two is not similar to h, the other must be smaller
      than h by a margin; sizes are dealt into narrow cells and only fitting cells meet.
    - they share shingles outside h. These are counted per pair; shingles that only one class has are left out, and
      so are members for which all that they share would not be enough.

    A group of copies of one text has neither: its members differ from the hub each in its own way.
    """
    placed = to_hub.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    placed = written(placed, "near-placed")
    mixed = placed.where("size > 2").groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_ = placed.join(mixed.where("low <> high").select("band"), "band").select("hub", "id", "n", "root").distinct()
    own, of_hub = sets.select("id", F.col("shingles").alias("own")), sets.select(F.col("id").alias("hub"), F.col("shingles").alias("base"))
    hub_roots = roots.select(F.col("id").alias("hub"), F.col("root").alias("hub_root"))
    members = written(
        open_.join(own, "id").join(of_hub, "hub").join(hub_roots, "hub", "left").select(
            "hub", "id", "n", "root", F.size(F.array_intersect("own", "base")).alias("overlap"),
            F.array_except("own", "base").alias("outside"), (F.col("root") != F.coalesce("hub_root", "hub")).alias("apart"),
        ), "near-members",
    )
    narrow = ["hub", "id", "n", "root", "overlap"]
    # shingles outside the hub that members of several classes have
    outside = members.select(*narrow, F.explode("outside").alias("shingle"))
    several = outside.groupBy("hub", "shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("often")).where("low <> high")
    shared = written(outside.join(several.select("hub", "shingle", "often"), ["hub", "shingle"]), "near-outside")
    # how many of them a member must share with a partner of any size found around this hub; some cannot, even with all
    sizes = members.select("hub", F.col("n").alias("size")).distinct()
    least = members.select("hub", "n").distinct().join(sizes, "hub").where(
        (F.col("size") * 100 >= F.col("n") * s.percent) & (F.col("n") * 100 >= F.col("size") * s.percent)
    ).groupBy("hub", "n").agg(F.min("size").alias("least"))
    wanted = F.ceil((F.col("n") + F.col("least")) * s.percent / (100 + s.percent)) - F.col("overlap")
    able = shared.groupBy(*narrow).agg(F.collect_list("shingle").alias("own")).join(least, ["hub", "n"])  # the shingles of one text
    able = written(able.withColumn("must", F.greatest(wanted, F.lit(1))).where(F.size("own") >= F.col("must")).drop("least"), "near-able")
    # two lists that share as many, in order of rarity, share one of the first size - must + 1
    rarest = Window.partitionBy("hub", "id").orderBy("often", "shingle")
    first = shared.select("hub", "id", "shingle", "often").join(able.select("hub", "id", "root", "must", F.size("own").alias("size")), ["hub", "id"])
    first = written(first.withColumn("nth", F.row_number().over(rarest)).where("nth <= size - must + 1").select("hub", "shingle", "id", "root"), "near-first")
    a, b = first.alias("a"), first.alias("b")
    meeting = a.join(
        b, (F.col("a.hub") == F.col("b.hub")) & (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.root") != F.col("b.root"))
    ).select(F.col("a.hub").alias("hub"), F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    side = lambda name: able.select("hub", F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "overlap", "own")])
    common = F.least("overlap_a", "overlap_b") + F.size(F.array_intersect("own_a", "own_b"))
    together = meeting.join(side("a"), ["hub", "a"]).join(side("b"), ["hub", "b"]).where(similar(F.col("n_a"), F.col("n_b"), common, s.percent)).select("a", "b")
    # sizes at which the overlaps with the hub suffice alone
    cell = lambda n: F.floor(F.log(n) / np.log(1.02)).cast("int")
    low = F.ceil(F.col("n") * s.percent / 100)
    high = F.floor(F.col("overlap") * (100 + s.percent) / s.percent - F.col("n"))
    wanted = members.where("apart").select(*narrow).where(high >= low).withColumn("cell", F.explode(F.sequence(cell(low) - 1, cell(high) + 1)))
    c, d = wanted.alias("c"), members.select(*narrow, cell(F.col("n")).alias("cell")).alias("d")
    alone = c.join(
        d, (F.col("c.hub") == F.col("d.hub")) & (F.col("c.cell") == F.col("d.cell")) & (F.col("c.id") != F.col("d.id"))
        & (F.col("c.root") != F.col("d.root")) & similar(F.col("c.n"), F.col("d.n"), F.least("c.overlap", "d.overlap"), s.percent)
    ).select(F.least("c.id", "d.id").alias("a"), F.greatest("c.id", "d.id").alias("b"))
    return together.union(alone).distinct()


def deduplicated(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """One document of each class, with the columns it came with.

    It is the one whose id names the class; of rows that share that id the first by text. Rows
    without an id are kept.
    """
    keep = written(classes(docs, settings, text).where("doc_id = class_id").select("doc_id").distinct(), "near-kept")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.col(text).alias("text"))
    one = rows.join(keep, F.col("id") == keep.doc_id, "left_semi").withColumn(
        "nth", F.row_number().over(Window.partitionBy("id").orderBy("text"))
    ).where("nth = 1")
    return one.select("row.*").union(rows.where("id IS NULL").select("row.*"))
