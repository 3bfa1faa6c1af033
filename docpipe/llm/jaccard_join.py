"""Similarity join of n-gram sets by partitions of the universe and ordered prefixes, exact for any threshold.

Two sets of a and b elements with Jaccard similarity p differ in at most (a + b)(1 - p) / (1 + p) elements. Sizes
are dealt into bands so narrow that partners lie in the same or in neighbouring bands; a set takes part in its own band and, as a
visitor, in the one below. In a band with bound H every element is hashed to one of m segments.

- Screening: with m = H + 1 segments, partners have at least one segment in common. Segments are counted once over all sets; a set
  whose segments nobody shares has no partner, and its elements go no further.
- Prefixes: the elements of the remaining sets are put in one order, rare ones first. The first element that two partners share
  leaves, itself included, as many elements of either as they must have in common. So a set is on the lists of only those of its elements that
  leave enough for some partner (a tenth of them at 0.9), of which elements no other set has need no list; and what an element
  leaves bounds the sizes of the partners that can be met on its list.
- Hubs: the members of a list are verified against its hub, the one on most lists; for most copies that is all, since from here
  on only lists that hold several classes count.
- Openings: per list and size it is known how large a partner its members allow. Members that no size with another class allows
  are done with the list. So are those of a large group that differ from its origin each in its own way: such elements are rare, come first,
  and leave too little for each other.
- What stays open is verified in rounds, the members outside the largest class of a list against the rest, some at a time, until no
  list has an opening. A list is never expanded into its pairs.

Every pair found is verified on the elements; classes are the connected components.

Defined cases: rows without a doc_id take no part and have a null class. Rows that share a doc_id are one document; each of its texts is
compared. Texts with fewer words than an n-gram are one element; null texts and those without a word are empty and a class of their own. Equal
sets are one set. Very long texts are longer arrays. An empty table gives no rows; other columns are not read. The class id is the smallest doc_id.
Elements are 64-bit hashes of n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docpipe.llm.common import among, written
from docpipe.llm.sets import STEP, components, list_array, mixed, shingles, verified


@dataclass(frozen=True)
class Settings:
    """Words per n-gram, the threshold in hundredths, how many times more hubs a list has in each next round, and its hubs in the first."""

    words: int = 3
    percent: int = 90
    spread: int = 3
    cold: int = 12

    def bound(self, smallest: int) -> int:
        """The most elements in which a pair differs whose smaller set has this size."""
        return (smallest + smallest * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)

    def bands(self) -> tuple[np.ndarray, np.ndarray]:
        """The smallest size of each band, and the bound of its pairs.

        Below the first band only equal sets are partners.
        """
        low, lows, bounds = 1, [], []
        while low < 2**31:
            high = low * 100 // self.percent
            if self.bound(high) or lows:
                lows.append(low)
                bounds.append(self.bound(high))
            low = high + 1
        return np.array(lows), np.array(bounds)


def set_of(text: str | None, k: int) -> np.ndarray:
    """The distinct n-grams of a text, sorted by hash; only A to Z are lower-cased."""
    return np.unique(shingles((text or "").encode().lower().split(), k))


def segmented(elements: np.ndarray, salt: np.uint64, m: int) -> np.ndarray:
    """The sum of the values of every segment's elements, which names its subset."""
    h = mixed(elements + salt)
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, (h % np.uint64(m)).astype(np.int64), mixed(h))
    return sums


def _key(sums: np.ndarray, segment: np.ndarray, salt: np.uint64) -> np.ndarray:
    return mixed(sums + mixed(segment.astype(np.uint64) + salt))


def _salt(band: int, m: int) -> np.uint64:
    return np.uint64((int(STEP) * (band + 1) + m) & 0xFFFFFFFFFFFFFFFF)


def _places(n: int, lows: np.ndarray) -> list[tuple[int, bool]]:
    """The bands in which a set of ``n`` elements takes part, and whether it is at home there."""
    band = int(np.searchsorted(lows, n, "right")) - 1
    return [(b, b == band) for b in (band, band - 1) if b >= 0]


def _sketcher(s: Settings):
    lows, bounds = s.bands()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, homes, found = [], [], [], []
            for text in batch.column(1):
                elements = set_of(text.as_py(), s.words)
                digests.append(xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None)
                sizes.append(len(elements))
                keys = []
                for band, _ in _places(len(elements), lows):
                    m = int(bounds[band]) + 1
                    salt = _salt(band, m)
                    keys.append(_key(segmented(elements, salt, m), np.arange(m), salt))
                homes.append(len(keys[0]) if keys else 0)
                found.append(np.concatenate(keys) if keys else np.empty(0, np.uint64))
            yield pa.record_batch(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(homes, pa.int32()), list_array(found)],
                names=["doc_id", "digest", "n", "home", "keys"],
            )

    return sketch


def _setter(s: Settings, wanted):
    """Sets of the texts that may be in question; the exact choice is a join afterwards."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted(batch.column(0).to_numpy())))
            made = [set_of(text.as_py(), s.words) for text in batch.column(1)]
            digests = [xxhash.xxh3_128_digest(m.tobytes()) if len(m) else None for m in made]
            yield pa.record_batch([pa.array(digests, pa.binary()), list_array(made)], names=["digest", "shingles"])

    return sets


def _those_among(wanted):
    """Rows of ``id, key`` for the keys that may be shared; the exact choice is a join afterwards."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = lists.flatten().to_numpy()
            ids = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
            keep = wanted(values)
            yield pa.record_batch([pa.array(ids[keep]), pa.array(values[keep])], names=["id", "key"])

    return keys


def _those_of(wanted):
    """Sets whose ids may be in question; the exact choice is a join afterwards."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted(batch.column(0).to_numpy())))

    return sets


def _links(pairs: DataFrame, sets: DataFrame, s: Settings, name: str) -> DataFrame:
    """The pairs (a, b) that are partners. Only the sets of these pairs are shuffled."""
    pairs = written(pairs, f"{name}-pairs")
    wanted = among(pairs.select("a").union(pairs.select("b")))
    return written(verified(pairs, sets.select("id", "shingles").mapInArrow(_those_of(wanted), "id long, shingles array<long>"), s.percent), f"{name}-links")


def _prefixes(sets: DataFrame, s: Settings) -> DataFrame:
    """``list, id, n, reach``: the elements of ``sets`` (``id, shingles``) at which a partner can be met first, and its largest size.

    In the order of how many sets have an element, the first that two partners share leaves in both sets at least what they have in common.
    """
    elements = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("element"))
    often = written(elements.groupBy("element").agg(F.count("*").alias("often")).where("often > 1"), "join-often")
    # the elements of one set, those without another set left out: they come first and meet nobody
    ordered = elements.join(often, "element").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("often", "element"))).alias("own"))
    first = F.size("own") - F.ceil(F.col("n") * s.percent / 100) + 1
    listed = ordered.withColumn("first", first.cast("int")).where("first > 0").select(
        "id", "n", F.size("own").alias("size"), F.posexplode(F.slice("own", F.lit(1), F.col("first"))).alias("at", "e")
    )
    reach = F.floor((F.col("size") - F.col("at")) * (100 + s.percent) / s.percent) - F.col("n")
    return listed.select(F.col("e.element").alias("list"), "id", "n", reach.cast("int").alias("reach"))


def _fits(a: str, b: str, s: Settings) -> Column:
    """Two rows of a list, or a row and a size with the reach of its members, that may be partners."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (F.col(f"{a}.list") == F.col(f"{b}.list")) & (small * 100 >= large * s.percent) & (F.col(f"{b}.n") <= F.col(f"{a}.reach"))


def _pairs(members: DataFrame, hubs: DataFrame, s: Settings) -> DataFrame:
    """Members in other classes that the hubs of their lists may be partners of. Both sides have ``list, id, n, reach, root``."""
    both = members.alias("p").join(hubs.alias("x"), _fits("p", "x", s) & (F.col("p.n") <= F.col("x.reach")) & (F.col("p.root") != F.col("x.root")))
    return both.select(F.least("p.id", "x.id").alias("a"), F.greatest("p.id", "x.id").alias("b")).distinct()


def _hubs(met: DataFrame) -> DataFrame:
    """Of each list the member that is on most lists."""
    often = met.groupBy("id").agg(F.count("*").alias("often"))
    # struct order: most lists first, then the smallest id
    rank = F.struct("often", (-F.col("id")).alias("neg"), "n", "reach", "root")
    hubs = met.join(often, "id").groupBy("list").agg(F.max(rank).alias("hub"))
    return hubs.select("list", (-F.col("hub.neg")).alias("id"), "hub.n", "hub.reach", "hub.root")


def _joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``id, root`` after further links; only classes that these join are worked on."""
    of = lambda side: roots.select(F.col("id").alias(side), F.col("root").alias(f"r{side}"))
    named = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")
    ).where("a <> b").distinct()
    above = components(named).select(F.col("id").alias("root"), F.col("root").alias("above"))
    known = roots.join(above, "root", "left").select("id", F.coalesce("above", "root").alias("root"))
    new = above.join(roots.select(F.col("id").alias("root")), "root", "left_anti").select(F.col("root").alias("id"), F.col("above").alias("root"))
    return written(known.union(new), "join-roots")


def _open(members: DataFrame, s: Settings) -> DataFrame:
    """The members (``list, id, n, reach, root``) that can still meet another class on their list, with ``main``, its largest class.

    Per list and size: the reach in the main class, the longest reach outside it, and the classes there. Few sizes are near enough to a member,
    so a long list is looked at once per member, not once per pair.
    """
    of_class = members.groupBy("list", "root").agg(F.count("*").alias("of_class"))
    lists = of_class.groupBy("list").agg(F.max(F.struct("of_class", "root")).alias("most"), F.count("*").alias("classes")).where("classes > 1")
    several = written(members.join(lists.select("list", F.col("most.root").alias("main")), "list"), "join-several")
    stray = F.col("root") != F.col("main")
    sizes = written(several.groupBy("list", "n").agg(
        F.max(F.when(~stray, F.col("reach"))).alias("of_main"), F.max(F.when(stray, F.col("reach"))).alias("of_strays"),
        F.min(F.when(stray, F.col("root"))).alias("low"), F.max(F.when(stray, F.col("root"))).alias("high"),
    ), "join-sizes")
    meets_main = (F.col("p.root") != F.col("p.main")) & (F.col("x.of_main") >= F.col("p.n"))
    meets_stray = (F.col("x.of_strays") >= F.col("p.n")) & ((F.col("x.low") != F.col("x.high")) | (F.col("x.low") != F.col("p.root")))
    return several.alias("p").join(sizes.alias("x"), _fits("p", "x", s) & (meets_main | meets_stray), "left_semi")


def _rounds(members: DataFrame, roots: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """``id, root`` after the members of lists with openings have been verified against hubs, members outside the largest class of a list.

    A hub has been compared with all that it may be a partner of and leaves the list. The number of hubs per list grows each
    round, so few rounds are needed.
    """
    hubs_per_list = s.cold
    order = Window.partitionBy("list").orderBy(F.desc("reach"), "id")
    while True:
        members = written(_open(written(_with_roots(members, roots), "join-members"), s), "join-open")
        if not members.head(1):
            return roots
        strays = members.where("root <> main").withColumn("nth", F.row_number().over(order))
        hubs = written(strays.where(F.col("nth") <= hubs_per_list).drop("nth", "main"), "join-hubs")
        found = _links(_pairs(members, hubs, s), sets, s, "join")
        if found.head(1):
            roots = _joined_roots(roots, found)
        members = members.join(hubs.select("list", "id"), ["list", "id"], "left_anti").drop("root", "main")
        hubs_per_list *= s.spread


def classes_among(sets: DataFrame, s: Settings, links: DataFrame | None = None) -> DataFrame:
    """``id, root``: the classes into which all partners among ``sets`` (``id, shingles``) and the given links join.

    Pairs that the given links join are not compared again. Sets without a link may be missing.
    """
    met = written(_prefixes(sets, s), "join-prefixes")
    roots = None if links is None else components(links)
    named = met.withColumn("root", F.col("id")) if roots is None else written(_with_roots(met, roots), "join-named")
    hubs = written(_hubs(named), "join-hubs")
    found = _links(_pairs(named, hubs, s), sets, s, "join-hub")
    roots = components(found) if roots is None else _joined_roots(roots, found)
    return _rounds(met, roots, sets, s)


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def classes_of(nodes: DataFrame, texts: DataFrame, s: Settings, links: DataFrame | None) -> DataFrame:
    """Classes of the nodes (``digest, id, first, n, home, keys``), with sets made from ``texts`` (``doc_id, text``)."""
    exploded = nodes.select("id", F.posexplode("keys").alias("at", "key"), "home").select("id", "key", (F.col("at") < F.col("home")).alias("own"))
    crowds = exploded.groupBy("key").agg(F.count("*").alias("size"), F.max("own").alias("at_home")).where("size > 1 AND at_home").select("key")
    crowds = written(crowds, "join-crowds")
    likely = nodes.select("id", "keys").mapInArrow(_those_among(among(crowds)), "id long, key long")
    asked = likely.join(crowds, "key", "left_semi").select("id").distinct()
    question = written(nodes.select("id", "digest", "first").join(asked, "id", "left_semi"), "join-question")
    made = texts.where("doc_id IS NOT NULL").mapInArrow(_setter(s, among(question.select("first"))), "digest binary, shingles array<long>")
    return classes_among(written(
        made.join(question.select("digest", "id"), "digest").groupBy("id").agg(F.any_value("shingles").alias("shingles")), "join-sets"
    ), s, links)


def joined(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    s = settings
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = written(texts.mapInArrow(_sketcher(s), "doc_id long, digest binary, n long, home int, keys array<long>"), "join-sketches")
    known = sketches.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    nodes = written(
        known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.any_value(F.struct("n", "home", "keys")).alias("s"))
        .select("digest", F.monotonically_increasing_id().alias("id"), "first", "s.*"), "join-nodes",
    )
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    rows = known.join(repeated, "doc_id").select("doc_id", "digest").distinct().join(nodes.select("digest", "id"), "digest")
    least = rows.groupBy("doc_id").agg(F.min("id").alias("b"))
    same_id = written(rows.join(least, "doc_id").where("id <> b").select(F.col("id").alias("a"), "b"), "join-same-id")
    roots = classes_of(nodes, texts, s, same_id if same_id.head(1) else None)
    linked = written(nodes.select("digest", "id", "first").join(roots, "id"), "join-linked")
    class_of = linked.join(linked.groupBy("root").agg(F.min("first").alias("component")), "root").select("id", "component")
    names = written(nodes.select("digest", "id", "first").join(class_of, "id", "left").select("digest", F.coalesce("component", "first").alias("component_id")), "join-names")
    found = known.select("doc_id", "n", "digest").join(names, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    # rows without words or id meet nothing, however many there are
    alone = sketches.where("doc_id IS NULL OR digest IS NULL")
    return found.union(alone.select("doc_id", "n", F.col("doc_id").alias("component_id")))
