"""Chains of versions, and changes by content."""

import random

import pytest

from docpipe.operators import content_delta as cd
from docpipe.operators import lineage as ln

LINKS = "name string, prior string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain(links):
    """``name, first, depth, cycle`` by walking every chain."""
    prior = {}
    for name, before in links:
        if name is not None:
            prior[name] = max(filter(None, [prior.get(name), before]), default=None)
    names = set(prior) | {p for _, p in links if p is not None}
    out, earlier = [], []
    for name in names:
        way, at = [name], prior.get(name)
        while at is not None and at not in way:
            way.append(at)
            at = prior.get(at)
        if at is None:
            out.append((name, way[-1], len(way) - 1, None))
            earlier += [(name, n, v) for n, v in enumerate(way) if n]
        else:
            ring = way[way.index(at):]
            out.append((name, min(ring), None, "in" if name in ring else "to"))
    return sorted(out, key=repr), sorted(earlier, key=repr)


CASES = {
    "none": [],
    "single": [("a", None), (None, "b"), (None, None)],
    "chain": [(f"n{i:03}", f"n{i + 1:03}") for i in range(37)],
    "itself": [("a", "a"), ("b", "a")],
    "rings": [("a", "b"), ("b", "c"), ("c", "a"), ("x", "b"), ("y", "x"), ("p", "q"), ("q", "p"), ("z", None), ("w", "z")],
    "several priors": [("a", "b"), ("a", "c"), ("b", None), ("a", None), ("c", "d")],
    "star": [(f"s{i}", "hub") for i in range(50)] + [("hub", "r1"), ("r1", "r2"), ("r2", "r3")],
}
random.seed(8)
CASES["random"] = [(f"v{i}", f"v{random.randrange(120)}" if random.random() < 0.9 else None) for i in range(100)]


@pytest.mark.parametrize("case", CASES)
def test_lineage_equals_a_walk(spark, case):
    links = spark.createDataFrame(CASES[case], LINKS)
    expected, earlier = plain(CASES[case])
    assert rows(ln.lineage(links)) == expected
    assert rows(ln.earlier_versions(links)) == earlier


def test_chains_up_to_a_thousand(spark):
    links = [(f"{length}-{i}", f"{length}-{i + 1}" if i < length else None) for length in (1, 2, 3, 63, 64, 65, 1000) for i in range(length + 1)]
    got = {r.name: (r.first, r.depth) for r in ln.lineage(spark.createDataFrame(links, LINKS)).collect()}
    for name, (first, depth) in got.items():
        length, at = map(int, name.split("-"))
        assert (first, depth) == (f"{length}-{length}", length - at)


def test_links_come_from_the_last_manifest(spark):
    manifest = spark.createDataFrame(
        [("a", "old", 1), ("a", "newer", 2), ("b", None, 2), ("b", "x", 1), (None, "y", 3)], "Object_name string, Prior_Version_Object_Name string, day int"
    ).selectExpr("*", "date_add(DATE '2020-01-01', day) AS manifest_date")
    assert rows(ln.links_of(manifest)) == [("a", "newer"), ("b", None)]


def test_delta_by_content(spark):
    def day(*files):
        return cd.digests(spark.createDataFrame(files, "files string, content binary"))

    before = day(("same", b"x"), ("longer", b"x"), ("edited", b"abc"), ("gone", b"q"), ("unread", b"x"), ("twice", b"1"), ("twice", b"2"), ("empty", b""))
    now = day(("same", b"x"), ("longer", b"xx"), ("edited", b"abd"), ("new", b"q"), ("unread", None), ("twice", b"2"), ("twice", b"1"), ("twice", b"1"), ("empty", b""))
    delta = cd.delta_by_content(before, now)
    assert rows(delta.select("files", "status")) == sorted(
        [("same", "same"), ("longer", "changed"), ("edited", "changed"), ("gone", "gone"), ("new", "new"), ("unread", "unread"), ("twice", "same"), ("empty", "same")],
        key=repr,
    )
    claims = spark.createDataFrame([("same", "Changed"), ("edited", "Changed"), ("new", "New"), ("longer", "New"), ("unread", "New")], "Object_name string, `new/changed` string")
    got = {r.files: (r.claim, r.agrees) for r in cd.checked_claims(delta, claims).collect()}
    assert got == {
        "same": ("Changed", False), "edited": ("Changed", True), "new": ("New", True), "longer": ("New", False), "gone": (None, True),
        "twice": (None, True), "empty": (None, True), "unread": ("New", None),
    }
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "content" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_rounds_follow_the_longest_chain_and_cycle_not_the_number_of_objects(spark, monkeypatch):
    links = [(f"n{i:05}", f"n{i + 1:05}" if i % 4 else None) for i in range(3000)] + [("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("t1", "r2"), ("t2", "t1")]
    written, kept = [], ln.snapshot
    monkeypatch.setattr(ln, "snapshot", lambda df, name: written.append(name) or kept(df, name))
    found = rows(ln.lineage(spark.createDataFrame(links, LINKS)))
    assert found == plain(links)[0]
    assert len(written) <= 8
    # a cycle that is longer than every chain, entered by a tail that is longer still
    ring = [(f"c{i:03}", f"c{(i + 1) % 90:03}") for i in range(90)] + [(f"w{i:03}", f"w{i + 1:03}" if i < 199 else "c040") for i in range(200)]
    assert rows(ln.lineage(spark.createDataFrame([*ring, ("a", "b")], LINKS))) == plain([*ring, ("a", "b")])[0]
