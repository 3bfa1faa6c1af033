"""Personal data in text by weak supervision, in DataFrame functions only.

Base spans come from four fixed patterns and always stay. Looser patterns propose further
spans, free of base spans: spelled-out and bracketed addresses, numbers in other groupings, and secrets that follow a word such as
``token`` or ``password``, which are a kind of their own. For every span a few labelers vote yes, no or nothing: gazetteers,
words that stand near, what the span is glued to, and its shape. Expectation-maximisation over the votes of the whole corpus finds how
reliable each labeler is; its posteriors are the soft labels on which a logistic span
classifier is trained. Only proposed spans that the classifier accepts are added. Which pattern found a span is no witness.

Corpus statistics leave the tasks as counts per pattern of votes and features, of which there
are at most ``len(ALL_KINDS) * 3**5 * 2**4``, whatever the size of the corpus.

Defined cases: null text counts as empty. Offsets are code points, end exclusive. Rows are never merged, so repeated rows and ids each get
theirs; any further columns, whatever their names, travel in a struct. An empty table gives no rows and a model without weights, which adds nothing. Very
long texts are handled in one pass per pattern; lists of spans are merged by start in blocks, so no span is compared with every other.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")

# Fixed values of the contract, with possessive quantifiers and anchors that change no match
# but keep the matcher linear and off the stack on very long runs: a match can only begin where
# a run of its first characters does, or where the last match ended (\G).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for the pattern to be worth running; never wrong, only cheap.
HINT = {"email": "@", "ip": ".", "phone": "+"}

SECRET = r"(?=[A-Za-z0-9+/_~.-]{8})[A-Za-z0-9+/_~-]++(?:\.[A-Za-z0-9+/_~-]++)*+={0,2}+"
PROPOSED = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z0-9-]{1,63}+){1,8}+|\x20at\x20[A-Za-z0-9-]{1,63}+(?:\x20dot\x20[A-Za-z0-9-]{1,63}+){1,4}+)",
    "ip": r"(?<![0-9A-Fa-f:])(?:(?:[0-9A-Fa-f]{1,4}+:){7}[0-9A-Fa-f]{1,4}+|[0-9]{1,3}+(?:\x20?(?:[(\[]dot[)\]]|\[\.\])\x20?[0-9]{1,3}+){3})(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9+.(-])(?:3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}|[0-9]{4}(?:[./][0-9]{4}){3})(?![0-9./-])",
    "phone": r"(?<![0-9+.-])(?:\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|00[1-9][0-9]?\x20(?:[0-9]{2,4}[\x20-]){1,4}[0-9]{2,4})(?![0-9.-])",
    # the separator after such a word and the value; the span is the value alone
    "secret": r"[:=](?<=(?i:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth|credential)[\"']?\x20{0,2}[:=])\x20{0,2}[\"']?" + SECRET,
}

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Words that speak for and against a kind when they stand within the window.
BEFORE, AFTER = 40, 20
NEAR = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write to|reach)\b",
    "ip": r"(?i)\b(?:ip|ipv6|address|host|server|client|login)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|payment|billing)\b",
    "phone": r"(?i)\b(?:phone|call|tel|fax|mobile|cell|contact|ring)\b",
    "secret": r"(?i)\b(?:token|secret|password|passwd|pwd|key|auth|credential|bearer|login)\b",
}
AGAINST = r"(?i)\b(?:isbn|issn|version|release|section|order|invoice|serial|part no|sku|checksum|example only|placeholder|changeme|your|redacted)\b"
VOTES = ("known", "near", "against", "whole", "shape")
FEATURES = ("digits", "grouped", "bracket", "line_start")

# Common top-level domains; first parts of addresses in use; issuer ranges; country codes or their
# first two digits; prefixes that issuers of keys use.
GAZETTEER: dict[str, tuple[str, ...]] = {
    "email": (
        "com", "org", "net", "edu", "gov", "info", "io", "biz", "dev", "app", "eu", "de", "fr", "es", "uk", "it", "nl", "be", "ch", "at",
        "pl", "pt", "se", "no", "dk", "fi", "ie", "cz", "ru", "us", "ca", "mx", "br", "ar", "cl", "in", "cn", "jp", "kr", "au", "nz", "co", "za",
    ),
    "ip": (*map(str, range(1, 224)), "2001", "2400", "2600", "2a00", "2a01", "2a02", "2a03", "fe80", "fd00"),
    "card": ("4", *map(str, range(51, 56)), *map(str, range(23, 27)), "34", "37", "35", "36", "38", "6011", *map(str, range(644, 650)), "65", "62"),
    "phone": (
        "1", "7", *map(str, range(20, 28)), "29", *map(str, range(30, 70)), *map(str, range(80, 83)), "84", "85", "86", "88", *map(str, range(90, 100)),
    ),
    "secret": ("ghp_", "gho_", "xoxb", "xoxp", "AKIA", "ASIA", "AIza", "sk_l", "eyJh"),
}
MOST_ENTRIES = 5_000


def gazetteer(entries: DataFrame) -> dict[str, tuple[str, ...]]:
    """``kind, entry`` rows in place of the entries above for their kinds.

    Entries become literals of the plan, so a table of more than ``MOST_ENTRIES`` is refused.
    """
    rows = entries.select("kind", "entry").where("kind IS NOT NULL AND entry IS NOT NULL").distinct().limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"a gazetteer of more than {MOST_ENTRIES} entries")
    given: dict[str, list[str]] = defaultdict(list)
    for r in rows:
        given[r.kind].append(r.entry)
    return GAZETTEER | {kind: tuple(sorted(of)) for kind, of in given.items()}


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def base_holds(kind: str, value: Column) -> Column:
    """The conditions on a match beyond its pattern."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    digits = F.regexp_replace(value, r"[^0-9]++", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)


def running(values: Column, op=lambda a, b: a + b, zero: int = 0, block: int = 256) -> Column:
    """For each element ``zero`` and the elements before it, put together by ``op``, in blocks so that long arrays stay cheap.

    ``values`` must be a plain column of int: a lambda evaluates what it captures once per element. ``op`` is associative.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
    cut = F.transform(blocks, lambda b: F.slice(values, b * block + 1, F.lit(block)))

    def line(of: Column, first: Column) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("out"), first.cast("int").alias("at"))
        return F.aggregate(
            of, start,
            lambda acc, v: F.struct(F.concat(acc["out"], F.array(acc["at"])).alias("out"), op(acc["at"], v).alias("at")),
            lambda acc: acc["out"],
        )

    totals = F.transform(cut, lambda c: F.aggregate(c, F.lit(zero), lambda a, b: op(a, b)))
    return F.flatten(F.zip_with(cut, line(totals, F.lit(zero)), line))


def _length_of_both(hit: Column, gap: Column) -> Column:
    return F.length(hit) + F.length(gap)


def _holds(kind: str):
    return lambda span: base_holds(kind, span["value"])


SPAN = "array<struct<k:int,s:int,e:int,value:string>>"
PATTERNS = [*BASE.items(), *PROPOSED.items()]


def _matched(rows: DataFrame) -> DataFrame:
    """Spans of all patterns in the column ``whole``, one array each (``spans0``, ...).

    Matches come from one pass of the pattern and the text between them from a split; offsets
    are running sums of both. Each step is a column of its own, so nothing is evaluated twice.
    """
    numbers = range(len(PATTERNS))
    hits = []
    for i, (kind, pattern) in enumerate(PATTERNS):
        every = F.regexp_extract_all("whole", F.lit(pattern), 0)
        if pattern == BASE.get(kind) and kind in HINT:
            every = F.when(F.contains("whole", F.lit(HINT[kind])), every).otherwise(F.array().cast("array<string>"))
        hits.append(every.alias(f"hits{i}"))
    rows = rows.select("row", "whole", *hits)
    gaps = [F.when(F.size(f"hits{i}") > 0, F.split("whole", PATTERNS[i][1], -1)).alias(f"gaps{i}") for i in numbers]
    rows = rows.select("row", *[f"hits{i}" for i in numbers], *gaps)
    steps = [F.zip_with(f"hits{i}", F.slice(f"gaps{i}", 1, F.size(f"hits{i}")), _length_of_both).alias(f"steps{i}") for i in numbers]
    rows = rows.select("row", *[f"{c}{i}" for i in numbers for c in ("hits", "gaps")], *steps)

    def spans(i: int) -> Column:
        kind, n = PATTERNS[i][0], F.size(f"hits{i}")
        parts = F.arrays_zip(
            F.col(f"hits{i}").alias("hit"), F.slice(f"gaps{i}", 1, n).alias("left"), running(F.col(f"steps{i}")).alias("at"),
        )

        def span(p: Column) -> Column:
            end = p["at"] + F.length(p["left"]) + F.length(p["hit"])
            value = F.regexp_extract(p["hit"], SECRET + "$", 0) if kind == "secret" else p["hit"]
            return F.struct(F.lit(ALL_KINDS.index(kind)).alias("k"), (end - F.length(value)).alias("s"), end.alias("e"), value.alias("value"))

        return F.when(n > 0, F.transform(parts, span)).otherwise(F.array().cast(SPAN)).cast(SPAN).alias(f"spans{i}")

    return rows.select("row", *[spans(i) for i in numbers])


BLOCK_BITS = 8


def _blocks(text: Column) -> Column:
    """The text in pieces of 256 code points, so that a span late in a long text costs no more than an early one."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{1 << BLOCK_BITS}}}+"), 0)


def _cut(start: Column, end: Column) -> Column:
    """The text from start to end out of the column ``blocks``."""
    first, last = F.shiftright(start, BLOCK_BITS), F.shiftright(end, BLOCK_BITS)
    of = lambda n: F.coalesce(F.get("blocks", n), F.lit(""))
    inner = lambda n: n.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    within = F.substr(of(first), inner(start) + 1, end - start)
    over = F.concat(
        F.substr(of(first), inner(start) + 1, F.lit(1 << BLOCK_BITS)),
        F.array_join(F.slice("blocks", first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substr(of(last), F.lit(1), inner(end)),
    )
    return F.when(end <= start, "").when(first == last, within).otherwise(over)


def _with_window(span: Column) -> Column:
    """The span with the text that stands before and after it, other matches included."""
    return F.struct(
        *[span[c].alias(c) for c in ("k", "s", "e", "value")],
        _cut(F.greatest(span["s"] - BEFORE, F.lit(0)), span["s"]).alias("left"), _cut(span["e"], span["e"] + AFTER).alias("right"),
    )


FAR = 2**31 - 1


def _free(rows: DataFrame) -> DataFrame:
    """``row, base, proposed`` from ``row, base, loose``: loose spans that overlap no base span, from one merge by start."""
    event = lambda proposed: lambda s: F.struct(s["s"].alias("s"), F.lit(proposed).alias("p"), s["e"].alias("e"), s["k"].alias("k"), s["value"].alias("value"))
    both = (F.size("base") > 0) & (F.size("loose") > 0)
    events = F.when(both, F.array_sort(F.concat(F.transform("base", event(False)), F.transform("loose", event(True)))))
    rows = rows.select("row", "base", "loose", events.alias("events"))
    ends = F.transform("events", lambda e: F.when(e["p"], 0).otherwise(e["e"]))
    starts = F.transform(F.reverse("events"), lambda e: F.when(e["p"], FAR).otherwise(e["s"]))
    rows = rows.select("*", ends.alias("ends"), starts.alias("starts"))
    reached = running(F.col("ends"), F.greatest).alias("reached")
    ahead = F.reverse(running(F.col("starts"), F.least, FAR)).alias("ahead")
    rows = rows.select("row", "base", "loose", "events", reached, ahead)
    apart = F.filter(
        F.arrays_zip("events", "reached", "ahead"),
        lambda z: z["events"]["p"] & (z["reached"] <= z["events"]["s"]) & (z["ahead"] >= z["events"]["e"]),
    )
    spans_ = F.transform(apart, lambda z: F.struct(*[z["events"][c].alias(c) for c in ("k", "s", "e", "value")]))
    return rows.select("row", "base", F.coalesce(spans_, F.when(F.size("base") == 0, F.col("loose")).otherwise(F.array().cast(SPAN))).alias("proposed"))


def found(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the document), ``base`` (its base spans) and ``proposed`` (free of base spans)."""
    rows = docs.select(F.struct("*").alias("row"))
    rows = _matched(rows.select("row", F.coalesce(F.col(f"row.{text}"), F.lit("")).alias("whole")))
    n = len(KINDS)
    base = [F.filter(f"spans{i}", _holds(k)) for i, k in enumerate(KINDS)]
    rows = rows.select("row", F.concat(*base).alias("base"), F.concat(*[f"spans{i}" for i in range(n, len(PATTERNS))]).alias("loose"))
    rows = _free(rows)
    some = F.size("base") + F.size("proposed") > 0
    rows = rows.select("row", "base", "proposed", F.when(some, _blocks(F.col(f"row.{text}"))).alias("blocks"))
    return rows.select("row", *[F.transform(c, _with_window).alias(c) for c in ("base", "proposed")])


def _by_kind(span: Column, column) -> Column:
    out = F.lit(None)
    for i, kind in reversed(list(enumerate(ALL_KINDS))):
        out = F.when(span["k"] == i, column(kind)).otherwise(out)
    return out


def _looked_up(kind: str, value: Column) -> Column:
    """What of a span is looked up in the gazetteer of its kind."""
    if kind == "email":
        return F.array(F.lower(F.regexp_extract(value, r"[A-Za-z0-9-]+$", 0)))
    if kind == "ip":
        return F.array(F.lower(F.regexp_extract(value, r"^[0-9A-Fa-f]+", 0)))
    if kind == "secret":
        return F.array(F.substr(value, F.lit(1), F.lit(4)))
    digits = F.regexp_replace(value, r"^00|[^0-9]++", "")
    lead = F.array(*[F.substr(digits, F.lit(1), F.lit(n)) for n in ((1, 2) if kind == "phone" else (1, 2, 3, 4))])
    # a number of a national plan is looked up by the country that writes it so
    return F.when(value.rlike(r"^\(?[2-9][0-8][0-9]"), F.array(F.lit("1"))).otherwise(lead) if kind == "phone" else lead


def _shape(kind: str, value: Column) -> Column:
    """1 or -1: whether a span is built as its kind is; 0 where that cannot be said."""
    yes = lambda c: F.when(c, 1).otherwise(-1)
    if kind == "email":
        return yes(value.rlike(r"^[A-Za-z0-9].*[A-Za-z]$"))
    if kind == "ip":
        return yes(~value.rlike(r"(?:^|[^0-9A-Fa-f])0[0-9]") & ~value.rlike(r"[3-9][0-9]{2}[^0-9A-Fa-f:]"))
    digits = F.regexp_replace(value, r"[^0-9]++", "")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), yes(luhn(digits))).otherwise(-1)
    if kind == "phone":
        return yes(value.rlike(r"^[^()]*(?:\([0-9]+\)[^()]*)*$") & F.length(digits).between(8, 15))
    mixed = value.rlike(r"[0-9].*[0-9]") & value.rlike(r"[A-Za-z].*[A-Za-z]")
    return F.when(mixed & (F.length(value) >= 12), 1).when(~value.rlike(r"[^a-z]"), -1).otherwise(0)


def votes(span: Column, known: dict[str, tuple[str, ...]] = GAZETTEER) -> list[Column]:
    """One of 1, -1, 0 (no opinion) per labeler, in the order of ``VOTES``."""
    value, left, right = span["value"], span["left"], span["right"]
    yes = lambda c, other=0: F.when(c, 1).otherwise(other)
    listed = lambda k: F.arrays_overlap(F.split(F.lit(" ".join(known[k])), " "), _looked_up(k, value))
    return [
        _by_kind(span, lambda k: yes(listed(k), 0 if k == "secret" else -1)),
        _by_kind(span, lambda k: yes(left.rlike(NEAR[k]) | right.rlike(NEAR[k]))),
        F.when(left.rlike(AGAINST) | right.rlike(AGAINST), -1).otherwise(0),
        # a span that is glued to more letters or digits is probably part of something else
        yes(~left.rlike(r"[\p{L}\p{N}]$") & ~right.rlike(r"^[\p{L}\p{N}]"), -1),
        _by_kind(span, lambda k: _shape(k, value)),
    ]


def features(span: Column) -> list[Column]:
    """What the classifier sees beside the votes, 0 or 1 each, in the order of ``FEATURES``."""
    value = span["value"]
    return [
        (F.length(F.regexp_replace(value, r"[^0-9]++", "")) >= 10).cast("int"),
        value.rlike(r"[0-9][\x20-][0-9]").cast("int"),
        value.rlike(r"[(\[]").cast("int"),
        (span["left"].rlike(r"\n\s*$") | (span["left"] == "")).cast("int"),
    ]


@dataclass
class Model:
    """Weights of the span classifier per kind, the labelers' fitted reliabilities, and the gazetteer they used."""

    weights: dict[str, list[float]] = field(default_factory=dict)
    reliability: dict[str, dict[str, float]] = field(default_factory=dict)
    known: dict[str, tuple[str, ...]] = field(default_factory=lambda: GAZETTEER)


def _expectation(patterns: dict[tuple[int, ...], float], rounds: int = 30) -> tuple[dict, list]:
    """Posterior per vote pattern, and P(vote | class) per labeler."""
    post = {}
    for v in patterns:
        post[v] = min(0.95, max(0.05, 0.5 + 0.15 * sum(v)))
    tables: list = []
    for _ in range(rounds):
        weight = [1.0, 1.0]
        tables = [[defaultdict(lambda: 1.0) for _ in range(2)] for _ in VOTES]
        for v, n in patterns.items():
            for y, p in ((1, post[v]), (0, 1 - post[v])):
                weight[y] += n * p
                for j, x in enumerate(v):
                    tables[j][y][x] += n * p
        for v in patterns:
            score = [math.log(weight[y]) + sum(math.log(tables[j][y][x] / (weight[y] + 2)) for j, x in enumerate(v)) for y in (0, 1)]
            post[v] = 1 / (1 + math.exp(max(-60.0, min(60.0, score[0] - score[1]))))
    return post, tables


def _inputs(v: tuple[int, ...], f: tuple[int, ...]) -> list[float]:
    return [1.0, *map(float, v), *map(float, f)]


def fit(candidates: DataFrame, known: dict[str, tuple[str, ...]] = GAZETTEER) -> Model:
    """Reliabilities and classifier from every span of the corpus, by counts per pattern.

    A kind without spans gets no weights, and nothing of that kind is added.
    """
    span = F.explode(F.concat("base", "proposed")).alias("span")
    spans = candidates.select(span)
    rows = spans.select(
        F.col("span.k").alias("k"), F.array(*votes(F.col("span"), known)).alias("v"), F.array(*features(F.col("span"))).alias("f")
    ).groupBy("k", "v", "f").count().collect()  # at most len(ALL_KINDS) * 3**5 * 2**4 rows
    model = Model(known=known)
    for k, kind in enumerate(ALL_KINDS):
        own = sorted((tuple(r["v"]), tuple(r["f"]), r["count"]) for r in rows if r["k"] == k)
        if not own:
            continue
        patterns: dict[tuple[int, ...], float] = defaultdict(float)
        for v, _, n in own:
            patterns[v] += n
        post, tables = _expectation(dict(patterns))
        total = sum(patterns.values())
        w = [0.0] * (1 + len(VOTES) + len(FEATURES))
        for step in range(300):
            slope = [0.01 * x for x in w]
            for v, f, n in own:
                x = _inputs(v, f)
                p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
                for j, a in enumerate(x):
                    slope[j] += n / total * (p - post[v]) * a
            w = [a - 0.5 * b for a, b in zip(w, slope)]
        model.weights[kind] = w
        model.reliability[kind] = {
            name: tables[j][1][1] / (tables[j][1][1] + tables[j][1][-1]) for j, name in enumerate(VOTES)
        }
    return model


def accepted(span: Column, model: Model) -> Column:
    """Whether the classifier takes a proposed span."""
    inputs = [F.lit(1), *votes(span, model.known), *features(span)]

    def score(kind: str) -> Column:
        if kind not in model.weights:
            return F.lit(-1.0)
        return sum((x * F.lit(w) for x, w in zip(inputs, model.weights[kind])), F.lit(0.0))

    return _by_kind(span, score) > 0


def spans(candidates: DataFrame, model: Model) -> DataFrame:
    """``row``, ``base`` and ``spans`` (base and added), each by kind and start."""
    added = F.filter("proposed", lambda s: accepted(s, model))
    order = lambda c: F.array_sort(F.transform(c, lambda s: F.struct(s["k"].alias("k"), s["s"].alias("s"), s["e"].alias("e"))))
    return candidates.select("row", order(F.col("base")).alias("base"), order(F.concat("base", added)).alias("spans"))


def joined(of: str) -> Column:
    """``kind:start:end`` of the spans, with commas."""
    names = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(
        F.transform(of, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["s"].cast("string"), s["e"].cast("string"))), ","
    )


def redacted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; other columns as they came.

    Of spans that overlap, the first names the kind and all of their text goes.
    """
    rows = spans(found(docs, text), model)
    whole = F.col(f"row.{text}")
    line = F.array_sort(F.transform("spans", lambda s: F.struct(s["s"].alias("s"), s["e"].alias("e"), s["k"].alias("k"))))
    rows = rows.select("row", line.alias("line"), F.when(F.size("spans") > 0, _blocks(whole)).alias("blocks"))
    rows = rows.select("*", F.transform("line", lambda s: s["e"]).alias("ends"))
    rows = rows.select("*", running(F.col("ends"), F.greatest).alias("reached"))
    # spans that begin where no earlier one reaches; the text between them stays
    heads = F.filter(F.arrays_zip("line", "reached"), lambda z: z["line"]["s"] >= z["reached"])
    rows = rows.select("row", "blocks", heads.alias("heads"), F.array_max("ends").alias("last"))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in ALL_KINDS])
    put = F.transform("heads", lambda z: F.concat(_cut(z["reached"], z["line"]["s"]), F.element_at(marks, z["line"]["k"] + 1)))
    rows = rows.select("row", put.alias("put"), _cut(F.col("last"), F.length(whole)).alias("tail"))
    clean = F.when(F.col("tail").isNotNull(), F.concat(F.array_join("put", ""), "tail")).otherwise(whole)
    return rows.select(F.col("row").withField(text, clean).alias("row")).select("row.*")
