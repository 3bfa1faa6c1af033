"""Base spans against a brute-force reading of the patterns, and the weak supervision."""

import hashlib
import random
import re
import time

import regex

from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.llm import pii
from docpipe.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [
        (kind, m.start(), m.end()) for kind in pii.KINDS for m in re.finditer(PATTERNS[kind], text or "") if holds(kind, m.group())
    ]


TEXTS = [
    None, "", "a@b.c_d@e.f", "a@b.c.@x.y zz@zz", "x a@b.c,b@c.d;@a.b", "1.2.3.4.5.6.7.8", "300.1.1.1 0255.1.1.1 1.2.3", "é😀 8.8.8.8",
    "4111 1111 1111 1111", "4111111111111111 4111-1111-1111-1112", "+1 (377) 555-0271 +49 30 1234567.", "+1+2 345 678 99 +", "+12345678901234567",
    "9" * 30_000, "1 " * 20_000, "a" * 50_000 + "@", "a.a@" + "b." * 20_000 + "c", "+1" + " " * 20_000 + "234567", "1.1.1.1 " * 700,
    "a\nb@c.de\n4012888888881881\n",
]


def window(text, s, e):
    return text[max(0, s - pii.BEFORE):s], text[e:e + pii.AFTER]


def brute_votes(kind, text, s, e, known):
    """The labelers, read off their definitions."""
    value, (left, right) = text[s:e], window(text, s, e)
    digits = re.sub("[^0-9]", "", value)
    near = lambda p: bool(re.search(p, left, re.A) or re.search(p, right, re.A))
    word = {"email": r"[A-Za-z0-9-]+$", "ip": "^[0-9A-Fa-f]+"}
    if kind in word:
        entries = {re.search(word[kind], value).group().lower()}
    elif kind == "secret":
        entries = {value[:4]}
    elif kind == "phone" and re.match(r"\(?[2-9][0-8][0-9]", value):
        entries = {"1"}
    else:
        plain = re.sub("[^0-9]", "", value[2:] if value.startswith("00") else value)
        entries = {plain[:n] for n in ((1, 2) if kind == "phone" else (1, 2, 3, 4))}
    listed = 1 if entries & set(known[kind]) else (0 if kind == "secret" else -1)
    glued = re.search(r"[^\W_]$", left) or re.match(r"[^\W_]", right)
    if kind == "email":
        shape = 1 if re.fullmatch(r"[A-Za-z0-9].*[A-Za-z]", value) else -1
    elif kind == "ip":
        shape = -1 if re.search(r"(^|[^0-9A-Fa-f])0[0-9]", value) or re.search("[3-9][0-9]{2}[^0-9A-Fa-f:]", value) else 1
    elif kind == "card":
        shape = 1 if 12 <= len(digits) <= 19 and luhn(digits) else -1
    elif kind == "phone":
        shape = 1 if re.fullmatch(r"[^()]*(\([0-9]+\)[^()]*)*", value) and 8 <= len(digits) <= 15 else -1
    elif re.search("[0-9].*[0-9]", value) and re.search("[A-Za-z].*[A-Za-z]", value) and len(value) >= 12:
        shape = 1
    else:
        shape = -1 if re.fullmatch("[a-z]*", value) else 0
    return [listed, int(near(pii.NEAR[kind])), -1 if near(pii.AGAINST) else 0, -1 if glued else 1, shape]


def brute_added(text, model):
    """Proposed spans free of base spans that the model's weights accept."""
    base, out = brute(text), []
    for kind in pii.ALL_KINDS:
        for m in regex.finditer(pii.PROPOSED[kind], text or ""):
            s, e = m.span()
            if kind == "secret":
                s = e - len(regex.search(pii.SECRET + "$", m.group()).group())
            if any(b < e and s < a for _, b, a in base) or kind not in model.weights:
                continue
            value, (left, _) = text[s:e], window(text, s, e)
            features = [len(re.sub("[^0-9]", "", value)) >= 10, re.search(r"[0-9][\x20-][0-9]", value), re.search(r"[(\[]", value),
                        left == "" or re.search(r"\n[ \t\n\x0b\f\r]*$", left)]
            inputs = [1, *brute_votes(kind, text, s, e, model.known), *[1 if f else 0 for f in features]]
            if sum(a * b for a, b in zip(inputs, model.weights[kind])) > 0:
                out.append((kind, s, e))
    return out


def spans_of(spark, texts, model=None):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    out = pii.spans(pii.found(docs), model or pii.Model())
    return {
        r.row.doc_id: ([(pii.KINDS[s.k], s.s, s.e) for s in r.base], [(pii.ALL_KINDS[s.k], s.s, s.e) for s in r.spans]) for r in out.collect()
    }


def test_base_spans_equal_the_plain_patterns(spark):
    got = spans_of(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        assert got[i][0] == brute(text), repr((text or "")[:60])


ALPHABET = st.text(alphabet="a.@-_+1234 ()é5\n", max_size=40)


@settings(max_examples=8, deadline=None)
@given(st.lists(ALPHABET, min_size=150, max_size=150))
def test_base_spans_of_random_texts(spark, texts):
    got = spans_of(spark, texts)
    assert all(got[i][0] == brute(t) for i, t in enumerate(texts))


def test_digest_and_counts_over_the_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = QUERIES["op2_pii_weak_supervision"](spark, sf_dir).collect()
    assert len(out) == len(docs)
    for r in out:
        base = brute(docs[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))


def test_labelers_that_agree_are_found_reliable_and_good_proposals_join(spark):
    texts = [f"call me at +1 (212) 555-{i:04d} or by phone (212) 555-{i:04d} now" for i in range(60)]
    texts += [f"order {i}212 555 {i:04d}9 of invoice 345-555-{i:04d}x" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    candidates = pii.found(docs)
    model = pii.fit(candidates)
    assert model.reliability["phone"]["whole"] > 0.9
    got = spans_of(spark, texts, model)
    added = {i: [s for s in all_ if s not in base] for i, (base, all_) in got.items()}
    assert all(len(added[i]) == 1 for i in range(60))
    assert not any(added[i] for i in range(60, 120))


def test_windows_reach_over_neighbouring_matches(spark):
    texts = [
        "call 555-123-4567 or 555-987-6543", "+1 234 567 8901+1 234 567 8902", "1.1.1.1 " * 700, "é😀" * 300 + " 8.8.8.8 9 8.8.4.4,a@b.cd" * 40,
        *["x" * n + " 8.8.8.8" + "y" * 30 for n in (240, 247, 248, 255, 256, 290, 504)], "8.8.8.8", " " * 249 + "8.8.8.8", None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n = 0
    for r in pii.found(docs).collect():
        text = texts[r.row.doc_id]
        for s in [*r.base, *r.proposed]:
            n += 1
            assert (s.value, s.left, s.right) == (text[s.s:s.e], text[max(0, s.s - pii.BEFORE):s.s], text[s.e:s.e + pii.AFTER])
    assert n > 800


def test_redaction_keeps_other_columns_and_rows(spark):
    rows = [(1, "mail a@b.cd, 8.8.8.8", "k"), (1, "mail a@b.cd, 8.8.8.8", "k"), (2, None, None), (None, "", "z"), (4, "😀 +1 234 567 890é", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = pii.redacted(docs, pii.fit(pii.found(docs)))
    assert out.columns == docs.columns
    assert sorted(out.collect(), key=str) == sorted(
        [(1, "mail [EMAIL], [IP]", "k"), (1, "mail [EMAIL], [IP]", "k"), (2, None, None), (None, "", "z"), (4, "😀 [PHONE]é", "s")], key=str
    )
    empty = docs.limit(0)
    assert pii.redacted(empty, pii.fit(pii.found(empty))).count() == 0


def labelled_lines():
    """200 lines, each with the personal data beyond the base patterns that it holds, or none."""
    random.seed(4)
    number = lambda n: "".join(random.choices("0123456789", k=n))
    hexes = lambda n: "".join(random.choices("0123456789abcdef", k=n))
    lines = []
    for i in range(20):
        name, phone = f"jo{number(2)}.doe", f"({random.randint(2, 9)}{random.randint(0, 8)}{number(1)}) {number(3)}-{number(4)}"
        secret, plain = hexes(40), f"Xk{number(4)}{hexes(8)}Z"
        lines += [
            (f"write to {name} [at] mail [dot] com for more", [("email", f"{name} [at] mail [dot] com")]),
            (f"contact {name} at firma dot de today", [("email", f"{name} at firma dot de")]),
            (f"please call {phone} after six", [("phone", phone)]),
            (f'config token = "{secret}" end', [("secret", secret)]),
            (f"password: {plain}, then log on", [("secret", plain)]),
            (f"server 10[.]1[.]{random.randint(1, 250)}[.]7 is up", [("ip", None)]),
            (f"invoice {number(3)}-{number(3)}-{number(4)}x of section {i}", []),
            (f"your token = changemeplease is a placeholder {i}", []),
            (f"order no 00{number(3)} was sent at noon, isbn {number(3)}.{number(3)}.{number(4)}7", []),
            (f"the key: of the matter {i} is version {i}.{i}.{i}", []),
        ]
    return lines


def test_added_spans_on_labelled_lines(spark):
    lines = labelled_lines()
    texts = [t for t, _ in lines]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.fit(pii.found(docs))
    got = spans_of(spark, texts, model)
    right = wrong = missed = 0
    for i, (text, truth) in enumerate(lines):
        added = [s for s in got[i][1] if s not in got[i][0]]
        for kind, value in truth:
            hit = [s for s in added if s[0] == kind and (value is None or text[s[1]:s[2]] == value)]
            right, missed = right + bool(hit), missed + (not hit)
        wrong += len(added) - sum(any(s[0] == k for s in added) for k, _ in truth)
    assert right / (right + missed) >= 0.9 and right / (right + wrong) >= 0.9, (right, wrong, missed)


def test_added_spans_equal_brute_force(spark, sf_dir):
    texts = [t for t, _ in labelled_lines()] + [
        None, "", "token=abc", 'token="abcdefgh" password : "x.y.z.1234567890=="', "api_key=\nABCDEFGH12345678", "x=12345678901 key = 12345678",
        "a [at] b [dot] c.de a@b.cd [at] c.de", "4111.1111.1111.1111 4111 1111 1111 1111 3782 822463 10005", "00 49 30 00 49 30 1234 567 (212) 555-1234 8.8.8.8",
        "+1 (212) 555-1234 (212) 555-1234", "fe80:0:0:0:1:2:3:4 1[dot]2[dot]3[dot]4 1.2.3.4[.]5",
    ]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.fit(pii.found(docs))
    got = spans_of(spark, texts, model)
    n = 0
    for i, text in enumerate(texts):
        added = sorted(set(got[i][1]) - set(got[i][0]))
        assert added == sorted(set(brute_added(text, model)) - set(got[i][0])), text[:200]
        n += len(added)
    assert n > 130


def test_secrets_of_the_whole_table_are_added(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = {r.doc_id: r.spans for r in QUERIES["op2_pii_weak_supervision"](spark, sf_dir).collect()}
    with_secret = [(i, m) for i, t in docs.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t or "")]
    assert len(with_secret) > 5
    assert all(f"secret:{m.start(1)}:{m.end(1)}" in out[i].split(",") for i, m in with_secret)


def test_a_megabyte_of_spans(spark):
    text = "8.8.8.8 (212) 555-1234 " * 45_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    r = pii.found(docs).selectExpr("size(base) AS b", "size(proposed) AS p").first()
    assert (r.b, r.p) == (45_000, 45_000)
    found = time.perf_counter()
    clean = pii.redacted(docs, pii.Model({"phone": [1.0] + [0.0] * 9})).first().text
    assert clean == "[IP] [PHONE] " * 45_000
    assert found - start < 20 and time.perf_counter() - found < 40


def test_gazetteer_tables_replace_the_entries(spark):
    known = pii.gazetteer(spark.createDataFrame([("email", "museum"), ("email", None), (None, "x")], "kind string, entry string"))
    assert known["email"] == ("museum",) and known["card"] == pii.GAZETTEER["card"]
    many = spark.range(pii.MOST_ENTRIES + 1).selectExpr("'email' AS kind", "string(id) AS entry")
    try:
        pii.gazetteer(many)
        raise AssertionError("not refused")
    except ValueError:
        pass
