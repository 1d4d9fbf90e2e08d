"""Surrogates: detection, format, coreference, distinctness."""

import re

import pytest
from pyspark.sql import functions as F

from fundflow.llm import pii

SCHEMA = "doc_id long, text string, n_chars long, n_replaced string, mentions string"


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t, len(t or ""), "x", "y") for i, t in enumerate(texts)], SCHEMA)
    got = pii.pseudonymise(df, key)
    assert got.columns == ["doc_id", "text", "n_chars", "mentions", "n_replaced"]
    rows = {r.doc_id: r for r in got.collect()}
    return [rows[i] for i in range(len(texts))]


def test_formats(spark):
    texts = ["mail Ann.Lee99@mail5.example.com now", "call +1 (743) 555-3824.", "call 743-555-3824", "at 70.23.222.5, ok",
             "card 4111 1111 1111 1111!", "card 4111111111111111", "ssn 123-45-6789", "iban DE89 3704 0044 0532 0130 00 x",
             "Mrs. Anna SMITH and Mr Smith, Frau Smith", "Г-жа Анна Иванова", None, "", "nothing here 12 3.4 at@ 10.2.3",
             "ANN.LEE99@MAIL5.EXAMPLE.COM"]
    out = replaced(spark, texts)
    t = [r.text for r in out]
    assert [r.n_replaced for r in out] == [1] * 8 + [3, 1, 0, 0, 0, 1]
    m = re.fullmatch(r"mail ([a-z]{3}\.[a-z]{3}[0-9]{2}@[a-z]{4}[0-9]\.example\.com) now", t[0])
    assert m and "ann.lee" not in t[0].lower() and t[13] == m[1].upper()
    a = re.fullmatch(r"call \+1 \((\d{3})\) (\d{3})-(\d{4})\.", t[1])
    b = re.fullmatch(r"call (\d{3})-(\d{3})-(\d{4})", t[2])
    assert a.groups() == b.groups() != ("743", "555", "3824")
    assert re.fullmatch(r"at \d\d\.\d\d\.\d{3}\.\d, ok", t[3]) and t[3] != texts[3]
    assert all(int(x) < 256 for x in re.findall(r"\d+", t[3]))
    c = re.fullmatch(r"card (4\d{3}) (\d{4}) (\d{4}) (\d{4})!", t[4])
    assert luhn("".join(c.groups())) and t[5] == "card " + "".join(c.groups()) and t[5] != texts[5]
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4}", t[6]) and t[6] != texts[6]
    assert re.fullmatch(r"iban DE\d\d( \d{4}){4} \d\d x", t[7]) and t[7] != texts[7]
    n = re.fullmatch(r"Mrs\. ([A-Z][a-z]+na) ([A-Z]+) and Mr ([A-Z][a-z]+), Frau ([A-Z][a-z]+)", t[8])
    assert n and n[2].lower() == n[3].lower() == n[4].lower() != "smith"
    assert re.fullmatch(r"Г-жа [А-Я][а-я]+на [А-Я][а-я]+рова", t[9]) and t[9] != texts[9]
    assert t[10] is None and t[11:13] == texts[11:13]
    assert all(r.n_chars == len(r.text) for r in out if r.n_replaced)


def test_key_decides(spark):
    texts = ["a.b@c.example.org 10.20.30.40"]
    one, two = replaced(spark, texts, "k")[0].text, replaced(spark, texts, "l")[0].text
    assert one == replaced(spark, texts, "k")[0].text != two


def test_collisions_are_drawn_anew(spark):
    """Far more entities of a shape than chance keeps apart, one in very many documents."""
    ips = [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(6) for c in range(6) for d in range(6)]
    texts = [f"see {ip} or 1.1.1.1 twice {ip}" for ip in ips]
    out = replaced(spark, texts)
    by = {}
    for ip, r in zip(ips, out, strict=True):
        a, hot, b = re.fullmatch(r"see (\S+) or (\S+) twice (\S+)", r.text).groups()
        assert a == b
        by[ip] = a
        assert by.setdefault("1.1.1.1", hot) == hot
    assert len(set(by.values())) == len(by) and not set(by.values()) & set(by)


def test_names_stay_distinct(spark):
    names = [f"{a}{b}{c}" for a in "BCDFGHKLMN" for b in "aeiou" for c in ("rt", "st", "ll", "nn", "ck")]
    out = replaced(spark, [f"Mr {n}" for n in names] + [f"Ms {n} Lee" for n in names])
    assert len({r.text for r in out}) == 2 * len(names)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 2])
def test_none(spark, rows):
    got = pii.pseudonymise(spark.createDataFrame(rows, SCHEMA), "k")
    assert got.count() == len(rows)
    assert got.where(F.col("n_replaced") > 0).count() == 0


def test_repeated_rows_and_long_text(spark):
    long = "word " * 20_000 + "x@y.org " + "a" * 50_000 + " 1.2.3.4"
    df = spark.createDataFrame([(1, long, 1, "", ""), (1, long, 1, "", ""), (None, "x@y.org", 7, "", "")], SCHEMA)
    got = pii.pseudonymise(df, "k").collect()
    assert len(got) == 3 and sorted(r.n_replaced for r in got) == [1, 2, 2]
    short = next(r.text for r in got if r.doc_id is None)
    assert all(short in r.text and len(r.text) >= len(long) for r in got if r.doc_id)


def test_bare_mentions_of_names_in_the_same_text(spark):
    texts = ["Mr. John Smith called. Later John Smith left; Smith agreed, SMITH's car. johnsmith Smithy Johnson smith. Dr. Anna Weber came, Anna too.",
             "Smith alone, John too.", "Mrs Ann-Marie Lee-Roy and Ann-Marie, then Lee-Roy. Prof. Lee."]
    out = replaced(spark, texts)
    m = re.fullmatch(r"Mr\. (\w+n) (\w+r) called\. Later (\w+) (\w+) left; (\w+) agreed, ([A-Z]+)'s car\. johnsmith Smithy Johnson smith\. "
                     r"Dr\. (\w+na) (\w+r) came, (\w+) too\.", out[0].text)
    assert m and m[1] == m[3] != "John" and m[2] == m[4] == m[5] == m[6].capitalize() != "Smith"
    assert m[7] == m[9] != "Anna" and m[8] != "Weber" and out[0].n_replaced == 2 + 4 + 1
    assert out[1].text == texts[1] and out[1].n_replaced == 0  # no title in this text
    m = re.fullmatch(r"Mrs (\S+) (\S+) and (\S+), then (\S+)\. Prof\. (\w+)\.", out[2].text)
    assert m and m[1] == m[3] and m[2] == m[4] and m[5] not in ("Lee", m[2])


def test_ipv6(spark):
    texts = ["IP 2001:db8::8a2e:370:7334, and FE80::1.", "2001:0DB8:0000:0000:0000:ff00:0042:8329 ok", "std::vector 12:30:45 a::b :: x 1:2",
             "again 2001:DB8::8A2E:370:7334"]
    out = [r.text for r in replaced(spark, texts)]
    assert re.fullmatch(r"IP [0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]{4}, and [0-9A-F]{4}::[0-9A-F]\.", out[0]) and out[0] != texts[0]
    assert re.fullmatch(r"[0-9a-f]{4}(:[0-9a-f]{4}){7} ok", out[1]) and out[1] != texts[1]
    assert out[2] == texts[2] and out[3] == "again " + out[0].split()[1].rstrip(",").upper()


def test_as_brute_force(spark):
    """Detection and replacement by a plain reading of the patterns: same spans, one surrogate an entity, none shared."""
    import random
    rng = random.Random(6)
    names = ["Mr. Ian Stone", "Mrs Eva Stone", "Herr Braun", "Dr. Lena Fox"]
    pool = ["a.b@mail.example.org", "c-d@x.example.com", "10.20.30.40", "9.8.7.6", "743-555-3824", "+1 743 555 3824", "4111 1111 1111 1111",
            "123-45-6789", "DE89 3704 0044 0532 0130 00", "fe80::12:9", *names, "Stone", "Eva", "plain words", "x 12", "Braun,"]
    texts = [" ; ".join(rng.choices(pool, k=rng.randrange(1, 9))) for _ in range(120)]
    any_, token = re.compile(pii.ANY.replace("\\p{Lu}", "[A-ZÄÖÜ]").replace("\\p{L}", "[A-Za-zÄÖÜäöüß]")), re.compile("[A-Za-z]+")
    want, seen = [], {}
    for t in texts:
        spans = [m.span() for m in any_.finditer(t)]
        known = {w for a, b in spans for w in t[a:b].split()[1:] if re.match("(?:Mr|Mrs|Herr|Dr)", t[a:b])}
        gaps = list(zip([0] + [b for _, b in spans], [a for a, _ in spans] + [len(t)]))
        spans += [(a + m.start(), a + m.end()) for a, b in gaps for m in token.finditer(t[a:b]) if m[0] in known]
        want.append(sorted(spans))
    out = replaced(spark, texts)
    for t, spans, r in zip(texts, want, out):
        assert r.n_replaced == len(spans), t
        # What stands between the spans is unchanged, in order; what stands in them isn't.
        pattern = re.escape(t[:spans[0][0]]) + "".join(
            "(.+?)" + re.escape(t[b:c]) for (_, b), c in zip(spans, [a for a, _ in spans[1:]] + [len(t)])) if spans else re.escape(t)
        m = re.fullmatch(pattern, r.text, re.S)
        assert m, (t, r.text)
        for (a, b), new in zip(spans, m.groups()):
            assert new != t[a:b]
            if " " not in new or not re.match("(?:Mr|Mrs|Herr|Dr)", t[a:b]):
                assert seen.setdefault(t[a:b], new) == new
    assert len(set(seen.values())) == len(seen)
