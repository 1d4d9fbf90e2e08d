"""Revisits against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from fundflow.llm import revisits

SCHEMA = "record_id long, kind string, url string, at long, status int, headers map<string,string>, digest string, chunk string"


@pytest.mark.parametrize("url,want", [
    ("HTTP://WWW.Example.COM:80", "http://www.example.com/"), ("https://e.org:443/A?b=2&a=1#f", "https://e.org/A?a=1&b=2"),
    ("https://e.org:80/", "https://e.org:80/"), ("http://e.org/x?utm_source=a&&q=1&utm_medium=b", "http://e.org/x?q=1"),
    ("http://e.org/x?utm_source=a", "http://e.org/x"), ("mailto:x@y", "mailto:x@y"), ("", ""), (None, None),
    ("http://e.org?z=1", "http://e.org/?z=1"), ("http://e.org/#a?b", "http://e.org/")])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(F.expr(revisits.canonical_url("url"))).first()[0] == want


def brute(records):
    out = []
    for rid, kind, url, at, _, headers, digest, _ in records:
        if kind != "revisit":
            continue
        earlier = [r for r in records if r[1] == "response" and r[4] == 200 and r[2] == url is not None and None not in (r[3], at) and r[3] < at]
        if not earlier:
            out.append((rid, None, "no_response", None, None))
            continue
        base = max(earlier, key=lambda r: (r[3], r[0]))
        h, b = ({k.lower(): v for k, v in (x or {}).items()} for x in (headers, base[5]))
        tag = lambda x: x.get("etag", "").removeprefix("W/") or None
        pairs = [(digest, base[6]), (tag(h), tag(b)), (h.get("last-modified"), b.get("last-modified"))]
        pairs = [p for p in pairs if None not in p]
        outcome = "mismatch" if any(x != y for x, y in pairs) else "resolved" if pairs else "unvalidated"
        merged = {**b, **{k: v for k, v in h.items() if k not in revisits.NOT_PERMITTED}}
        out.append((rid, base[0], outcome, merged if outcome == "resolved" else None, base[6] if outcome == "resolved" else None))
    return out


def archive(n, seed):
    rng = random.Random(seed)
    records = []
    for i in range(n):
        url = "http://hot.org/" if rng.random() < 0.4 else rng.choice(["http://a.org/x", "http://b.org/?q=1", None])
        kind = rng.choice(["response", "revisit"])
        headers = rng.choice([None, {}, {"ETag": rng.choice(['"1"', 'W/"1"', '"2"']), "Content-Length": str(i), "X-A": str(i)},
                              {"Last-Modified": rng.choice(["m", "n"]), "Content-Type": "t", "Date": str(i)}])
        records.append((i, kind, url, rng.choice([None] + list(range(60))), rng.choice([200, 200, 200, 404]) if kind == "response" else 304,
                        headers, rng.choice([None, "d1", "d2"]), "x"))
    return records


@pytest.mark.parametrize("chunk", [1, 7, 86_400])
def test_as_brute_force(spark, chunk):
    records = archive(300, chunk)
    df = spark.createDataFrame(records, SCHEMA)
    got = [(r.record_id, r.base_id, r.outcome, r.headers, r.digest) for r in revisits.resolve(df, chunk).collect()]
    assert sorted(got, key=lambda r: r[0]) == brute(records)


def test_headers_that_clash_and_repeated_rows(spark):
    rows = [(1, "response", "http://a.org/", 1, 200, {"ETag": "1", "etag": "2"}, None, "x"),
            (2, "revisit", "http://a.org/", 5, 304, {"ETag": "1"}, None, "x"), (2, "revisit", "http://a.org/", 5, 304, {"ETag": "1"}, None, "x")]
    got = revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.record_id, r.base_id, r.outcome) for r in got] == [(2, 1, "resolved")] * 2


def test_empty(spark):
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
