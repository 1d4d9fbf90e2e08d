"""Secrets: fixed patterns against brute force, Markov models on held-out strings."""

import hashlib
import random
import re
import string

import pytest

from fundflow.llm import secret_scan

SCHEMA = "doc_id long, text string, found string"


@pytest.fixture(scope="module")
def weights(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return secret_scan.train(secret_scan.labelled_samples(docs))


def base(text):
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans(spark, weights):
    h = hashlib.sha1(b"x").hexdigest()
    texts = [None, "", f'é🙂 token = "{h}" {h}', "token=token: abcdefgh", "PASSWORD:'x' secret = sixsix api_key=a.b-c_d", "AKIA" + "A" * 15,
             "xAKIAAKIA" + "B7" * 8 + "c", "apikey = " + h[:24] + " token:" + h[:5], h[:23] + "g" + h[:24], ("token=" + h + "\n") * 300,
             "a" * 40_000, "passwd==abcdef token\n=abcdef"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[2], "x"), (None, texts[2], "x")], SCHEMA)
    scanned = secret_scan.scan(df, weights)
    rows = secret_scan.digest(scanned).collect()
    assert len(rows) == len(texts) + 2
    found = {r.doc_id: r.found for r in scanned.where("doc_id > 0").collect()}
    for r in rows:
        text = texts[2] if r.doc_id in (None, 0) and r.n_hex else texts[r.doc_id]
        want = base(text)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[3] == k for x in want) for k in ("assign", "access", "hex")]
        spans = [s.split(":") for s in r.spans.split(",")] if r.spans else []
        assert [s for s in spans if s[0] != "markov"] == [[k, str(a), str(b)] for a, _, b, k in want]
    for i, spans in found.items():
        for s in spans:
            if s.kind == "assign":
                assert texts[i][s.start:s.end].endswith(s.value)
            else:
                assert texts[i][s.start:s.end] == s.value


def test_models_tell_held_out_strings(spark, weights):
    rng = random.Random(1)
    random_ = ["".join(rng.choices(string.ascii_letters + string.digits, k=rng.randrange(24, 60))) for _ in range(200)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = [w for r in docs.where("doc_id >= 200").limit(300).collect() for w in re.findall("[A-Za-z]{4,}", r.text)]
    ordinary = ["_".join(rng.choices(words, k=4)) if i % 2 else "".join(w.title() for w in rng.choices(words, k=4)) for i in range(400)]
    df = spark.createDataFrame([(i, f"see {s} here", "") for i, s in enumerate(random_ + ordinary)], SCHEMA)
    hit = {r.doc_id for r in secret_scan.digest(secret_scan.scan(df, weights)).where("n_markov > 0").collect()}
    assert len([i for i in hit if i < 200]) >= 195
    assert len([i for i in hit if i >= 200]) <= 4


def test_added_spans_leave_base_ones(spark, weights):
    secret = "x9Kf02LmQzR7pTa4VbNc81YdWe"
    df = spark.createDataFrame([(1, f"token={secret} and {secret}", "")], SCHEMA)
    spans = secret_scan.scan(df, weights).first().found
    assert [(s.kind, s.start) for s in spans] == [("assign", 0), ("markov", 37)]


def test_joined_hyphenated_and_short_keys(spark, weights):
    rng = random.Random(2)
    plain, safe = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "-_"
    names = ["service_account_authorization=", "database_connection_credential=", "var/lib/application/", "signing_material_"]
    cases = {}
    for k in range(100):
        cases["short", k] = ("", "".join(rng.choices(plain, k=16)), "")
        cases["safe", k] = ("", "".join(rng.choices(safe, k=20 if k % 2 else 32)), "")
        for n, name in enumerate(names):
            cases[n, k] = (name, "".join(rng.choices(plain, k=20)), "/settings" if k % 2 else "")
    keys = list(cases)
    df = spark.createDataFrame([(i, "see {}{}{} here".format(*cases[c]), "") for i, c in enumerate(keys)], SCHEMA)
    hit = dict.fromkeys(["short", "safe", 0, 1, 2, 3], 0)
    for r in secret_scan.scan(df, weights).collect():
        name, secret, _ = cases[keys[r.doc_id]]
        at = 4 + len(name)
        spans = [s for s in r.found if s.kind == "markov" and s.start < at + len(secret) and at < s.end]
        covered = {i for s in spans for i in range(s.start, s.end)} & set(range(at, at + len(secret)))
        hit[keys[r.doc_id][0]] += len(covered) >= len(secret) - 3
    assert all(n >= 95 for n in hit.values()), hit


def test_each_key_of_a_run(spark, weights):
    one, two = "x9Kf02LmQzR7pTa4VbNc", "Zq81YdWe5JtGh3XvB6uP"
    df = spark.createDataFrame([(1, f"é {one}/configuration_of_the_application/{two}", ""),
                                (2, "é " + hashlib.sha1(b"x").hexdigest() + f"/configuration_of_the_application/{two}", "")], SCHEMA)
    found = {r.doc_id: [(s.kind, s.value) for s in r.found] for r in secret_scan.scan(df, weights).collect()}
    # A span may take in the piece beside the key, not what follows it.
    assert [k for k, _ in found[1]] == ["markov"] * 2 and one in found[1][0][1] and two in found[1][1][1]
    assert found[2][0] == ("hex", hashlib.sha1(b"x").hexdigest()) and found[2][1][0] == "markov" and two in found[2][1][1]
    assert not any("of_the" in v for spans in found.values() for _, v in spans)


def test_ordinary_paths_and_numbers(spark, weights):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(3)
    words = [w for r in docs.where("doc_id >= 200").limit(300).collect() for w in re.findall("[A-Za-z]{4,}", r.text)]
    forms = ["/{}/{}/{}/{}", "{}-{}-{}-{}", "{}={}/{}_{}", "{}_{}_{}-20240312", "{}/2024/03/12/{}{}{}", "{}{}{}{}_000123"]
    texts = [forms[i % 6].format(*rng.choices(words, k=4)) for i in range(600)]
    df = spark.createDataFrame([(i, f"see {s} here", "") for i, s in enumerate(texts)], SCHEMA)
    assert secret_scan.digest(secret_scan.scan(df, weights)).where("n_markov > 0").count() <= 6


def test_empty(spark, weights):
    assert secret_scan.digest(secret_scan.scan(spark.createDataFrame([], SCHEMA), weights)).count() == 0
    assert set(secret_scan.train(spark.createDataFrame([], "sample string, random boolean"))) == {0.0}
