"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import pytest

from fundflow.llm import collocations

SCHEMA = "doc_id long, text string, lang string, a int, phrase string"


def brute(rows, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    f = {p: c for p, c in f.items() if c >= least}
    longer = {}
    for (lang, ws), c in f.items():
        for i in range(len(ws)):
            for j in range(i + 1, len(ws) + 1):
                if j - i < len(ws):
                    longer[lang, ws[i:j]] = max(longer.get((lang, ws[i:j]), 0), c)
    out = []
    for (lang, ws), a in f.items():
        if len(ws) < 2 or longer.get((lang, ws), 0) >= a:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]])
                                    for k in range(1, len(ws)))
        out.append((lang, -score, -a, " ".join(ws).encode(), left, right))
    ranked, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "été", "漢", "x\x1cy", "a b", "É"] + [rng.choice("abcXYZ") * rng.randrange(1, 3) + str(i % 9) for i in range(25)]
    fixed = [[rng.choice(words) for _ in range(rng.randrange(2, 8))] for _ in range(6)]
    rows = []
    for i in range(400):
        out = []
        for _ in range(rng.randrange(40)):
            out += rng.choice(fixed) if rng.random() < 0.3 else [rng.choices(words, weights=[20, 10] + [1] * (len(words) - 2))[0]]
        text = "".join(w + rng.choice([" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\r", "\x0b"]) for w in out)
        rows.append((text, rng.choice(["en", "en", "en", "fr", None])))
    rows += [(None, "en"), ("", None), ("no no no " * 300, "fr"), ("The the THE tHe", "en"), (" ", "de"), rows[3], rows[3]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "p") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed,budget", [(1, 500_000), (2, 40), (3, 7)])
def test_as_brute_force(spark, seed, budget):
    # Small budgets: heavy prefixes of two, three and four words, and many groups.
    rows = corpus(seed)
    got = collocations.collocations(frame(spark, rows), least=10, budget=budget).collect()
    want = brute(rows, 10)
    assert len(want) > 50 and sorted(map(tuple, got)) == sorted(want)


def test_shorter_phrases_and_top(spark):
    rows = corpus(4)
    few = collocations.collocations(frame(spark, rows), least=10, longest=3, top=5)
    assert sorted(map(tuple, few.collect())) == sorted(brute(rows, 10, 3, 5))


def test_colliding_words_are_counted_again(spark, monkeypatch):
    rows, seeds, real = corpus(5), [], collocations._words

    def clashing(texts, least, seed):
        seeds.append(seed)
        return real(texts, least, seed).withColumn("clash", collocations.F.lit(seed < 2))

    monkeypatch.setattr(collocations, "_words", clashing)
    got = collocations.collocations(frame(spark, rows), least=10).collect()
    assert seeds == [0, 1, 2] and sorted(map(tuple, got)) == sorted(brute(rows, 10))


def test_nothing_frequent(spark):
    assert collocations.collocations(frame(spark, []).limit(0)).count() == 0
    assert collocations.collocations(frame(spark, [("a b c d", "en")])).count() == 0
    assert collocations.collocations(frame(spark, [("a. " * 200, "en")])).count() == 0


def test_groups_get_each_suffix_once(spark, monkeypatch):
    # However many tasks meet a suffix, its group gets one row with its count.
    found, real = [], collocations._nodes

    def seen(suffixes, *more):
        found.extend(suffixes.collect())
        return real(suffixes, *more)

    monkeypatch.setattr(collocations, "_nodes", seen)
    rows = corpus(6)
    got = collocations.collocations(frame(spark, rows), least=10).collect()
    words = [tuple(r)[:-1] for r in found]
    assert sorted(map(tuple, got)) == sorted(brute(rows, 10))
    assert max(r.n for r in found) > 1 and len(set(words)) == len(words)


def test_exact_beyond_64_bits(spark):
    big = spark.range(1).selectExpr("(cast(1000 * 900000000000 as decimal(18,0)) * cast(800000000000000 as decimal(18,0))) div "
                                    "(cast(900000000001 as decimal(18,0)) * cast(900000000007 as decimal(18,0))) as s")
    assert big.first().s == 1000 * 900000000000 * 800000000000000 // (900000000001 * 900000000007)
