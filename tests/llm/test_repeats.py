"""Repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from fundflow.llm import bwt_dedup

SCHEMA = "doc_id long, text string, spans int, extra string"


def brute(rows, length):
    """(doc_id, n_bytes, n_removed, spans, kept_sha256, kept) by row; rows of one id and text are one document,
    several texts of one id in the order of their hashes."""
    def key(r):
        h = xxhash.xxh64_intdigest((r[1] or "").encode(), 42)
        return (-2 ** 63 if r[0] is None else r[0], h - 2 ** 64 if h >= 2 ** 63 else h)

    first = {}
    for i, t in sorted(set(rows), key=key):
        raw = (t or "").encode()
        for a in range(len(raw) - length + 1):
            first.setdefault(raw[a:a + length], (key((i, t)), a))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - length + 1):
            if first[raw[a:a + length]] != (key((i, t)), a):
                gone[a:a + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.int8), [0]])))
        out.append((i, len(raw), sum(gone), len(edges) // 2, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [rng.choice("abcdé漢") * rng.randrange(1, 4) + str(rng.randrange(40)) for _ in range(60)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passages = [text(25) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(30)
            parts += [p[a:len(p) - rng.randrange(30)], text(rng.randrange(20))]
        rows.append((i, rng.choice(["", " "]).join(parts)))
    rows += [(100 + j, rows[j][1]) for j in range(5)]
    rows += [(200, "ab" * 300), (201, "Orre " * 100 + "x" + "Orre " * 60), (202, "a" * 99), (203, "a" * 100), (204, "a" * 101),
             (205, None), (206, ""), (None, rows[3][1]), (7, rows[7][1]), (207, "\x00" * 150), (208, "x\x00" * 75), (209, passages[0] * 3)]
    return rows


@pytest.mark.parametrize("seed,small", [(1, False), (2, True)])
def test_as_brute_force(spark, monkeypatch, seed, small):
    if small:  # many groups, hot anchors in several groups, texts anchored in parts
        for name, value in (("GROUP", 5), ("HOT", 4), ("BLOCK", 60)):
            monkeypatch.setattr(bwt_dedup, name, value)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "e") for i, t in rows], SCHEMA)
    got = bwt_dedup.remove_repeats(df, with_text=True)
    assert got.columns == ["doc_id", "text", "extra", *bwt_dedup.RESULT]
    have = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept_text) for r in got.collect()]
    assert sorted(map(str, have)) == sorted(map(str, brute(rows, 100)))


@pytest.mark.parametrize("small", [False, True])
def test_several_texts_of_one_id(spark, monkeypatch, small):
    """A common header at the start of texts that share an id (or have none) goes from all but one of them."""
    if small:
        for name, value in (("GROUP", 5), ("HOT", 4), ("BLOCK", 60)):
            monkeypatch.setattr(bwt_dedup, name, value)
    rng = random.Random(7)
    body = lambda: " ".join(str(rng.randrange(10 ** 6)) for _ in range(30))
    header = " ".join(body() for _ in range(5))
    rows = [(1, header + body()), (1, header + body()), (1, body() + header + body()), (None, header + body()), (None, header[40:] + body()),
            (2, header), (2, header), (1, body()), (3, "x" + header + body())]
    df = spark.createDataFrame([(i, t, 1, "e") for i, t in rows], SCHEMA)
    have = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept_text)
            for r in bwt_dedup.remove_repeats(df, with_text=True).collect()]
    want = brute(rows, 100)
    assert sorted(map(str, have)) == sorted(map(str, want))
    assert sum(header in r[5] for r in want) == 1


def test_merged_transforms_sort_suffixes():
    """The refined interleave is the order of all suffixes by their first symbols."""
    rng = random.Random(3)
    regions = [bytes(rng.choices(b"abc", k=rng.randrange(30, 90))) + bytes(rng.choices(b"abc", k=7)) * 9 for _ in range(40)]
    s = bwt_dedup.Symbols(regions)
    shards = [s.transform(a, min(a + 7, 40)) for a in range(0, 40, 7)]
    order, block = s.merged(shards, 3)
    assert sorted(order.tolist()) == list(range(len(order)))
    place = [(r, i) for r, x in enumerate(regions) for i in range(len(x) + 1)]
    whole = [(b, regions[place[o][0]][place[o][1]:][:30]) for o, b in zip(order, block, strict=True)
             if len(regions[place[o][0]]) - place[o][1] >= 30]
    assert [x for _, x in whole] == sorted(x for _, x in whole)
    assert len({b for b, _ in whole}) == len({x for _, x in whole}) == len(set(whole))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert bwt_dedup.remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        bwt_dedup.repeats(none, length=55)
