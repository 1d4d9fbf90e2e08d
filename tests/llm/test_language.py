"""Nearest-centroid language identification."""

import random
import zlib

import numpy as np
import pytest

from fundflow.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int"
SYLLABLES = {"aa": ["ba", "no", "ti", "lu", "sha"], "bb": ["krz", "ost", "wer", "ung", "ich"], "cc": ["é", "eau", "ou", "ère", "ti"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def rows(seed=1, n=300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(["aa", "aa", "bb", "cc"])
        out.append((i, text(rng, lang, rng.randrange(3, 80)), lang, "s", 1))
    return out


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def table():
    return rows()


def test_counts_as_brute_force():
    for t in ("", "A", "Ab  c", "é漢 1 2 xX", "ab\U00010400c", "a" * 50):
        c = "".join(x if x.isalpha() else " " for x in t.lower())
        while "  " in c:
            c = c.replace("  ", " ")
        assert li.gram_counts(t).sum() == sum(max(0, len(c) - k + 1) for k in range(1, li.ORDERS + 1))


@pytest.mark.parametrize("part", [1, 2, 3, 7])
def test_long_texts_in_parts(monkeypatch, part):
    t = "".join(random.Random(2).choices("abé .1漢", k=200))
    want = li.gram_counts(t)
    monkeypatch.setattr(li, "PART", part)
    assert (li.gram_counts(t) == want).all()


def test_held_out_accuracy_and_edges(spark, table):
    odd = [(1000, None, "aa", None, None), (1001, "", "aa", None, None), (1002, "12 3.", "bb", None, None), (None, table[0][1], "bb", None, None),
           (1003, table[5][1], None, None, None), table[7], table[7], (1004, text(random.Random(3), "bb", 30_000), "bb", None, None)]
    df = spark.createDataFrame(table + odd, SCHEMA)
    out = li.identify(df)
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(table) + len(odd)
    by_id = {r.doc_id: r for r in got}
    lang = {r[0]: r[2] for r in table}
    assert all(r.held_out == held(r.doc_id) for r in got)
    tested = [i for i in lang if held(i)]
    assert len(tested) > 30 and np.mean([by_id[i].lang_pred == lang[i] for i in tested]) > 0.95
    for i in (1000, 1001, 1002):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0 and not by_id[i].rejected
    assert by_id[1003].lang_pred == lang[5] and by_id[1004].lang_pred == "bb"
    assert all(0 <= r.score <= 1 and r.lang_pred in {"und", *SYLLABLES} for r in got)


def test_language_and_source_are_no_inputs(spark, table):
    df = spark.createDataFrame(table, SCHEMA)
    model = li.train(df.select("text", "lang"))
    a = li.predict(df, model).collect()
    b = li.predict(df.selectExpr("-doc_id as doc_id", "text"), model).collect()
    assert [r[1:] for r in a] == [r[1:] for r in b]
    # Held-out labels change nothing.
    other = [(i, t, "zz" if held(i) else lang, s, v) for i, t, lang, s, v in table]
    assert [tuple(r) for r in li.identify(spark.createDataFrame(other, SCHEMA)).collect()] == [
        tuple(r) for r in li.identify(df).collect()]


def test_as_brute_force_nearest(spark, table):
    df = spark.createDataFrame(table, SCHEMA)
    model = li.train(df.select("text", "lang"), centroids=3, sample=50)
    assert [list(model.of).count(i) for i in range(3)] == [3, 3, 3]
    n, places = li.document_frequencies(df)
    assert n == len(table) and (places == sum((li.gram_counts(r[1]) > 0).astype(int) for r in table)).all()
    for r in li.predict(df, model).collect()[:40]:
        c = li.gram_counts(table[r.doc_id][1])
        v = np.sqrt(c / c.sum()) * model.idf
        cosine = model.centres @ v / np.sqrt(v @ v)
        assert r.lang_pred == model.languages[model.of[cosine.argmax()]] and r.score == pytest.approx(cosine.max(), abs=1e-5)


def test_rejects_what_is_like_no_language(spark, table):
    rng = random.Random(9)
    strange = [(5000 + i, "".join(rng.choices("qxjvwyzpfgdm ", k=400)), None, None, None) for i in range(20)]
    got = {r.doc_id: r.rejected for r in li.identify(spark.createDataFrame(table + strange, SCHEMA)).collect()}
    assert all(got[i] for i, *_ in strange) and np.mean([got[r[0]] for r in table]) < 0.03


def test_nothing_to_learn_from(spark):
    assert li.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    got = li.identify(spark.createDataFrame([(0, "abc", None, None, None)], SCHEMA)).first()
    assert (got.lang_pred, got.score, got.rejected) == ("und", 0, False)
    with pytest.raises(ValueError, match="languages"):
        li.MOST_LANGUAGES, most = 1, li.MOST_LANGUAGES
        try:
            li.train(spark.createDataFrame([("a b", "x"), ("c d", "y")], "text string, lang string"))
        finally:
            li.MOST_LANGUAGES = most
