"""Co-training on held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundflow.llm import cotraining

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    rows = []
    for fold in range(3):  # one fold alone has a dozen bad documents
        held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == fold
        model = cotraining.train(docs, labels.where(~held))
        rows += cotraining.score(docs, model).join(labels.where(held), "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert len(good) + len(bad) == labels.count() and len(bad) > 50
    assert sum(r.accepted for r in good) >= 0.97 * len(good)
    assert sum(not r.accepted for r in bad) >= 0.8 * len(bad)
    assert all(0 <= p <= 1 for r in rows for p in (r.p_content, r.p_metadata, r.p_quality))


def test_views_teach_each_other(spark, tables):
    """Rounds of exchanged labels: every round hands some over, and what is accepted stays as good."""
    docs, labels = tables
    known = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    rest = labels.join(known, "doc_id", "left_anti")

    def right(rounds):
        model = cotraining.train(docs, known, rounds=rounds)
        rows = cotraining.score(docs, model).join(rest, "doc_id").collect()
        return model, np.mean([r.accepted == (r.quality == 1) for r in rows])

    alone, taught = right(0), right(cotraining.ROUNDS)
    assert alone[0].handed == [] and len(taught[0].handed) == cotraining.ROUNDS and taught[0].handed[0] > 0
    assert taught[1] > alone[1] - 0.02 and taught[1] > 0.9


def test_parts_are_the_batch():
    import pyarrow as pa
    texts = ["a" * n for n in (0, 3_000_000, 10, 1_500_000, 600_000, 5)] + [None] * 2500
    batch = pa.RecordBatch.from_pydict({"text": texts, "i": list(range(len(texts)))})
    parts = list(cotraining._parts(batch))
    assert [i for p in parts for i in p["i"].to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p["text"].to_pylist()) <= cotraining.PART_BYTES for p in parts)
    assert max(p.num_rows for p in parts) <= cotraining.PART_ROWS


def test_pseudo_labels_come_from_all_documents(spark, tables, monkeypatch):
    """The surest documents are found wherever they are, and the number handed over is the bound's."""
    docs, labels = tables
    monkeypatch.setattr(cotraining, "HANDED", 10)
    monkeypatch.setattr(cotraining, "ROUNDS", 1)
    drawn = []
    teach = cotraining._teach

    def seen(views, label, rounds, hand):
        def hand_(models, good):
            drawn.append((models, good, hand(models, good)))
            return drawn[-1][2]
        return teach(views, label, rounds, hand_)

    monkeypatch.setattr(cotraining, "_teach", seen)
    model = cotraining.train(docs, labels, rounds=1)
    (models, good, new), = drawn
    rest = docs.join(labels.where("quality in (0, 1)"), "doc_id", "left_anti").toPandas().to_dict("list")
    features = cotraining._features(rest)
    assert model.handed == [len(new[0][1]) + len(new[1][1])] and 0 < model.handed[0] <= 20
    for i in range(2):
        logit = models[i].logit(features[i])
        for sign, value, most in zip((1, -1), (1.0, 0.0), cotraining._quotas(len(logit), good), strict=True):
            want = np.sort(sign * logit)[::-1][:most]
            views, given = new[1 - i]
            got = np.sort(sign * models[i].logit(views[i][given == value]))[::-1] if (given == value).any() else np.empty(0)
            np.testing.assert_allclose(got, want[want >= cotraining.SURE_LOGIT], rtol=1e-6)


def test_columns_rows_and_edges(spark, tables):
    docs, labels = tables
    model = cotraining.train(docs, labels)
    schema = "doc_id long, text string, lang string, source string, n_chars long, accepted string, other map<string,int>"
    rows = [(None, None, None, None, None, "x", {"a": 1}), (1, "", "", "", 0, None, None), (1, "", "", "", 0, None, None),
            (2, "word " * 50_000, "en", "src0", 1, "x", None), (3, "一" * 10, "zz", "new", -5, "x", {})]
    got = cotraining.score(spark.createDataFrame(rows, schema), model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "other", *cotraining.RESULT]
    assert got.count() == 5 and got.where("p_quality is null or isnan(p_quality)").count() == 0
    assert got.where("doc_id is null").first().other == {"a": 1}
    assert cotraining.score(spark.createDataFrame([], schema), model).count() == 0


@pytest.mark.parametrize("where", ["false", "quality = 1"])
def test_nothing_to_learn_from(spark, tables, where):
    docs, labels = tables
    model = cotraining.train(docs, labels.where(where))
    assert cotraining.score(docs, model).where("accepted and p_quality = 1").count() == docs.count()


def test_contradicting_labels_are_none(spark, tables):
    docs, labels = tables
    turned = labels.withColumn("quality", 1 - F.col("quality"))
    assert cotraining.train(docs, labels.union(turned)).views is None
