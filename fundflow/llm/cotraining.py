"""Document quality by co-training: a view of the text, a view of the metadata.

Two logistic regressions see different features of a document:

* *content*: byte pairs of the text (hashed), kinds of characters, words;
* *metadata*: language, source, stated length, layout (lines, non-ASCII share).

They are fitted on a bounded sample of labelled documents (``LABELLED``), and
then teach each other over ``rounds``: each scores all documents without a label,
picks those of whose label it is surest, and hands them, with that label, to the
other. How many it hands over is bounded (``SHARE``, ``HANDED``), which documents
are looked at isn't. A round is a pass over the texts in Spark, whose rows of a few
numbers are shuffled; texts aren't. Each view is calibrated on labelled documents kept
out of the fitting (Platt), and the calibrated views are combined by a third
logistic regression on the same documents. Scoring is one pass over all
documents with the model (a few thousand numbers) in the task: no shuffle.

Results: null text, language or source count as empty, a null length as the
text's own; repeated rows are scored each; without labels of both qualities
every document scores 1 (nothing is rejected); an empty table gives none. Other
columns are passed through; those named like a result column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.common import give_back, staged, take_worker, unstage

#: Labelled documents fitted on, at most.
LABELLED = 6000
ROUNDS = 3
#: Share of the documents without a label that each view labels in a round, how many at most, and how sure it has to be.
SHARE = 0.05
HANDED = 1000
SURE = 0.95
#: Of the labelled documents, each so-manyth is kept for calibration.
KEPT_OUT = 4
SURE_LOGIT = float(np.log(SURE / (1 - SURE)))
PAIRS = 256
#: Text and rows that a task turns into features together.
PART_BYTES, PART_ROWS = 2_000_000, 1000
REJECT_BELOW = 0.5


def content_features(text: str) -> np.ndarray:
    raw = text.encode()
    n = max(1, len(raw))
    b = np.frombuffer(raw, np.uint8)
    pairs = np.zeros(PAIRS)
    if len(b) > 1:
        code = ((b[:-1].astype(np.uint32) * 31 + b[1:]) * np.uint32(2654435761)) >> np.uint32(24)
        pairs = np.sqrt(np.bincount(code, minlength=PAIRS) / n)
    kinds = np.bincount(b, minlength=256)
    words = raw.split()
    m = max(1, len(words))
    again = sum(map(bytes.__eq__, words[1:], words)) / m if words else 0.0
    symbols = int(kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum())
    return np.concatenate([pairs, [
        kinds[65:91].sum() / n, kinds[97:123].sum() / n, kinds[48:58].sum() / n, symbols / n, kinds[32] / n,
        kinds[124] / m, kinds[33] / m, min(again, 1), len(set(words)) / m, np.log1p(m) / 10, n / m / 20,
        len(set(map(bytes.lower, words))) / np.sqrt(m) / 20]])


def metadata_features(text: str, lang: str, source: str, n_chars: float) -> np.ndarray:
    hashed = np.zeros(80)
    hashed[zlib.crc32(lang.encode()) % 16] = 1
    hashed[16 + zlib.crc32(source.encode()) % 64] = 1
    lines = text.count("\n") + 1
    length = max(1, len(text))
    return np.concatenate([hashed, [np.log1p(max(0.0, n_chars)) / 10, np.log1p(lines) / 5, np.log1p(length / lines) / 10,
                                    len(text.encode()) / length - 1, float(abs(n_chars - len(text)) > 0)]])


@dataclass
class Logistic:
    """Logistic regression with a ridge penalty, by Newton's method on standardised features."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 3.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        w = np.zeros(z.shape[1])
        for _ in range(25):
            p = _sigmoid(z @ w)
            gradient = z.T @ (p - y) + penalty * w
            hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hessian, gradient)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return cls(w, mean, scale)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]


def _sigmoid(t: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(t, -35, 35)))


@dataclass
class CoTrained:
    """Both views, each one's calibration, and how they are combined. None: nothing to learn from."""

    views: list[Logistic] | None
    platt: list[Logistic] | None
    both: Logistic | None
    handed: list[int]

    def score(self, views: list[np.ndarray]) -> np.ndarray:
        """Probability of good quality: content view, metadata view, combined."""
        if self.views is None:
            return np.ones((len(views[0]), 3))
        logits = [p.logit(v.logit(x)[:, None]) for v, p, x in zip(self.views, self.platt, views, strict=True)]
        return _sigmoid(np.stack([*logits, self.both.logit(np.stack(logits, axis=1))], axis=1))


VIEWS = ("content", "metadata")
#: Of each view: the features of documents handed to it, by view, and their labels.
Handed = list[tuple[list[np.ndarray], np.ndarray]]


def _quotas(documents: int, good: float) -> list[int]:
    """How many documents a view hands over in a round, as good and as bad."""
    most = min(SHARE * documents, HANDED)
    return [max(1, int(most * share)) for share in (good, 1 - good)]


def _teach(views: list[np.ndarray], label: np.ndarray, rounds: int,
           hand: Callable[[list[Logistic], float], Handed]) -> CoTrained:
    """``views``: features by view of labelled documents. ``hand``: what the models of a round hand over
    (to each view what the other picked), given the share of good documents."""
    known = np.arange(len(label))
    kept = known[::KEPT_OUT]
    fit = np.setdiff1d(known, kept)
    if any(len(np.unique(label[part])) < 2 for part in (fit, kept)):
        return CoTrained(None, None, None, [])
    taught = [(x[fit], label[fit]) for x in views]
    handed = []
    models = [Logistic.fit(x, y) for x, y in taught]
    for _ in range(rounds):
        new = hand(models, label[fit].mean())
        handed.append(sum(len(y) for _, y in new))
        if not handed[-1]:
            break
        taught = [(np.concatenate([x, f[i]]), np.concatenate([y, g])) for i, ((x, y), (f, g)) in enumerate(zip(taught, new, strict=True))]
        models = [Logistic.fit(x, y) for x, y in taught]
    logits = [m.logit(x[kept])[:, None] for m, x in zip(models, views, strict=True)]
    platt = [Logistic.fit(x, label[kept], 1.0) for x in logits]
    calibrated = np.stack([p.logit(x) for p, x in zip(platt, logits, strict=True)], axis=1)
    return CoTrained(models, platt, Logistic.fit(calibrated, label[kept], 1.0), handed)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about PART_BYTES of text, so that a task holds that much of it as Python objects."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64))
    a = 0
    while a < batch.num_rows:
        before = ends[a - 1] if a else 0
        b = max(a + 1, min(int(np.searchsorted(ends, before + PART_BYTES)), a + PART_ROWS))
        yield batch.slice(a, b - a)
        a = b


def _features(batch: dict[str, list]) -> list[np.ndarray]:
    """Content and metadata features of rows, in single precision."""
    content, metadata = [], []
    for text, lang, source, n in zip(batch["text"], batch["lang"], batch["source"], batch["n_chars"], strict=True):
        text = text or ""
        content.append(content_features(text).astype(np.float32))
        metadata.append(metadata_features(text, lang or "", source or "", float(len(text) if n is None else n)).astype(np.float32))
    return [np.array(content, np.float32), np.array(metadata, np.float32)]


def _inputs(docs: DataFrame) -> list:
    """The columns that the features are made of, in the types expected."""
    return [F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
            F.col("source").cast("string").alias("source"), F.col("n_chars").cast("double").alias("n_chars")]


def _unpacked(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.stack([np.frombuffer(r, np.float32) for r in rows[c]]).astype(np.float64) if len(rows) else np.empty((0, 0))
            for c in VIEWS]


def _with_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``df`` (which has :func:`_inputs` too), and the features of both views as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("quality")
        for batch in batches:
            for part in _parts(batch):
                views = _features(part.to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in columns] + [pa.array([r.tobytes() for r in x], pa.binary()) for x in views],
                    names=[*columns, *VIEWS])
        give_back()

    return df.mapInArrow(run, T.StructType([df.schema[c] for c in columns] + [T.StructField(c, T.BinaryType()) for c in VIEWS]))


def _logits(df: DataFrame, models: list[Logistic]) -> DataFrame:
    """``doc_id, key`` of the rows, and the logit of each of the ``models``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("quality")
        for batch in batches:
            for part in _parts(batch):
                logits = [pa.array(m.logit(x)) for m, x in zip(models, _features(part.to_pydict()), strict=True)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["key"], *logits], names=["doc_id", "key", "l0", "l1"])
            give_back()

    return df.mapInArrow(run, "doc_id long, key long, l0 double, l1 double")


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> CoTrained:
    """Fit on at most ``labelled`` documents with a label, drawn by a hash of the id, and on what the views hand
    over of all others (at most ``HANDED`` a view and round). Documents labelled both good and bad have no label.
    Equal rows count once; rows of one id that differ, and those without an id, are documents each."""
    known = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality")))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_inputs(docs))
            .withColumn("key", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0"))
                                            for c in ("doc_id", "text", "lang", "source", "n_chars")])))
    ids = rows.select("doc_id").where("doc_id is not null").distinct()
    # At most ``labelled`` rows of two numbers: the sample's bound holds for the broadcast.
    some = F.broadcast(known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id")).limit(labelled))
    sample = (_with_features(rows.join(some, "doc_id"), ["doc_id", "quality"])
              .dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id")).toPandas())
    if not len(sample):
        return CoTrained(None, None, None, [])
    given: list[list[int]] = [[], []]

    def hand(models: list[Logistic], good: float) -> Handed:
        scored = _logits(rows, models).join(known.select("doc_id"), "doc_id", "left_anti")
        scored = staged(scored.groupBy("key").agg(F.first("l0").alias("l0"), F.first("l1").alias("l1")), "logits")
        quotas = _quotas(scored.count(), good)
        spark = docs.sparkSession
        picks = []
        for i in range(2):
            # What this view has handed over already (a bounded number) isn't picked again.
            before = spark.createDataFrame([(k,) for k in given[1 - i]], "key long")
            free = scored.join(F.broadcast(before), "key", "left_anti")
            for sign, value, most in zip((1, -1), (1.0, 0.0), quotas, strict=True):
                best = free.withColumn("sure", sign * F.col(f"l{i}")).where(F.col("sure") >= SURE_LOGIT)
                picks += [(r.key, 1 - i, value) for r in best.orderBy(F.desc("sure"), "key").limit(most).select("key").collect()]
        unstage(scored)
        wanted = spark.createDataFrame([(k,) for k in sorted({p[0] for p in picks})], "key long")
        found = _with_features(rows.join(F.broadcast(wanted), "key"), ["key"]).dropDuplicates(["key"]).toPandas()
        features, place = _unpacked(found), {k: n for n, k in enumerate(found["key"])}
        out = []
        for j in range(2):
            mine = [(k, value) for k, to, value in picks if to == j]
            given[j] += [k for k, _ in mine]
            at = [place[k] for k, _ in mine]
            width = [x.shape[1] for x in views]
            out.append(([x[at] if at else np.empty((0, w)) for x, w in zip(features, width, strict=True)],
                        np.array([value for _, value in mine])))
        return out

    views = _unpacked(sample)
    return _teach(views, sample["quality"].to_numpy(dtype=np.float64), rounds, hand)


RESULT = ("p_content", "p_metadata", "p_quality", "accepted")


def score(docs: DataFrame, model: CoTrained, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The documents with ``p_content, p_metadata, p_quality`` and ``accepted`` behind them."""
    own = [c for c in docs.columns if c not in RESULT]
    names = ["text", "lang", "source", "n_chars"]
    # Only what the features are made of goes to Python, once, and three numbers come back.
    @F.arrow_udf("struct<p_content:double,p_metadata:double,p_quality:double>")
    def predicted(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        take_worker("quality")
        batch = pa.RecordBatch.from_arrays([text, lang, source, n_chars], names=names)
        found = [model.score(_features(part.to_pydict())) for part in _parts(batch)]
        p = np.concatenate(found) if found else np.empty((0, 3))
        give_back()
        return pa.StructArray.from_arrays([pa.array(p[:, i]) for i in range(3)], names=list(RESULT[:3]))

    return (docs.select(*[F.col(f"`{c}`") for c in own], predicted(*_inputs(docs)).alias("_p"))
            .select(*[F.col(f"`{c}`") for c in own], *[F.col(f"_p.{c}") for c in RESULT[:3]],
                    (F.col("_p.p_quality") >= reject_below).alias(RESULT[3])))
