"""Language identification by nearest centroids of character n-grams.

A text becomes the counts of its character n-grams (one to ``ORDERS`` characters of the lower-cased text, a
run of other characters than letters being one blank), hashed to ``BUCKETS`` places. The vector is the root of
each place's share, times its inverse document frequency, at length one.

* *Frequencies*: in how many of the documents that may be learned from each place occurs; all of them are
  counted, each partition adding up its own first.
* *Centroids*: each language has ``centroids`` of them, by spherical k-means over a sample of its documents (at most
  ``SAMPLE`` distinct texts a language, those with the least hash). A language is fitted in a task of its own.
* *Prediction*: the language of the centroid with the greatest cosine; ``score`` is that cosine.
* *Rejection*: short texts lie far from any centroid, long ones near. For each size of text (a power of two
  of its n-grams) the sample gives the distance within which all but ``OUTSIDE`` of its members stay; a text
  that is ``SLACK`` times as far from the nearest centroid is ``rejected``.

The model (``centroids`` vectors a language, at most ``MOST_LANGUAGES`` languages) is what reaches the driver, and goes to
the tasks; prediction is one pass without a shuffle.

Results: a null text or one without a letter is ``und`` with score 0, not rejected; so is every text if
there is nothing to learn from; a null id isn't learned from, and counts as held out; repeated rows
are predicted each (and are one text of a sample); ties go to the language that comes first; texts of any
length are read whole; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundflow.llm.common import blocks, staged, unstage

ORDERS = 3
BUCKETS = 1 << 13
CENTROIDS = 4
#: Documents of a language that its centroids are fitted on, at most.
SAMPLE = 600
MOST_LANGUAGES = 1000
#: Share of the sample that may lie outside its size's distance, and how much further is accepted.
OUTSIDE, SLACK = 0.005, 1.1
SIZES = 32
ROUNDS = 12
HELD_OUT = 5
UNDEFINED = "und"
#: Characters counted together; longer texts are counted in parts.
PART = 1 << 20


def _letters() -> np.ndarray:
    """For characters below 2^16: the character, if it is a letter, else a blank."""
    codes = np.arange(1 << 16, dtype=np.uint32)
    is_letter = np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)
    return np.where(is_letter, codes, 32).astype(np.uint32)


_TABLE: list[np.ndarray] = []


def _characters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, others than letters as blanks."""
    if not _TABLE:
        _TABLE.append(_letters())
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    low = codes < 1 << 16
    return _TABLE[0][codes] if low.all() else np.where(low, _TABLE[0][np.where(low, codes, 0)], codes)


def _without_double_blanks(codes: np.ndarray) -> np.ndarray:
    blank = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return codes[keep]


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams."""
    counts = np.zeros(BUCKETS, np.int64)
    carry = np.empty(0, np.uint32)  # what grams that end in a part may begin with
    for a in range(0, len(text), PART):
        c = _without_double_blanks(np.concatenate([carry, _characters(text[a:a + PART])]))
        h = np.zeros(len(c), np.uint32)
        for order in range(1, ORDERS + 1):
            if len(c) < order:
                break
            h = h[:len(c) - order + 1] * np.uint32(0x01000193) + c[order - 1:]
            x = h[max(0, len(carry) - order + 1):]
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * order)
            counts += np.bincount(x >> np.uint32(33 - BUCKETS.bit_length()), minlength=BUCKETS)
        carry = c[-(ORDERS - 1):]
    return counts


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(length > 0, length, 1)[:, None]


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF vectors at length one, and the sizes of the texts (powers of two of n-grams)."""
    counts = np.stack([gram_counts(t) for t in texts])
    n = counts.sum(axis=1)
    size = np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), SIZES - 1)
    return _unit(np.sqrt(counts / np.maximum(n, 1)[:, None]).astype(np.float32) * idf), size


def spherical_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``k`` centroids at length one; begun with vectors far from each other."""
    picked, near = [0], x @ x[0]
    while len(picked) < min(k, len(x)):
        best = int(near.argmin())
        if near[best] > 1 - 1e-6:
            break
        picked.append(best)
        near = np.maximum(near, x @ x[best])
    centres = x[picked]
    for _ in range(rounds):
        of = (x @ centres.T).argmax(axis=1)
        new = _unit(np.stack([x[of == j].sum(axis=0) if (of == j).any() else centres[j] for j in range(len(centres))]))
        if np.abs(new - centres).max() < 1e-6:
            break
        centres = new
    return centres


@dataclass
class Centroids:
    """Languages, centroids (each one's language by place), document frequencies' weights and the distances by size."""

    languages: list[str]
    centres: np.ndarray
    of: np.ndarray
    idf: np.ndarray
    reach: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine, and whether it is rejected."""
        languages, score, rejected = [UNDEFINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        at = [i for i, t in enumerate(texts) if _has_letter(t)] if self.languages else []
        for a in range(0, len(at), 256):
            some = at[a:a + 256]
            x, size = vectors([texts[i] for i in some], self.idf)
            cosine = x @ self.centres.T
            best = cosine.argmax(axis=1)
            nearest = np.clip(cosine[np.arange(len(some)), best].astype(np.float64), 0, 1)
            score[some] = nearest
            rejected[some] = 1 - nearest > SLACK * self.reach[size]
            for i, b in zip(some, best.tolist(), strict=True):
                languages[i] = self.languages[self.of[b]]
        return languages, score, rejected


def _reach(distance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each size the distance that all but OUTSIDE of the sample keep. Sizes without enough members take the
    next greater one's or more: a shorter text may lie further off."""
    reach = np.full(SIZES, np.nan)
    for s in range(SIZES):
        mine = distance[size == s]
        if len(mine) * OUTSIDE >= 1:
            reach[s] = np.quantile(mine, 1 - OUTSIDE)
        elif len(mine):
            reach[s] = mine.max()
    known = np.flatnonzero(~np.isnan(reach))
    if not len(known):
        return np.ones(SIZES)
    reach[:known[0]] = 1.0  # shorter than any that was seen: never rejected
    for s in range(known[0], SIZES):
        if np.isnan(reach[s]):
            reach[s] = reach[s - 1]
    return np.maximum.accumulate(reach[::-1])[::-1]


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts (column ``text``) and in how many each place occurs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(BUCKETS, np.int64)
        for pdf in blocks(batches, "text"):
            for t in pdf["text"]:
                df += gram_counts(t) > 0
                n += 1
        yield pd.DataFrame({"place": np.arange(-1, BUCKETS), "n": np.concatenate([[n], df])})

    rows = texts.select("text").mapInPandas(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS + 1, np.int64)
    df[rows["place"].to_numpy(np.int64) + 1] = rows["n"].to_numpy(np.int64)
    return int(df[0]), df[1:]


def train(learn: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Centroids:
    """``learn``: ``text, lang`` of the documents that may be learned from (neither is null)."""
    n, df = document_frequencies(learn)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # Ids of the sample: distinct texts, by hash. Cut to the sample in each task before they are shuffled.
    keys = staged_keys = staged(learn.select("lang", F.xxhash64("text").alias("h")).distinct(), "languages")
    if keys.select("lang").distinct().count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    # Twice as many as wanted pass by their hash alone, so however many tasks there are, a language's window is small.
    many = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    keys = keys.join(many, "lang").where(f"(h / 9.223372036854775807e18D + 1) / 2 <= 2D * {sample} / n").select("lang", "h")
    w = Window.partitionBy("lang").orderBy("h")
    # At most ``sample`` rows of a language: the bound holds for the broadcast.
    some = F.broadcast(keys.withColumn("i", F.row_number().over(w)).where(F.col("i") <= sample).drop("i"))
    drawn = learn.withColumn("h", F.xxhash64("text")).join(some, ["lang", "h"], "left_semi")

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("h").sort_values("h")
        x, size = vectors(pdf["text"].tolist(), idf)
        centres = spherical_means(x, centroids)
        distance = 1 - (x @ centres.T).max(axis=1)
        out = [{"lang": pdf["lang"].iloc[0], "centre": c.tobytes(), "distance": None, "size": None} for c in centres]
        out += [{"lang": pdf["lang"].iloc[0], "centre": None, "distance": float(d), "size": int(s)}
                for d, s in zip(distance, size, strict=True)]
        return pd.DataFrame(out, columns=["lang", "centre", "distance", "size"])

    rows = drawn.select("lang", "h", "text").groupBy("lang").applyInPandas(
        cluster, "lang string, centre binary, distance double, size long").collect()
    unstage(staged_keys)
    found = sorted((r.lang, bytes(r.centre)) for r in rows if r.centre is not None)
    languages = sorted({lang for lang, _ in found})
    place = {lang: i for i, lang in enumerate(languages)}
    centres = np.stack([np.frombuffer(c, np.float32) for _, c in found]) if found else np.empty((0, BUCKETS), np.float32)
    seen = [(r.distance, r.size) for r in rows if r.centre is None]
    reach = _reach(np.array([d for d, _ in seen]), np.array([s for _, s in seen], np.int64))
    return Centroids(languages, centres, np.array([place[lang] for lang, _ in found], np.int64), idf, reach)


def predict(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in blocks(batches, "text"):
            languages, score, rejected = shared.value.predict(pdf["text"].where(pdf["text"].notna(), None).tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "lang_pred": languages, "score": score,
                                "rejected": rejected})

    return rows.mapInPandas(run, "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str = "doc_id", every: int = HELD_OUT) -> Column:
    """Whether a document is kept from learning, by its id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % every == 0, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             centroids: int = CENTROIDS, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``: learned from the documents that aren't held out and have a
    language, and predicted for all, from the text alone."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"))
    learn = rows.where(~held_out()).where(r"lang is not null and text rlike '\\p{L}'").select("text", "lang")
    return (predict(rows, train(learn, centroids, sample)).withColumn("held_out", held_out())
            .select("doc_id", "held_out", "lang_pred", "score", "rejected"))
