"""Phrase collocations by vertical partitioning of word suffixes.

Words are hashed (64 bits, the group's name among what is hashed); a second hash of the
same word shows if two words share the first, and then all is counted under another seed.

1. *Prefixes of one word* are counted. A phrase can't be more frequent than its words, so words
   below ``least`` end a suffix. Which words are frequent goes to the tasks as a filter of
   bounded size (at most ``FILTER_WORDS`` 64-bit words): it never denies a frequent word, and what it
   admits wrongly costs time, not correctness.
2. *Prefixes of two and of three words* are counted, and filtered, in the same way, each where what it
   is made of is frequent (by ``PREFIX_BITS`` of a hash: that two prefixes may share them only admits too much).
3. *Vertical partitioning.* A prefix of two words that occurs more than ``budget`` times is extended by
   a word, as long as it does (up to one word short of the depth); only those few are listed (at most
   one in ``budget`` occurrences a depth), all other prefixes are final. Prefixes are dealt into groups by
   a hash, so many that a group holds about ``budget`` occurrences.
4. *Subtrees.* The suffixes, cut at the depth of ``longest`` words, are counted by their words. Every group
   gets the distinct ones with its prefixes, and builds its subtree by sorting them: a node is a
   run of suffixes with the same first words, its frequency the total of its leaves. Groups don't
   know of each other.

Frequent phrases, a small table, are then scored by joins and aggregates.

Results: null text is empty, a null group is ``und``; repeated rows and ids count each;
long texts are read whole; an empty table gives an empty result; columns other than
the text and the group are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundflow.llm.common import blocks, staged

LONGEST = 5
LEAST = 100
#: Occurrences of a prefix, and of a group of prefixes, about; grows with corpora beyond BUDGET * MOST_HEAVY words.
BUDGET = 500_000
MOST_HEAVY = 100_000
#: Words of 64 bits in a filter, at most (a power of two), and bits for each of its members.
FILTER_WORDS = 1 << 22
FILTER_BITS = 16
#: Bits of a prefix's hash: as many as a filter uses (22 for the place, 6 for each of three bits).
PREFIX_BITS = 40
#: Depths of prefixes that are counted and filtered before the subtrees are built.
FILTERED = (2, 3)
#: Pairs that a task holds to combine equal ones.
PREFIXES_HELD = 2_000_000
#: Word hashes that a worker keeps from one block to the next.
WORDS = 600_000
#: A byte that no UTF-8 text holds: between pieces.
BREAK = b"\xff"
UNDEFINED = "und"
_SHAPE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 10 + b" ")


class _Hashes(dict):
    """Word -> hash, within one group; ``second`` (if wanted) has each hash's other hash."""

    def __init__(self, group: str, seed: int, second: bool):
        super().__init__({BREAK: 0})
        self.head, self.seed, self.second = group.encode() + b"\0", seed, {} if second else None

    def __missing__(self, word: bytes) -> int:
        both = xxhash.xxh3_128_digest(self.head + word, self.seed)
        h = int.from_bytes(both[:8], "little", signed=True) or 1
        self[word] = h
        if self.second is not None:
            self.second[h] = int.from_bytes(both[8:12], "little", signed=True)
        return h


class _Reader:
    """Hashes of the words of a block of texts, by group; 0 stands between pieces."""

    def __init__(self, seed: int, second: bool = False):
        self.seed, self.second, self.of = seed, second, {}

    def read(self, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, _Hashes, np.ndarray]]:
        for pdf in blocks(batches, "text"):
            for group, part in pdf.groupby("grp", sort=False):
                if sum(len(t) for t in self.of.values()) > WORDS:
                    self.of = {}
                table = self.of.setdefault(group, _Hashes(group, self.seed, self.second))
                raw = b"\n".join([t.encode() for t in part["text"]]).translate(_SHAPE)
                # Splits at blanks and \x0b-\x0d (which are breaks now), not at other white space.
                tokens = raw.replace(BREAK, b" \xff ").split()
                yield group, table, np.fromiter(map(table.__getitem__, tokens), np.int64, len(tokens))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a prefix's hash and that of the next word."""
    x = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _longer(prefix: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Hash of a prefix of ``depth`` words, from that of all but its last."""
    x = _mixed(prefix, word)
    return x & np.int64((1 << PREFIX_BITS) - 1)


class _Filter:
    """Which hashes may be members: three bits in one 64-bit word each."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, h: np.ndarray) -> np.ndarray:
        u, one = h.view(np.uint64), np.uint64(1)
        mask = np.zeros(len(u), np.uint64)
        for shift in (22, 28, 34):
            mask |= one << ((u >> np.uint64(shift)) & np.uint64(63))
        return (self.bits[(u & np.uint64(len(self.bits) - 1)).astype(np.int64)] & mask) == mask

    @classmethod
    def of(cls, members: DataFrame, column: str) -> _Filter:
        """Built by an aggregate; at most FILTER_WORDS numbers come to the driver."""
        need = max(1, members.count() * FILTER_BITS // 64)
        size = min(FILTER_WORDS, 1 << (need - 1).bit_length())
        mask = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned({column}, {s}) & 63 as int))" for s in (22, 28, 34))
        rows = (members.groupBy(F.expr(f"cast({column} & {size - 1} as int)").alias("at"))
                .agg(F.expr(f"bit_or({mask})").alias("bits")).toPandas())
        bits = np.zeros(size, np.int64)
        bits[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
        return cls(bits.view(np.uint64))


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def _words(texts: DataFrame, least: int, seed: int) -> DataFrame:
    """``h, f, clash`` of the words that occur ``least`` times or more."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, table, h in _Reader(seed, second=True).read(batches):
            found, n = _counted(h[h != 0])
            yield pd.DataFrame({"h": found, "g": [table.second[x] for x in found.tolist()], "n": n})

    return (texts.mapInPandas(run, "h long, g int, n long").groupBy("h")
            .agg(F.sum("n").alias("f"), (F.min("g") != F.max("g")).alias("clash")).where(F.col("f") >= least))


def _prefixes(h: np.ndarray, words: _Filter, filters: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which words of a block are frequent, and by depth (from 2) the hashes of the prefixes that start at each place (-1:
    none, as a part of it isn't frequent); one depth more than there are ``filters`` (of prefixes of 2, 3, ... words)."""
    good = (h != 0) & words.has(h)
    seen, at, prefix = good, [], h
    for depth in range(2, len(filters) + 3):
        if len(seen) < 2:
            at.append(np.empty(0, np.int64))
            seen = np.empty(0, bool)
            continue
        both = seen[:-1] & seen[1:]
        prefix = np.where(both, _longer(prefix[:len(both)].copy(), h[depth - 1:].copy(), depth), -1)
        at.append(prefix)
        if depth - 2 < len(filters):
            seen = both & filters[depth - 2].has(prefix)
    return good, at


def _pairs(texts: DataFrame, words, least: int, seed: int) -> DataFrame:
    """``kind, p, grp, word, n``: 0: pairs (by hash) that occur ``least`` times or more; 1: the frequent words'
    texts; 2: words in all, by group."""
    schema = pa.schema([("kind", pa.int32()), ("p", pa.int64()), ("grp", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def batch(kind: int, p, grp: str | None, word: list | None, n) -> pa.RecordBatch:
        rows = len(p)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(rows, kind, np.int32)), pa.array(p, pa.int64()), pa.array([grp] * rows, pa.string()),
            pa.nulls(rows, pa.string()) if word is None else pa.array(word, pa.string()), pa.array(n, pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        held = _Held()
        for group, table, h in _Reader(seed).read(b.to_pandas() for b in batches):
            good, (pairs,) = _prefixes(h, words.value, [])
            for p, n in held.add(pairs[pairs >= 0]):
                yield batch(0, p, None, None, n)
            new = set(_counted(h[good])[0].tolist()) - told
            if len(told) > WORDS:
                told = set()
            told |= new
            text = {v: w.decode() for w, v in table.items() if v in new} if new else {}
            yield batch(1, list(text), group, list(text.values()), [0] * len(text))
            yield batch(2, [0], group, None, [int((h != 0).sum())])
        for p, n in held.rest():
            yield batch(0, p, None, None, n)

    return (texts.mapInArrow(run, "kind int, p long, grp string, word string, n long")
            .groupBy("kind", "p", "grp", "word").agg(F.sum("n").alias("n")).where(f"kind > 0 or n >= {least}"))


class _Held:
    """Pairs of a task, counted when there are many or no more."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def add(self, p: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.parts.append(p)
        if sum(map(len, self.parts)) >= PREFIXES_HELD:
            yield from self.rest()

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.parts:
            yield _counted(np.concatenate(self.parts))
            self.parts.clear()


def _longer_prefixes(texts: DataFrame, words, filters: list, least: int, seed: int) -> DataFrame:
    """``p, n`` of the prefixes of one word more than those of the last of the ``filters`` that occur ``least`` times or more."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, h in _Reader(seed).read(batches):
            last = _prefixes(h, words.value, [f.value for f in filters])[1][-1]
            yield pd.DataFrame({"p": last[last >= 0]})

    return texts.mapInPandas(run, "p long").groupBy("p").agg(F.count("*").alias("n")).where(F.col("n") >= least)


class _Suffixes:
    """Suffixes of a block that begin with a frequent pair, cut at the depth and before the first word at which a prefix
    that ends there isn't frequent."""

    def __init__(self, h: np.ndarray, words: _Filter, filters: list, longest: int):
        at = _prefixes(h, words, filters)[1]
        n = len(h)
        reach = np.zeros(n + 1, np.int8)  # words that follow, up to longest - 1
        for depth, f in reversed(list(enumerate(filters, 2))):
            p = at[depth - 2]
            good = np.zeros(n, bool)
            good[:len(p)] = (p >= 0) & f.has(p)
            if depth == len(filters) + 1:  # the deepest: as long as each next one is frequent
                for _ in range(longest - depth + 1):
                    reach[:n] = np.where(good, np.maximum(reach[1:], depth - 2) + 1, 0)
            else:
                reach[:n] = np.where(good, np.maximum(reach[:n], depth - 1), 0)
        self.at = np.flatnonzero(reach[:n] > 0)
        self.more = np.minimum(reach[self.at], longest - 1)
        padded = np.concatenate([h, np.zeros(longest, np.int64)])
        self.w = np.stack([np.where(self.more >= k, padded[self.at + k], 0) for k in range(longest)], axis=1)

    def prefix(self, depth: int) -> np.ndarray:
        """Hash of the first ``depth`` words (suffixes that are shorter: of all their words)."""
        x = self.w[:, 0].copy()
        for k in range(1, depth):
            x = np.where(self.more >= k, _longer(x, self.w[:, k].copy(), k + 1), x)
        return x

    def final(self, heavy: list[np.ndarray]) -> np.ndarray:
        """Hash of the prefix that decides the group: extended while it is listed as heavy."""
        x = self.prefix(2)
        for depth, listed in enumerate(heavy, 2):
            more = (self.more >= depth) & np.isin(self.prefix(depth), listed)
            x = np.where(more, self.prefix(depth + 1), x)
        return x


def _heavy(texts: DataFrame, pairs: DataFrame, filters: tuple, budget: int, longest: int, seed: int) -> list[np.ndarray]:
    """Prefixes of 2, 3, ... words that occur more than ``budget`` times, by hash: a pass over the texts for each
    depth at which there are any."""
    words, listed = filters
    over = [pairs.where(F.col("n") > budget)]
    found: list[np.ndarray] = []
    while True:
        rows = over[-1].select("p").toPandas()["p"].to_numpy(np.int64)
        depth = len(found) + 2
        if not len(rows) or depth >= longest - 1:
            return [*found, rows] if len(rows) else found
        found.append(rows)

        def run(batches: Iterator[pd.DataFrame], rows=rows, depth=depth) -> Iterator[pd.DataFrame]:
            for _, _, h in _Reader(seed).read(batches):
                s = _Suffixes(h, words.value, [f.value for f in listed], longest)
                p, n = _counted(s.prefix(depth + 1)[(s.more >= depth) & np.isin(s.prefix(depth), rows)])
                yield pd.DataFrame({"p": p, "n": n})

        over.append(texts.mapInPandas(run, "p long, n long").groupBy("p").agg(F.sum("n").alias("n"))
                    .where(F.col("n") > budget))


def _grouped_suffixes(texts: DataFrame, filters: tuple, heavy: list[np.ndarray], groups: int, longest: int, seed: int) -> DataFrame:
    """``part, w1, w2, ..., n``: distinct suffixes, with the group that they are dealt into and their count."""
    words, listed = filters
    names = [f"w{k + 1}" for k in range(longest)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, h in _Reader(seed).read(batches):
            s = _Suffixes(h, words.value, [f.value for f in listed], longest)
            out = pd.DataFrame(s.w, columns=names)
            out.insert(0, "part", (s.final(heavy).view(np.uint64) % np.uint64(groups)).astype(np.int64))
            yield out

    return (texts.mapInPandas(run, "part long, " + ", ".join(f"{c} long" for c in names))
            .groupBy("part", *names).agg(F.count("*").alias("n")))


def _nodes(suffixes: DataFrame, heavy: list[np.ndarray], least: int, longest: int) -> DataFrame:
    """``ws`` (hashes of words), ``f`` of the nodes of two words and more: each group's subtree by itself. A heavy
    prefix's suffixes are in several groups, whose totals for that node are added up."""
    def subtree(pdf: pd.DataFrame) -> pd.DataFrame:
        w = pdf[[f"w{k + 1}" for k in range(longest)]].to_numpy(np.int64)
        order = np.lexsort(w.T[::-1])
        w, n = w[order], pdf["n"].to_numpy(np.int64)[order]
        differs = np.zeros(len(w), bool)
        differs[0] = True
        ws, fs, prefix = [], [], w[:, 0].copy()
        for depth in range(1, longest + 1):
            differs[1:] |= w[1:, depth - 1] != w[:-1, depth - 1]
            if depth == 1:
                continue
            prefix = _longer(prefix, w[:, depth - 1].copy(), depth)
            start = np.flatnonzero(differs)
            f = np.add.reduceat(n, start)
            part = np.isin(prefix[start], heavy[depth - 2]) if depth - 2 < len(heavy) else False
            here = (w[start, depth - 1] != 0) & (part | (f >= least))
            ws += w[start[here], :depth].tolist()
            fs += f[here].tolist()
        return pd.DataFrame({"ws": pd.Series(ws, dtype=object), "f": pd.Series(fs, dtype="int64")})

    found = suffixes.groupBy("part").applyInPandas(subtree, "ws array<long>, f long")
    return found.groupBy("ws").agg(F.sum("f").alias("f")).where(F.col("f") >= least) if heavy else found


class Phrases:
    """Frequent phrases of a corpus: ``counts`` (``ws, f``: words' hashes; single words too), ``words`` (``h, grp, word``)
    and ``totals`` (``grp, n``: all words)."""

    def __init__(self, counts: DataFrame, words: DataFrame, totals: DataFrame):
        self.counts, self.words, self.totals = counts, words, totals


def frequent_phrases(df: DataFrame, text_col: str = "text", group_col: str = "lang", longest: int = LONGEST,
                     least: int = LEAST, budget: int = BUDGET) -> Phrases:
    """Phrases of one to ``longest`` words that occur ``least`` times or more in a group, within pieces."""
    spark: SparkSession = df.sparkSession
    texts = df.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                      F.coalesce(F.col(f"`{group_col}`").cast("string"), F.lit(UNDEFINED)).alias("grp"))
    seed = 0
    while True:
        words = staged(_words(texts, least, seed), "words")
        if words.where("clash").isEmpty():
            break
        seed += 1
    share = spark.sparkContext.broadcast
    of_words = share(_Filter.of(words, "h"))
    seen = staged(_pairs(texts, of_words, least, seed), "pairs")
    pairs = seen.where("kind = 0")
    filters = (of_words, [share(_Filter.of(pairs, "p"))])
    for _ in FILTERED[1:longest - 1]:
        longer = staged(_longer_prefixes(texts, *filters, least, seed), "prefixes")
        filters[1].append(share(_Filter.of(longer, "p")))
    occurrences = pairs.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, occurrences // MOST_HEAVY)
    heavy = _heavy(texts, pairs, filters, budget, longest, seed)
    groups = max(1, math.ceil(occurrences / budget))
    nodes = _nodes(_grouped_suffixes(texts, filters, heavy, groups, longest, seed), heavy, least, longest)
    counts = staged(nodes.union(words.select(F.array("h"), "f")), "phrases")
    text_of = seen.where("kind = 1").selectExpr("p h", "grp", "word").join(words.select("h"), "h", "left_semi")
    return Phrases(counts, text_of, seen.where("kind = 2").groupBy("grp").agg(F.sum("n").alias("n")))


def collocations(df: DataFrame, text_col: str = "text", group_col: str = "lang", longest: int = LONGEST,
                 least: int = LEAST, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """Each group's first ``top`` phrases of two words and more: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the phrase's frequency, ``l`` and ``r`` those of its two parts at the cut with the lowest score,
    floor(1000 a n / (l r)) with ``n`` words in the group (the shortest first part of equals). A phrase
    that stands in a longer one of the same frequency is left out. By score, then ``a``, then text.
    """
    found = frequent_phrases(df, text_col, group_col, longest, least, budget)
    many = found.counts.where("size(ws) > 1")
    # In a longer phrase as frequent: then also in one that is longer by one word.
    inside = (many.where("size(ws) > 2").select(F.explode(F.expr(
        "array(slice(ws, 1, size(ws) - 1), slice(ws, 2, size(ws) - 1))")).alias("ws"), "f")
        .groupBy("ws").agg(F.max("f").alias("longer")))
    kept = (many.join(inside, "ws", "left").where("longer is null or longer < f")
            .join(found.words.select(F.expr("h as h1"), "grp"), F.expr("ws[0] = h1")).drop("h1", "longer")
            .join(found.totals, "grp"))
    part = found.counts.selectExpr("ws as part", "f as pf")
    cuts = kept.select("grp", "ws", F.col("f").alias("a"), "n", F.explode(F.expr("sequence(1, size(ws) - 1)")).alias("k"))
    scored = (cuts.join(part.withColumnRenamed("pf", "l"), F.expr("part = slice(ws, 1, k)")).drop("part")
              .join(part.withColumnRenamed("pf", "r"), F.expr("part = slice(ws, k + 1, size(ws) - k)")).drop("part")
              .withColumn("score", F.expr("(cast(1000 * a as decimal(18,0)) * cast(n as decimal(18,0))) div "
                                          "(cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"))
              .groupBy("grp", "ws", "a", "n").agg(F.expr("min(struct(score, k, l, r))").alias("cut")))
    spelt = (scored.select("*", F.posexplode("ws").alias("i", "h")).join(found.words.select("h", "word"), "h")
             .groupBy("grp", "ws", "a", "n", "cut")
             .agg(F.expr("concat_ws(' ', transform(sort_array(collect_list(struct(i, word))), x -> x.word))").alias("phrase")))
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (spelt.selectExpr("grp lang", "phrase", "a", "cut.l l", "cut.r r", "n", "cut.score score")
            .withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
