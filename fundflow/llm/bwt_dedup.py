"""Repeated byte strings, found by merging Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in
a smaller doc_id, or before it in the same document), judged on the input.

A transform of a whole corpus doesn't fit a task, so the strings to compare are
brought together first, without losing any:

1. *Anchors.* Of the 24-byte grams in a window of ``length`` bytes, the one with the
   least hash (the first of equals) is the window's anchor. Equal windows have equal
   anchors, so only windows of one anchor need comparing. Neighbouring windows share
   their anchor: a *run* of windows, which together read a *region* of text.
2. Anchors that occur once in the corpus are done: their windows occur once.
3. Equal regions of one anchor: all but the first are repeats as a whole.
4. What is left are anchors whose regions differ, each distinct region once. They
   are dealt into groups by anchor (an anchor with very many, into several). In a group,
   shards of regions get their Burrows-Wheeler transform each, and the transforms are
   merged by *iterative interleave refinement*: all suffixes begin as one block, the
   shards one behind the other; each step deals them out by the symbol before them
   (a stable distribution of the interleave), which sorts them one symbol further, and
   parts blocks where symbols differ. Suffixes of different shards are never sorted
   again. A symbol is ten bytes, so ten steps reach a common prefix of 100 bytes. The
   blocks then are the repeated intervals; the first window of each stays.
5. Between the groups of one hot anchor, first windows are compared by hash.

Every step is an aggregate or join by anchor, or by document; the most that meets
in one task is a group of bounded size, or one document with its spans.

Results: null text is empty; a null doc_id comes before all others; rows that share
doc_id and text are one document (none of them is the other's repeat); different texts of
one doc_id (or of none) are documents in the order of their texts' hashes (xxhash64); extra
columns pass through, but for those named like result columns, which are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.common import give_back, staged, take_worker

LENGTH = 100
GRAM = 24
#: Bytes of a symbol of the transforms; the length has to be a multiple.
SYMBOL = 10
#: Regions in a group and in a shard, about; beyond HOT an anchor's regions are dealt into several groups.
GROUP, SHARD, HOT = 400, 64, 2000
#: Bytes anchored together; longer texts are anchored in overlapping parts.
BLOCK = 256_000
FIRST = -(2 ** 63)
#: Not the first of its kind: by document, the text's hash where several texts have one id, and place.
LATER = "d <> f.d or t <> f.t or start <> f.start"


def _powers(base: int) -> list[np.uint32]:
    return [np.uint32(pow(base, n, 1 << 32)) for n in range(GRAM + 1)]


_POWERS = _powers(0xD6E8FE87)
_BYTES = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the gram at each place: hashes of halves, put together."""
    have, at = {1: _BYTES[b]}, 1
    while at * 2 <= GRAM:
        h = have[at]
        have[at * 2] = h[:-at] * _POWERS[at] + h[at:]
        at *= 2
    x, done = have[at], at
    while done < GRAM:
        at = max(k for k in have if k <= GRAM - done)
        n = len(b) - done - at + 1
        x = x[:n] * _POWERS[at] + have[at][done:done + n]
        done += at
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(12)
    x *= np.uint32(0x297A2D39)
    x ^= x >> np.uint32(15)
    return x


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    at = 1
    while at * 2 <= width:
        x = np.minimum(x[:-at], x[at:])
        at *= 2
    return np.minimum(x[:len(x) - (width - at)], x[width - at:]) if at < width else x


def runs(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    """Runs of windows with one anchor: text, start, windows; and each run's anchor and region."""
    buf, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
    none = np.empty(0, np.int64)
    if len(buf) < length:
        return none, none, none, [], []
    key = _gram_hashes(np.frombuffer(buf, np.uint8)).astype(np.uint64) << np.uint64(32)
    key |= np.arange(len(key), dtype=np.uint64)
    at = (_sliding_min(key, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n = len(at)
    whole = np.ones(n, bool)  # windows that cross no text's end
    for e in ends.tolist():
        whole[max(0, e - length + 1):min(e, n)] = False
    begins = np.ones(n, bool)
    begins[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1])
    start = np.flatnonzero(begins)
    windows = np.diff(start, append=n)
    start, windows = start[whole[start]], windows[whole[start]]
    text = np.searchsorted(ends, start, side="right")
    anchors = [buf[a:a + GRAM] for a in at[start].tolist()]
    regions = [buf[a:b] for a, b in zip(start.tolist(), (start + windows + length - 1).tolist(), strict=True)]
    return text, start - (ends - [len(t) for t in texts])[text], windows, anchors, regions


def _hashes(strings: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(s) for s in strings], np.uint64).view(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], length: int):
    """(rows, places in them, texts) of about BLOCK bytes together."""
    for batch in batches:
        rows, places, texts, size = [], [], [], 0
        for i, text in enumerate(batch.column("text").to_pylist()):
            raw = text.encode()
            for a in range(0, max(1, len(raw) - length + 1), 4 * BLOCK):
                part = raw[a:a + 4 * BLOCK + length - 1]
                rows.append(i)
                places.append(a)
                texts.append(part)
                size += len(part)
                if size >= BLOCK:
                    yield batch, np.array(rows), np.array(places), texts
                    rows, places, texts, size = [], [], [], 0
        if texts:
            yield batch, np.array(rows), np.array(places), texts


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``d`` (the id; null: before all), ``t`` (hash of the text) and ``text``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(FIRST)).alias("d"),
                     F.xxhash64(text).alias("t"), text.alias("text"))


def _anchor_counts(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        take_worker("repeats")
        for _, _, _, texts in _blocks(batches, length):
            anchors, n = np.unique(_hashes(runs(texts, length)[3]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(n)], names=["anchor", "n"])
        give_back()

    return docs.select("text").mapInArrow(run, "anchor long, n long")


def _all_runs(docs: DataFrame, length: int) -> DataFrame:
    """``d, t, start, windows, anchor, region`` (hashes) of every run."""
    def run(batches):
        for batch, rows, places, texts in _blocks(batches, length):
            text, start, windows, anchors, regions = runs(texts, length)
            row = pa.array(rows[text], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("d").take(row), batch.column("t").take(row), pa.array(start + places[text]),
                 pa.array(windows.astype(np.int32)), pa.array(_hashes(anchors)), pa.array(_hashes(regions))],
                names=["d", "t", "start", "windows", "anchor", "region"])
        give_back()

    return docs.mapInArrow(run, "d long, t long, start long, windows int, anchor long, region long")


class Symbols:
    """The suffixes of a group of regions, as strings of symbols of SYMBOL bytes.

    Every place of every region (and its end) is a suffix. One that has no whole symbol left is an end
    mark, and smaller than all others; end marks differ, by place."""

    def __init__(self, regions: list[bytes]):
        sizes = np.array([len(r) for r in regions])
        self.base = np.concatenate([[0], np.cumsum(sizes + 1)])
        n = int(self.base[-1])
        raw = np.frombuffer(b"\0".join(regions) + b"\0" * (SYMBOL + 1), np.uint8)[:n + SYMBOL].astype(np.int64)
        inside = np.arange(n) - np.repeat(self.base[:-1], sizes + 1)
        self.left = np.repeat(sizes, sizes + 1) - inside
        half = raw[:n + SYMBOL - 4].copy()
        for i in range(1, 5):
            half = half * 256 + raw[i:n + SYMBOL - 4 + i]
        _, half = np.unique(half, return_inverse=True)
        word = half[:n] * (int(half.max()) + 1) + half[5:n + 5]
        _, word = np.unique(word, return_inverse=True)
        #: Symbol at each suffix, and one more than that of the symbol before it (0: a region begins there).
        self.word = np.where(self.left >= SYMBOL, word, -1)
        self.before = np.full(n, -1, np.int64)
        self.before[SYMBOL:] = np.where(inside[SYMBOL:] >= SYMBOL, self.word[:-SYMBOL], -1)
        self.before += 1
        if self.before.max(initial=0) < 2 ** 16:  # sorted by radix then
            self.before = self.before.astype(np.uint16)
        self.ends = np.flatnonzero(self.left < SYMBOL)

    def transform(self, a: int, b: int) -> np.ndarray:
        """Suffixes of the regions ``a`` to ``b`` (a shard) in order; ``before`` of them is the shard's
        Burrows-Wheeler transform. Sorted by doubling the symbols compared."""
        lo, hi = int(self.base[a]), int(self.base[b])
        left, word = self.left[lo:hi], self.word[lo:hi]
        end = word < 0
        rank = np.where(end, np.cumsum(end) - 1, word + int(end.sum()))
        step = SYMBOL
        while True:
            _, rank = np.unique(rank, return_inverse=True)
            if rank.max(initial=0) == hi - lo - 1 or step > left.max():
                return lo + np.argsort(rank, kind="stable")
            follows = np.zeros(hi - lo, np.int64)
            more = np.flatnonzero(left >= step)
            follows[more] = rank[more + step]
            rank = rank * (hi - lo + 1) + follows
            step *= 2

    def merged(self, shards: list[np.ndarray], steps: int) -> tuple[np.ndarray, np.ndarray]:
        """The interleave of the shards' suffixes refined ``steps`` times, and the block of each: suffixes
        with one block have their first ``steps`` symbols in common."""
        order = np.concatenate(shards)
        block = np.zeros(len(order), np.int64)
        ends = len(self.ends)
        for _ in range(steps):
            before = self.before[order]
            at = np.flatnonzero(before)
            at = at[np.argsort(before[at], kind="stable")]
            symbol, was = before[at], block[at]
            new = np.ones(len(at), np.int64)
            new[1:] = (symbol[1:] != symbol[:-1]) | (was[1:] != was[:-1])
            order = np.concatenate([self.ends, order[at] - SYMBOL])
            block = np.concatenate([np.arange(ends), ends + np.cumsum(new) - 1])
        return order, block


def first_windows(regions: list[bytes], length: int, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Region and place in it of every window of ``length`` bytes, and whether it is the first of its
    kind, for regions in the order in which they stand."""
    s = Symbols(regions)
    order, block = s.merged([s.transform(a, min(a + shard, len(regions))) for a in range(0, len(regions), shard)],
                            length // SYMBOL)
    of = np.empty(len(order), np.int64)
    of[order] = block
    windows = np.flatnonzero(s.left >= length)
    _, first = np.unique(of[windows], return_index=True)
    mark = np.zeros(len(windows), bool)
    mark[first] = True
    region = np.searchsorted(s.base, windows, side="right") - 1
    return region, windows - s.base[region], mark


def _texts_of(wanted: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``anchor, many, d, t, start, bytes`` of runs ``d, t, start, windows, anchor, many``."""
    by_doc = wanted.groupBy("d", "t").agg(F.collect_list(F.struct("anchor", "many", "start", "windows")).alias("runs"))

    def run(batches):
        for batch in batches:
            out = {c: [] for c in ("anchor", "many", "d", "t", "start", "bytes")}
            for d, t, text, rs in zip(*(batch.column(c).to_pylist() for c in ("d", "t", "text", "runs")), strict=True):
                raw = text.encode()
                for r in rs:
                    out["anchor"].append(r["anchor"])
                    out["many"].append(r["many"])
                    out["d"].append(d)
                    out["t"].append(t)
                    out["start"].append(r["start"])
                    out["bytes"].append(raw[r["start"]:r["start"] + r["windows"] + length - 1])
                if len(out["d"]) >= 20_000:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    out = {c: [] for c in out}
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("anchor", pa.int64()), ("many", pa.int64()), ("d", pa.int64()), ("t", pa.int64()),
                        ("start", pa.int64()), ("bytes", pa.binary())])
    texts = docs.join(by_doc, ["d", "t"]).dropDuplicates(["d", "t"])
    return texts.mapInArrow(run, "anchor long, many long, d long, t long, start long, bytes binary")


def _merged_groups(contexts: DataFrame, length: int) -> DataFrame:
    """Ranges ``d, t, start, end`` that are repeats in their group; from hot anchors also the first windows
    (``hash`` not null), for comparing groups."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["d", "t", "start"], kind="stable")
        region, place, first = first_windows(pdf["bytes"].tolist(), length)
        at = pdf["start"].to_numpy()[region] + place
        # Repeats that follow each other in a region are one range.
        begins = ~first
        begins[1:] &= first[:-1] | (region[1:] != region[:-1])
        stops = ~first
        stops[:-1] &= first[1:] | (region[1:] != region[:-1])
        b, e = np.flatnonzero(begins), np.flatnonzero(stops)
        d, t = pdf["d"].to_numpy(), pdf["t"].to_numpy()
        out = pd.DataFrame({"d": d[region[b]], "t": t[region[b]], "start": at[b], "end": at[e] + length,
                            "anchor": pd.array([None] * len(b), "Int64"), "hash": None})
        if pdf["many"].iloc[0] <= HOT:
            return out
        keep = np.flatnonzero(first)
        texts = pdf["bytes"].tolist()
        hashes = [xxhash.xxh3_128_digest(texts[r][p:p + length]) for r, p in zip(region[keep], place[keep], strict=True)]
        more = pd.DataFrame({"d": d[region[keep]], "t": t[region[keep]], "start": at[keep], "end": at[keep] + length,
                             "anchor": pd.array(pdf["anchor"].to_numpy()[region[keep]], "Int64"), "hash": hashes})
        return pd.concat([out, more])

    groups = max(1, math.ceil(contexts.count() / GROUP))
    hot = F.col("many") > HOT
    dealt = contexts.withColumns({
        "hot": F.when(hot, F.col("anchor")),
        "part": F.when(hot, F.pmod(F.xxhash64("bytes"), F.ceil(F.col("many") / F.lit(HOT // 2))))
        .otherwise(F.pmod(F.xxhash64("anchor"), F.lit(groups)))})
    return dealt.groupBy("hot", "part").applyInPandas(
        run, "d long, t long, start long, end long, anchor long, hash binary")


def repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``d, t, start, end``: byte ranges to remove, by document (they may overlap)."""
    if length % SYMBOL or length < 2 * GRAM:
        raise ValueError(f"length: a multiple of {SYMBOL}, {2 * GRAM} or more")
    docs = _documents(df, id_col, text_col)
    # Texts as long as a window at least; what is shorter has none.
    long = docs.where(f"octet_length(text) >= {length}")
    shared = _anchor_counts(long, length).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    hits = staged(_all_runs(long, length).join(staged(shared, "anchors"), "anchor"), "hits")
    first = staged(hits.groupBy("anchor", "region").agg(F.min(F.struct("d", "t", "start", "windows")).alias("f")),
                   "regions")
    again = (hits.join(first, ["anchor", "region"]).where(LATER)
             .selectExpr("d", "t", "start", f"start + windows + {length - 1} as end"))
    several = first.groupBy("anchor").agg(F.count("*").alias("many")).where("many > 1")
    wanted = first.join(several, "anchor").selectExpr("anchor", "many", "f.d", "f.t", "f.start", "f.windows")
    contexts = staged(_texts_of(wanted, long, length), "contexts")
    merged = staged(_merged_groups(contexts, length), "merged")
    rows = merged.where("hash is not null")
    met = (rows.groupBy("anchor", "hash").agg(F.min(F.struct("d", "t", "start")).alias("f"), F.count("*").alias("n"))
           .where("n > 1"))
    across = rows.join(met, ["anchor", "hash"]).where(LATER).select("d", "t", "start", "end")
    return again.union(merged.where("hash is null").select("d", "t", "start", "end")).union(across)


RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "spans")


def remove_repeats(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False, keep: list[str] | None = None) -> DataFrame:
    """The rows (their columns ``keep``; default: all) with ``n_bytes, n_removed, n_spans, kept_sha256``
    behind; ``with_text``: and ``kept_text`` (halves of characters that a cut leaves are dropped) and
    ``spans`` (``start, end`` of the maximal removed runs)."""
    result = RESULT if with_text else RESULT[:4]
    own = [c for c in (df.columns if keep is None else keep) if c not in result]
    spans = (repeats(df, length, id_col, text_col).groupBy("d", "t")
             .agg(F.collect_set(F.struct("start", "end")).alias("r")))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(FIRST)).alias("_d"), F.xxhash64(text).alias("_t"),
                     text.alias("_text"), F.struct(*[F.col(f"`{c}`") for c in own if c != text_col]).alias("_row"),
                     F.col(f"`{text_col}`").isNull().alias("_null"))
    joined = docs.join(spans.toDF("_d", "_t", "_r"), ["_d", "_t"], "left").select("_row", "_text", "_null", "_r")
    kinds = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string",
             "kept_text": "string", "spans": "array<struct<start:bigint,end:bigint>>"}
    rest = [c for c in own if c != text_col]
    schema = T.StructType([T.StructField("_row", T.StructType([df.schema[c] for c in rest]))]
                          + [T.StructField("_text", T.StringType())] * (text_col in own)
                          + [T.StructField(c, T.DataType.fromDDL(kinds[c])) for c in result])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in result}
            for text, ranges in zip(batch.column("_text").to_pylist(), batch.column("_r").to_pylist(), strict=True):
                raw = text.encode()
                gone = _union(ranges or [])
                at, kept = 0, []
                for a, b in gone:
                    kept.append(raw[at:a])
                    at = b
                left = b"".join([*kept, raw[at:]])
                row = (len(raw), len(raw) - len(left), len(gone), hashlib.sha256(left).hexdigest(),
                       left.decode("utf-8", "ignore") if with_text else None, [{"start": a, "end": b} for a, b in gone])
                for c, v in zip(RESULT, row, strict=True):
                    if c in out:
                        out[c].append(v)
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            texts = [pc.if_else(batch.column("_null"), pa.scalar(None, pa.string()), batch.column("_text").cast(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row")] + texts * (text_col in own)
                + [pa.array(out[c], k) for c, k in zip(result, types, strict=False)], names=schema.names)
        give_back()

    return joined.mapInArrow(run, schema).select(
        *[F.col("_text" if c == text_col else f"_row.`{c}`").alias(c) for c in own], *result)


def _union(ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the ranges (those that touch are one)."""
    out: list[tuple[int, int]] = []
    for r in sorted(ranges, key=lambda r: r["start"]):
        if out and r["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], r["end"]))
        else:
            out.append((r["start"], r["end"]))
    return out
