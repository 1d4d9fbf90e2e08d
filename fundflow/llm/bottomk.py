"""Near duplicates by bottom-k sketches of one hash function.

1. Every document becomes its set of word shingles, hashed with one function;
   the ``k`` smallest hashes are its sketch. Documents with the same set are
   one *class*, which goes on as one under a number of its own (the text of its smallest
   doc_id stands for it).
2. Inverted lists, run -> classes: a run is ``RUN`` neighbours in the order of a sketch. Single values won't do: common
   shingles stand in more and more sketches as documents are added, and any two of them in many pairs; runs of them are
   rare, as whatever else a document has stands between. If two classes are similar enough, the values that both
   have leave at least ``SHARED`` runs whole among the ``k`` smallest of both (33 are expected at 0.8; the chance
   of less is about 1e-7 for k = 64), or, of a set that is smaller than its sketch may be, for certain as many as
   are left when a fifth of its values each break three (:func:`_need`; sets of up to five values have runs of
   two too). Of the runs of a class, in order of rarity over all classes, all but the last ``SHARED - 1`` then hold
   a shared one: a class stands in the lists of those alone.
3. Runs that up to ``SMALL`` classes have make short lists, which offer all their pairs. A long list offers the pairs of one
   member, its *hub*, with the others. The hub is the member whose sketch is shared most (the
   sum of its runs' logarithms of the number of classes that have them): of an original
   and its edited copies, the original. Once these links are known, members of one component
   are no pair any more (a link inside a component can't change the components), and a long
   list whose members are all linked is done. What is left of those with the same next hub is
   one *group*: its members are dealt into blocks, and pairs of blocks are compared in a task
   each, on full sets. Blocks of the group's largest component aren't compared with each
   other. So of a large group of similar documents only links come out, not pairs.
4. A pair is kept if the estimate from the union's sketch (the k smallest of
   both sketches, and which of them are in both) is not far below the threshold
   (``MARGIN``), and is a link only if the exact Jaccard of the full sets says so.

Written tables go as soon as nothing reads them any more: of those that a result reads, only the rows'
and the classes' have a row for each document.

Results: a document with fewer words than a shingle is one shingle of all its
words; one without words (or with null text) has an empty set and no links. A
null doc_id has no links and comes back with a null component, kept. A row
whose doc_id is repeated with another text gets the component of its own text; two components
with the same smallest doc_id then have the same component_id (:func:`grouped` tells
them apart). Other columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import blocks, give_back, staged, take_worker, text_column, unstage
from fundflow.llm.components import components

SKETCH = 64
RUN = 3
SHARED = 4
MARGIN = 0.3
#: Classes with the run of a list that offers all its pairs; documents in a block of a group.
SMALL = 32
BLOCK = 256
#: Word hashes that a worker keeps.
WORDS = 1_000_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles. A-Z are lower-cased; words are runs of
    characters other than blank, tab, newline, vertical tab, form feed and return."""
    tokens = text.encode().lower().split()
    if not tokens:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(h))
    n = len(h) - width + 1
    x = h[:n] + np.uint64(width)
    for j in range(1, width):
        x = _mix(x) + h[j:j + n]
    return np.unique(_mix(x).view(np.int64))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, text_hash``: the hash tells texts of one doc_id apart."""
    return text_column(df, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))


def sketches(df: DataFrame, words: int, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_shingles, set_id, sketch`` (the ``k`` smallest hashes) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        take_worker("near duplicates", _HASHES.clear)
        for pdf in blocks(batches, "text"):
            sets = [shingle_set(t, words) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text_hash": pdf["text_hash"], "n_shingles": [len(s) for s in sets],
                                "set_id": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                                "sketch": [s[:k] for s in sets]})
        _HASHES.clear()  # workers outlive tasks, and serve other stages too
        give_back()

    return _texts(df, id_col, text_col).mapInPandas(
        run, "doc_id long, text_hash long, n_shingles long, set_id binary, sketch array<long>")


LIST = ["value", "rep", "n", "weight", "df"]


def _need(k: int, percent: int) -> str:
    """Runs that two similar classes have in common at least (see the module's text), by the size ``n`` of either. Of
    a whole set, 1 - percent / 100 of ``n`` values at most are not shared; each breaks ``RUN`` runs."""
    whole = f"floor(least(n, {k}) * {100 - RUN * (100 - percent)} / 100 - {RUN - 1})"
    return f"cast(greatest(1, least({SHARED}, {whole})) as int)"


def _lists(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Inverted lists of the rarest runs of each class (see the module's text); ``value`` is a run's hash.
    ``weight``: how much the class's sketch is shared."""
    def runs(size: int) -> str:
        at = ", ".join(f"sketch[i + {j}]" for j in range(size))
        return f"if(size(sketch) < {size}, array(), transform(sequence(0, size(sketch) - {size}), i -> xxhash64({at})))"

    # Of so few values, all runs may be broken; of the shorter runs, some are whole.
    few = f"size(sketch) * {100 - RUN * (100 - percent)} <= {100 * (RUN - 1)}"
    value = classes.select("rep", "n", F.explode(F.expr(f"if({few}, concat({runs(RUN)}, {runs(RUN - 1)}), {runs(RUN)})")).alias("value"))
    shared = value.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    # Runs of one class alone are the rarest of all; they take places of the prefix and need no list.
    return (value.join(shared, "value")
            .selectExpr("*", "row_number() over (partition by rep, n order by df, value) as place",
                        "count(*) over (partition by rep, n) as present",
                        "cast(100 * sum(ln(df)) over (partition by rep, n) as int) as weight")
            .where(f"place + {_need(k, percent)} <= present + 1").select(*LIST))


def _estimated(pairs: DataFrame, classes: DataFrame, k: int, least: float) -> DataFrame:
    """Pairs whose union sketch doesn't rule them out. Half of each value's bits, in the same order,
    are enough here and half as much to move."""
    sketch = classes.select("rep", F.expr("transform(sketch, x -> cast(shiftright(x, 32) as int))").alias("sketch"))
    a, b = sketch.toDF("a", "sa"), sketch.toDF("b", "sb")
    both = (pairs.join(a, "a").join(b, "b")
            .withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k))
            .withColumn("hits", F.size(F.array_intersect("u", F.array_intersect("sa", "sb")))))
    return both.where(F.col("hits") >= least * F.size("u")).select("a", "b").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * |intersection| >= percent * |union|."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = (None, None)
        for pdf in batches:
            hit = []
            for ta, tb in zip(pdf["ta"], pdf["tb"], strict=True):
                if ta != last[0]:
                    last = (ta, shingle_set(ta, words))
                a, b = last[1], shingle_set(tb, words)
                inter = len(np.intersect1d(a, b, assume_unique=True))
                hit.append(100 * inter >= percent * (len(a) + len(b) - inter))
            yield pdf.loc[hit, ["a", "b"]]
        _HASHES.clear()
        give_back()

    a, b = texts.toDF("a", "ta"), texts.toDF("b", "tb")
    return pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long")


def _compared(groups: DataFrame, texts: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """Links between components in groups ``hub, rep, component``, found block by block."""
    counted = groups.groupBy("hub", "component").agg(F.count("*").alias("c"))
    info = (counted.groupBy("hub").agg(F.sum("c").alias("c"), F.expr("max(struct(c, component))").alias("m"))
            .selectExpr("hub", "m.component large", f"cast(ceil(m.c / {block}) as int) n_large",
                        f"cast(greatest(ceil((c - m.c) / {block}), 1) as int) n_rest"))
    dealt = (groups.join(info, "hub")
             .withColumn("block", F.expr("cast(if(component = large, pmod(xxhash64(rep), n_large), "
                                         "n_large + pmod(xxhash64(rep), n_rest)) as int)"))
             .withColumn("other", F.explode(F.expr("sequence(if(component = large, n_large, 0), n_large + n_rest - 1)")))
             .selectExpr("hub", "least(block, other) i", "greatest(block, other) j", "block", "rep", "component")
             .join(texts.toDF("rep", "text"), "rep"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        pdf = pdf.sort_values(["rep", "text"], kind="stable")
        one, two = pdf[pdf["block"] == i], pdf[pdf["block"] == j]
        a = [shingle_set(t, words) for t in one["text"]]
        b = a if i == j else [shingle_set(t, words) for t in two["text"]]
        found = {}
        if a and b:
            sizes = np.array([len(x) for x in b])
            owner, values = np.repeat(np.arange(len(b)), sizes), np.concatenate(b)
            order = np.argsort(values, kind="stable")
            owner, values = owner[order], values[order]
            reps, components = two["rep"].to_numpy(), two["component"].to_numpy()
            for x, rep, component in zip(a, one["rep"], one["component"], strict=True):
                lo, n = np.searchsorted(values, x, "left"), np.searchsorted(values, x, "right")
                n -= lo
                at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                inter = np.bincount(owner[at], minlength=len(b))
                hit = (100 * inter >= percent * (sizes + len(x) - inter)) & (components != component)
                for y in np.flatnonzero(hit):
                    found.setdefault((component, components[y]), (rep, reps[y]))  # one link joins two components
        if len(_HASHES) > WORDS // 4:
            _HASHES.clear()
        return pd.DataFrame(list(found.values()), columns=["a", "b"], dtype="int64")

    return dealt.groupBy("hub", "i", "j").applyInPandas(run, "a long, b long").distinct()


def _short_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that short lists offer, each as often as they do. A list's members are gathered: they are few."""
    member = F.sort_array(F.collect_list(F.struct("rep", "n"))).alias("m")
    pair = ("flatten(transform(sequence(1, size(m) - 1), i -> transform(filter(slice(m, i + 1, size(m)), "
            f"y -> y.rep <> m[i - 1].rep and 100 * least(y.n, m[i - 1].n) >= {percent} * greatest(y.n, m[i - 1].n)), "
            "y -> struct(m[i - 1].rep as a, y.rep as b))))")
    return (lists.groupBy("value").agg(member).where("size(m) > 1").select(F.explode(F.expr(pair)).alias("p")).select("p.a", "p.b"))


def _with_hubs(lists: DataFrame) -> DataFrame:
    """Long lists with each one's hub (and its size)."""
    hubs = lists.groupBy("value").agg(F.expr("max(struct(weight, -rep as rep, n))").alias("h"))
    return lists.join(hubs.selectExpr("value", "-h.rep hub", "h.n hub_n"), "value")


def _linked(df: DataFrame, words: int, percent: int, k: int, id_col: str, text_col: str,
            small: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sketches, their classes, and ``node, component`` of the classes that are linked (as
    :func:`components` has them: by ``rep``, without the smallest of each component)."""
    sketched = staged(sketches(df, words, k, id_col, text_col), "sketches")
    some = sketched.where("n_shingles > 0 and doc_id is not null")
    # Numbered by class: a doc_id can stand for several texts. Written, so the numbers stay.
    classes = staged(some.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("m"), F.first("n_shingles").alias("n"),
                                                F.first("sketch").alias("sketch"))
                     .select(F.monotonically_increasing_id().alias("rep"), "set_id", "m.doc_id", "m.text_hash", "n", "sketch"),
                     "classes")
    sets = staged(sketched.drop("sketch"), "sets")
    unstage(sketched)
    whole = _texts(df, id_col, text_col)
    size = f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)"
    least = max(0.0, percent / 100 - MARGIN)

    def texts_of(reps: DataFrame) -> DataFrame:
        wanted = classes.join(reps.toDF("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "text_hash")
        return staged(whole.join(wanted, ["doc_id", "text_hash"]).select("rep", "text").distinct(), "texts")

    lists = staged(_lists(classes, k, percent), "lists")
    pairs = _short_pairs(lists.where(F.col("df") <= small), percent)
    long = staged(_with_hubs(lists.where(F.col("df") > small)).where("rep <> hub"), "long")
    pairs = pairs.union(long.where(size).selectExpr("least(rep, hub) a", "greatest(rep, hub) b")).distinct()
    likely = staged(_estimated(pairs, classes, k, least), "likely")
    unstage(lists)
    texts = texts_of(likely.select("a").union(likely.select("b")))
    links = staged(_verified(likely, texts, words, percent).distinct(), "found")
    unstage(texts)
    unstage(likely)
    linked = components(links)
    unstage(links)

    # What is left of long lists: their members by component, as groups.
    member = (long.select("value", "rep", "weight").join(linked.toDF("rep", "component"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    open_ = (member.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                         F.expr("max(struct(weight, -rep as rep))").alias("h"))
             .where("lo < hi").selectExpr("value", "-h.rep hub"))
    groups = staged(member.join(open_, "value").select("hub", "rep", "component").distinct(), "groups")
    unstage(long)
    if not groups.isEmpty():
        texts = texts_of(groups.select("rep"))
        more = staged(_compared(groups, texts, words, percent, block), "found")
        unstage(texts)
        if not more.isEmpty():
            before, linked = linked, components(linked.toDF("a", "b").union(more))
            unstage(before)
        unstage(more)
    unstage(groups)
    return sets, classes, linked


def grouped(df: DataFrame, words: int = 5, percent: int = 80, k: int = SKETCH,
            id_col: str = "doc_id", text_col: str = "text", small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component, component_id`` of every row: ``component`` is a number of the
    component, which no other has (null without words or doc_id), ``component_id`` its smallest doc_id."""
    sets, classes, linked = _linked(df, words, percent, k, id_col, text_col, small, block)
    # Components of several classes: each one's smallest doc_id.
    member = linked.toDF("rep", "component").union(linked.select("component", "component").distinct())
    first = (member.join(classes.select("rep", "doc_id"), "rep").groupBy("component")
             .agg(F.min("doc_id").alias("component_id")))
    of = (classes.select("set_id", "rep", "doc_id").join(member.join(first, "component"), "rep", "left")
          .selectExpr("set_id", "coalesce(component, rep) component", "coalesce(component_id, doc_id) component_id"))
    return (sets.join(of, "set_id", "left")
            .selectExpr("doc_id", "text_hash", "n_shingles",
                        "case when doc_id is not null and n_shingles > 0 then component end component",
                        "case when doc_id is null then null when n_shingles > 0 then component_id else doc_id end component_id"))


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, k: int = SKETCH,
                    id_col: str = "doc_id", text_col: str = "text", small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row: components of the documents linked
    by a Jaccard of ``percent`` / 100 or more over shingles of ``words`` words."""
    return grouped(df, words, percent, k, id_col, text_col, small, block).selectExpr(
        "doc_id", "n_shingles", "component_id", "coalesce(doc_id = component_id, true) kept")


def one_of_each(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` (its columns must have an order), one of each component: that of the smallest doc_id. Rows
    with a null doc_id stay; of rows without words, one of each doc_id and text stays."""
    sets, classes, linked = _linked(df, words, percent, SKETCH, id_col, text_col, SMALL, BLOCK)
    of = (classes.select("set_id", "rep").join(linked.toDF("rep", "component"), "rep", "left")
          .selectExpr("set_id", "coalesce(component, rep) component"))
    rows = (sets.where("doc_id is not null").join(of, "set_id", "left")
            .selectExpr("doc_id", "text_hash", "case when n_shingles > 0 then component end component"))
    # Without a component, each doc_id and text is a group.
    chosen = (rows.groupBy("component", F.expr("if(component is null, doc_id, null)"), F.expr("if(component is null, text_hash, null)"))
              .agg(F.min(F.struct("doc_id", "text_hash")).alias("m")).select("m.*"))
    own = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.select(F.struct(*own).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                      F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_hash"))
    kept = (keyed.where("doc_id is not null").join(chosen, ["doc_id", "text_hash"], "left_semi")
            .groupBy("doc_id", "text_hash").agg(F.min("row").alias("row")))
    return kept.select("row.*").union(keyed.where("doc_id is null").select("row.*"))
