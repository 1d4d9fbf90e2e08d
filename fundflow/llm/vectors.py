"""Shared by the two vector searches: clean vectors, shards, merging of answers.

A search deals the vectors into shards, and sends each query once to each shard that may hold
an answer (a stated query set against all rows). Shards grow with the number of vectors up to
``SHARD_VALUES`` components, so that the copies of a query grow as slowly as memory lets them. In a shard's
task the vectors come first, so what the shard needs is built once; the
queries then stream by in blocks, so a task holds one shard and one block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a shard, at least about (if there are as many), and components in it, at most about.
SHARD_ROWS = 4096
SHARD_VALUES = 8_000_000
#: Queries searched together.
QUERY_BLOCK = 512

#: ``search(ids, vectors)`` is made once a shard; it then answers ``(query ids, query vectors, bounds)``
#: with rows of (query_id, vec_id, score). A bound (NaN: none) is a score that the query has ``k`` answers of already.
Searcher = Callable[[np.ndarray, np.ndarray, np.ndarray], list[tuple]]


def vectors(df: DataFrame, id_col: str, vec_col: str, keep_zero: bool) -> DataFrame:
    """``vec_id, v`` of the rows that take part: an id, and a vector that is neither null nor
    empty and holds no null or non-finite component (nor, unless ``keep_zero``, only zeros)."""
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    ok = ("vec_id is not null and v is not null and size(v) > 0 and "
          "not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    return df.where(ok if keep_zero else f"{ok} and exists(v, x -> x <> 0)")


def one_row_per_id(base: DataFrame, shard_rows: int | None) -> tuple[DataFrame, int, int]:
    """The vectors with one row for each id and dimension (of repeated rows the smallest vector), how many there are, and
    how many make a shard. Vectors are only aggregated if an id repeats; ids alone tell."""
    n, ids, dim = base.agg(F.count(F.lit(1)), F.count_distinct(F.size("v"), F.col("vec_id")), F.max(F.size("v"))).first()
    if ids < n:
        base = base.groupBy(F.size("v").alias("dim"), "vec_id").agg(F.min("v").alias("v")).select("vec_id", "v")
    if shard_rows is None:
        tasks = 2 * base.sparkSession.sparkContext.defaultParallelism
        shard_rows = max(SHARD_ROWS, min(SHARD_VALUES // max(1, dim or 1), ids // tasks))
    return base, ids, shard_rows


def by_shard(dealt: DataFrame, asked: DataFrame, shards: int, make: Callable[[np.ndarray, np.ndarray], Searcher],
             score_type: str, query_block: int) -> DataFrame:
    """Answers of every shard to every query sent to it: ``query_id, vec_id, score``, from the vectors ``dealt``
    (``shard, vec_id, v``) and the queries ``asked`` (``shard, vec_id, v, bound``). Vectors of another
    dimension than the query's are no candidates."""
    both = (dealt.select(F.size("v").alias("dim"), "shard", F.lit(0).alias("asks"), "vec_id", "v", F.lit(None).cast("double").alias("bound"))
            .unionByName(asked.select(F.size("v").alias("dim"), "shard", F.lit(1).alias("asks"), "vec_id", "v",
                                      F.col("bound").cast("double").alias("bound"))))
    schema = f"query_id long, vec_id long, score {score_type}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, search, asking = None, [], None, []

        def answer() -> pd.DataFrame:
            ids, vs, bounds = zip(*asking, strict=True)
            asking.clear()
            rows = search(np.array(ids, np.int64), np.array(vs, np.float64), np.array(bounds, np.float64))
            return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

        for pdf in batches:
            for dim, shard, asks, vec_id, v, bound in pdf.itertuples(index=False, name=None):
                if (dim, shard) != at:
                    if asking:
                        yield answer()
                    at, held, search = (dim, shard), [], None
                if not asks:
                    held.append((vec_id, v))
                    continue
                if search is None:
                    if not held:
                        continue
                    ids, vs = zip(*held, strict=True)
                    search = make(np.array(ids, np.int64), np.array(vs, np.float64))
                    held = [None]
                asking.append((vec_id, v, bound))
                if len(asking) >= query_block:
                    yield answer()
        if asking:
            yield answer()

    # A shard's number is its partition's: no task has two while another has none.
    return (both.repartitionById(shards, F.col("shard"))
            .sortWithinPartitions("dim", "shard", "asks", "vec_id").mapInPandas(run, schema))


def hashed_shards(base: DataFrame, n: int, shard_rows: int) -> tuple[DataFrame, int]:
    """Vectors dealt into shards by a hash of their id."""
    shards = max(1, math.ceil(n / shard_rows))
    return base.select("vec_id", "v", F.expr(f"cast(pmod(xxhash64(vec_id), {shards}) as int)").alias("shard")), shards


def to_all(queries: DataFrame, first: int, shards: int) -> DataFrame:
    """Queries sent to the shards from ``first`` to ``shards`` - 1, without a bound."""
    return queries.select(F.explode(F.sequence(F.lit(first), F.lit(shards - 1))).alias("shard"), "vec_id", "v",
                          F.lit(None).cast("double").alias("bound"))


def ranked(answers: DataFrame, k: int, nearest: bool) -> DataFrame:
    """The ``k`` best answers of a query: ``query_id, rank, vec_id, score``. Each task cuts its
    own rows of a query to ``k`` before they are shuffled."""
    score = F.col("score") if nearest else F.col("score").desc()
    w = Window.partitionBy("query_id").orderBy(score, "vec_id")
    return (answers.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` smallest of each row of ``scores``, ties to the smaller id."""
    order = np.lexsort((ids, scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
