"""Approximate nearest neighbours by a permutation index, for the largest inner product.

Every vector is represented by the order in which it meets a set of pivots, nearest first. Pivots are chosen
farthest first in a seeded sample of ``PIVOT_SAMPLE`` distinct vectors, so a cluster of near copies gives few. Pivot
inverted files hold, per pivot, the vectors with the pivot's place in their order. A query looks up its
nearest pivots, sums up the differences of places (Spearman's footrule), and the vectors of
smallest sums are ranked again by the exact inner product.

Vectors are brought to one length by a further component, which turns the largest inner product into the
smallest angle. Equal vectors are one entry of the index with their smallest ids, as many as a result can
hold. Index and queries are cut into blocks by hash; a task searches one block of queries in one block of
the index and returns its best, so no task holds more than two blocks.

Null vectors, zero vectors and vectors with null or non-finite components take no part, nor do vectors with
another number of components than the most frequent one, nor rows without an id. Ties
go to the smaller id. A query with fewer than ``k`` candidates gets all of them; an empty table gives an empty
result. Rows that repeat an id count once per different vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.llm.common import handed_over

PIVOTS, PIVOT_SAMPLE, LOOKED_UP, CANDIDATE_SHARE, LEAST_CANDIDATES = 256, 4_096, 128, 0.08, 400
INDEX_BLOCK, QUERY_BLOCK = 16_384, 4_096


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part, v as doubles."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(finite)
    return rows.where(F.exists("v", lambda x: x != 0))


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows with one more component, so that all have the length of the longest vector."""
    rest = np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0.0))
    return np.hstack([x, rest[:, None]])


def orders(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Each row's pivots, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable").astype(np.int16)


def spread_out(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``sample``: the first, then always the one farthest from those chosen."""
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


class InvertedFiles:
    """Per pivot, the place that each vector of the block gives it."""

    def __init__(self, x: np.ndarray, pivots: np.ndarray):
        order = orders(x, pivots)
        places = np.empty(order.shape, np.int16)
        np.put_along_axis(places, order, np.arange(len(pivots), dtype=np.int16)[None, :], axis=1)
        self.files = np.ascontiguousarray(places.T)

    def footrule(self, order: np.ndarray, n: int = LOOKED_UP) -> np.ndarray:
        """Sums of place differences over the query's ``n`` nearest pivots."""
        total = np.zeros(self.files.shape[1], np.int32)
        for place, pivot in enumerate(order[:n]):
            total += np.abs(self.files[pivot] - np.int16(place))
        return total


def search_block(
    q: np.ndarray, x: np.ndarray, pivots: np.ndarray, longest: float, k: int,
    share: float = CANDIDATE_SHARE, least: int = LEAST_CANDIDATES, looked_up: int = LOOKED_UP,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query its best rows of ``x``, and their inner products."""
    index = InvertedFiles(lengthened(x, longest), pivots)
    asked = orders(np.hstack([q, np.zeros((len(q), 1))]), pivots)
    wanted = min(len(x), max(least, k, int(np.ceil(share * len(x)))))
    for vector, order in zip(q, asked):
        if wanted < len(x):
            near = np.argpartition(index.footrule(order, looked_up), wanted - 1)[:wanted]
        else:
            near = np.arange(len(x))
        scores = (x[near] * vector).sum(axis=1)
        best = scores >= np.partition(scores, len(scores) - k)[len(scores) - k] if k < len(scores) else np.ones(len(scores), bool)
        yield near[best], scores[best]


def neighbours(
    vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
    n_pivots: int = PIVOTS, seed: int = 5,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query, other rows than its own.

    ``is_query`` is a condition on the column ``id``. ``n_pivots`` pivots are spread over a seeded sample.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    width = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == width.n).withColumn("group", F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256))
    # Equal vectors are one entry: of their ids only the smallest k + 1 can be in a result.
    few = F.row_number().over(Window.partitionBy("group").orderBy("id"))
    entries = (
        rows.select("group", "id").distinct().withColumn("nth", few).where(F.col("nth") <= k + 1)
        .groupBy("group").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )
    distinct = handed_over(rows.groupBy("group").agg(F.first("v").alias("v")).join(entries, "group"), "vectors")
    n_distinct = distinct.count()
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    longest = distinct.agg(F.max(length)).first()[0]
    picked = distinct.orderBy(F.xxhash64(F.lit(seed), "group")).limit(max(n_pivots, PIVOT_SAMPLE)).select("v").collect()
    pivots = spread_out(lengthened(np.array([r.v for r in picked]), longest), n_pivots)
    asking = rows.where(is_query).select("group", F.col("id").alias("query_id")).distinct()
    queries = asking.select("group").distinct().join(distinct.select("group", "v"), "group")
    asked_for = handed_over(queries, "queries")
    q_blocks = max(1, -(-asked_for.count() // QUERY_BLOCK))
    x_blocks = max(1, -(-n_distinct // INDEX_BLOCK))
    place = F.xxhash64("group")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = asked_for.select(F.pmod(place, F.lit(q_blocks)).alias("qb"), each(x_blocks).alias("xb"), "group", "v")
    right = distinct.select(each(q_blocks).alias("qb"), F.pmod(place, F.lit(x_blocks)).alias("xb"), "group", "v", "ids")
    shared = spark.sparkContext.broadcast((pivots, longest))

    def search(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"group": [], "vec_id": [], "score": []}
        if len(asked) and len(block):
            anchors, far = shared.value
            x = np.stack(block.v.to_numpy())
            ids = block.ids.to_numpy()
            for group, (near, scores) in zip(asked.group, search_block(np.stack(asked.v.to_numpy()), x, anchors, far, k + 1)):
                found = [i for r in near for i in ids[r]]
                per_id = np.repeat(scores, [len(ids[r]) for r in near])
                best = np.lexsort((found, -per_id))[: k + 1]
                out["group"] += [group] * len(best)
                out["vec_id"] += [found[b] for b in best]
                out["score"] += per_id[best].tolist()
        return pd.DataFrame(out)

    blockwise = left.groupBy("qb", "xb").cogroup(right.groupBy("qb", "xb")).applyInPandas(
        search, "group string, vec_id long, score double"
    )
    ranked = Window.partitionBy("group").orderBy(F.desc("score"), "vec_id")
    best = (
        blockwise.withColumn("nth", F.row_number().over(ranked)).where(F.col("nth") <= k + 1)
        .groupBy("group").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("found"))
    )
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return (
        asking.join(best, "group")
        .select("query_id", F.posexplode(others).alias("nth", "f"))
        .select("query_id", (F.col("nth") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
    )
