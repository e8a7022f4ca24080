"""Exact top-k inner-product search without random access (operator 1)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import cut, table

K = 5
#: Rows of a block: candidates at least and at most, and queries at most.
LEAST, MOST, ASKED = 512, 32_768, 8_192
#: Entries first read from each list, and by what the depth grows.
DEPTH, GROWTH = 32, 4
#: Rows of a set of lists: few enough for a processor's cache. A block has as many sets as it takes.
LISTED = 512
#: Reading stops for good when a set of lists has at most this share of its rows left, and outsiders can't qualify.
CONTENDERS = 1 / 32

HITS = "query_id long, vec_id long, score long"


def quantized(vector: Column) -> Column:
    """floor(256 * x) of each component, in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long"))


def usable(vector: Column) -> Column:
    """False for null vectors and those with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


class Lists:
    """Some rows of a block in the order of each component, ascending ([0]) and descending ([1]): order[.][d] has the
    rows, values[.][d] the components in that order, places[.][d] each row's place in it (to tell what was read)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        order = np.argsort(vectors, axis=0, kind="stable").T
        values = np.take_along_axis(vectors.T, order, 1).astype(float)
        places = np.empty_like(order)
        np.put_along_axis(places, order, np.arange(len(ids))[None, :], 1)
        self.order, self.values = np.stack([order, order[:, ::-1]]), np.stack([values, values[:, ::-1]])
        self.places = np.stack([places, len(ids) - 1 - places])


def best(lists: Lists, query: np.ndarray, own: int, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores, depth): the k best of the lists' rows for one query, without the query's own rows, ties to smaller
    ids, and how deep the lists were read. Scores are clipped to 64 bits; those below floor needn't be found.

    Each list is read from the end that the sign of the query's component makes the better one, in growing steps,
    without looking a row up elsewhere. What a row has shown so far bounds its score from below (with the lists'
    far ends for the rest) and from above (with the reading places for the rest). Once a row that was never read
    can't reach the k-th best lower bound, only rows whose upper bound can are contenders; when these are few, or
    the lists have ended, which makes both bounds one, their scores are resolved. Bounds are doubles, widened by
    their rounding."""
    ids, n, used, edge = lists.ids, len(lists.ids), np.flatnonzero(query), 2.0**63
    weights, own_rows, way = query[used].astype(float), ids == own, (query[used] > 0).astype(int)
    order, values = lists.order[way, used], lists.values[way, used] * weights[:, None]
    low = values[:, -1]
    most = np.maximum(np.abs(values[:, 0]), np.abs(low)).sum()
    slack = most * (len(used) + 2) * 2.0**-50 if most >= 2**53 else 0.0
    lower, start, left = np.where(own_rows, -np.inf, low.sum()), 0, np.flatnonzero(~own_rows)
    while start < n and len(used):
        depth = min(n, max(DEPTH, start * GROWTH))
        lower += np.bincount(order[:, start:depth].ravel(), (values[:, start:depth] - low[:, None]).ravel(), n)
        front, start = values[:, depth - 1], depth
        least = max(floor, np.partition(lower, n - k)[n - k] if n >= k else -np.inf) - slack
        least = min(least, edge - slack) if least > slack - edge else -np.inf  # clipped scores are ties
        if depth == n or front.sum() + slack < least:
            upper = lower if depth == n else lower + (front - low) @ (lists.places[way, used] >= depth).astype(float)
            left = np.flatnonzero(~own_rows & (upper + slack >= least))
            if len(left) <= max(k, n * CONTENDERS):
                break
    exact = _scores(lists.vectors[left], query, most)
    found = np.lexsort((ids[left], ~exact))[:k]  # ~ turns the order of longs round without overflow
    return ids[left][found], exact[found], start


def _scores(vectors: np.ndarray, query: np.ndarray, most: float) -> np.ndarray:
    """Inner products as longs; those that don't fit become the nearest that does."""
    if most < 2**62:
        return vectors @ query
    edge = np.iinfo("int64")
    return np.array([min(max(x, edge.min), edge.max) for x in vectors.astype(object) @ query.astype(object)], "int64")


def search(block: pd.DataFrame, k: int = K) -> pd.DataFrame:
    """The k best candidates of a block for each of its queries."""
    asked, given = block[block["asks"]], block[~block["asks"]]
    out: list[pd.DataFrame] = []
    if len(asked) and len(given):
        ids = given["vec_id"].to_numpy("int64")
        rows = given["v"].to_list()
        dims = max(max(map(len, rows)), max(map(len, asked["v"])), 1)
        vectors = _matrix(rows, dims)
        sets = [Lists(ids[i : i + LISTED], vectors[i : i + LISTED]) for i in range(0, len(ids), LISTED)]
        for own, q in zip(asked["vec_id"].to_numpy("int64"), asked["v"], strict=True):
            query, found, scores = _matrix([q], dims)[0], np.zeros(0, "int64"), np.zeros(0, "int64")
            for one in sets:  # what the sets before have shown is a lower bound for the next
                more, high, _ = best(one, query, own, k, float(scores[-1]) if len(scores) == k else -np.inf)
                found, scores = np.append(found, more), np.append(scores, high)
                order = np.lexsort((found, ~scores))[:k]
                found, scores = found[order], scores[order]
            out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": scores}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def _matrix(rows: list[np.ndarray], dims: int) -> np.ndarray:
    if all(len(r) == dims for r in rows):
        return np.array([np.asarray(r, "int64") for r in rows])
    out = np.zeros((len(rows), dims), "int64")
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def top_k(vectors: DataFrame, asks: Column, k: int = K, least: int = LEAST, most: int = MOST, asked: int = ASKED) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows for each row of vectors (vec_id, v) that asks.

    Queries and candidates are dealt into blocks whose sizes have bounds, each query block meets each candidate
    block in a task of its own, and the blocks' results are ranked. A row's block doesn't depend on its id or
    vector, so copies spread. A vector of any length is held whole by each task that compares it. Rows that share the query's vec_id are its own; rows with a null vec_id take no part. Vectors of other lengths count as
    padded with zeros. Of several rows with a query's vec_id the results are of them all, ranked as one."""
    rows = cut(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "v", F.coalesce(asks, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("n")).where("vec_id IS NOT NULL"))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asking")).first()
    size = min(max(sizes["n"] // 24, least), most)
    wide, high = max(1, -(-sizes["n"] // size)), max(1, -(-sizes["asking"] // asked))
    place = F.xxhash64("n")
    given = rows.select("vec_id", "v", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("g"), F.pmod(place, F.lit(wide)).cast("int").alias("s"))
    asking = rows.where("asks").select("vec_id", "v", "asks", F.pmod(place, F.lit(high)).cast("int").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("s"))
    blocks = given.union(asking).groupBy("g", "s")
    found = blocks.applyInPandas(lambda block: search(block, k), HITS)
    # The rank is taken of k rows a block and query, or wide * k rows a query.
    ranked = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.bitwise_not("score").alias("s"), "vec_id"))), 1, k).alias("x"))
    return ranked.select("query_id", F.posexplode("x").alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.bitwise_not("x.s").alias("score"))


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding")))
    return top_k(rows.select("vec_id", quantized(F.col("embedding")).alias("v")), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
           FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
