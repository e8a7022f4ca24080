"""Near-duplicate vectors by randomly rotated binary codes (operator 7)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import bounds, components, cut, dealt, key_runs, relieved, table
from lectern.llm.topk import usable

COSINE = 0.95
#: Share of pairs exactly at the threshold that may never meet in a bucket.
MISSED = 0.001
#: Vectors that a bucket should have, about, and those that a task compares at most with each other.
BUCKET, BLOCK = 32, 2_048
#: Standard errors of the estimate that its confidence bound allows for.
ERRORS = 4.0


def units(rows: list[np.ndarray]) -> np.ndarray:
    """Vectors of one length, scaled to length 1; none may be zero."""
    x = np.array([np.asarray(r, "float64") for r in rows])
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@lru_cache(maxsize=256)
def rotation(dims: int, seed: int) -> np.ndarray:
    """A random rotation, the same for each dims and seed."""
    q, r = np.linalg.qr(np.random.default_rng([dims, seed]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def keys(n: int, cosine: float = COSINE, missed: float = MISSED) -> tuple[int, int]:
    """Bits of a bucket key and number of keys for n vectors: buckets of about BUCKET vectors, and so many keys
    that a pair at the threshold shares at least one but for a share of missed."""
    same = 1 - math.acos(cosine) / math.pi  # of a bit
    bits = max(4, min(31, math.ceil(math.log2(max(n, 2) / BUCKET))))
    return bits, math.ceil(math.log(missed) / math.log(1 - same**bits))


def linked(ids: np.ndarray, own: np.ndarray, other: np.ndarray, vectors: np.ndarray, keyed: np.ndarray, turn: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (positions) of unit vectors of one bucket with at least the cosine.

    A vector's stored code is the signs of its rotated components, with the inner product of the vector and its
    code as correction factor. The rotated other vector times the code over that factor estimates the pair's
    inner product without bias, with an error of a known size; only pairs whose upper bound reaches the cosine
    are computed anew, in double precision. A pair counts in the bucket of the first key that both share.
    own, other: which positions stand on either side, where a large bucket is compared block by block."""
    dims = vectors.shape[1]
    rotated = (vectors @ rotation(dims, 0).T).astype("float32")
    code = np.where(rotated >= 0, 1, -1).astype("float32") / np.float32(math.sqrt(dims))
    fit = (rotated * code).sum(1)
    error = ERRORS * np.sqrt(np.maximum(1 - fit**2, 0)) / fit / math.sqrt(max(dims - 1, 1)) + 1e-5
    left, right = [], []
    for at in range(0, len(own), 512):
        mine = own[at : at + 512]
        upper = (rotated[mine] @ code[other].T) / fit[other] + error[other]
        i, j = np.nonzero(upper >= cosine)
        i, j = mine[i], other[j]
        real = i < j if own is other else ids[i] != ids[j]
        left.append(i[real])
        right.append(j[real])
    i, j = np.concatenate(left), np.concatenate(right)
    real = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= cosine
    i, j = i[real], j[real]
    earlier = np.zeros(len(i), bool)
    for t in range(keyed.shape[1]):
        earlier |= (t < turn[i]) & (keyed[i, t] == keyed[j, t])
    return i[~earlier], j[~earlier]


def near(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of vectors (vec_id, v array of numbers), one row for each row.

    n_links counts the other rows whose cosine with this one is found to be at least cosine. Equal vectors are
    one class, which takes the smallest id; what meets in buckets are the classes. A rotation takes the square of a
    vector's length, so lengths of some thousands are the end. An empty table gives no rows; other columns play no part. Vectors of other lengths never link. A row with a null vec_id
    counts with others of its vector and gets their component; where none of them has an id it links with nothing. Rows that share a vec_id are rows of their own."""
    rows = cut(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(F.col("v")) & F.exists("v", lambda x: x != 0), F.col("v")).alias("v")))
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("class"), F.count("*").alias("n"))
    classes = cut(classes.where("class IS NOT NULL"))
    bits, turns = keys(classes.count(), cosine)

    def keyed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turned: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype="int64")
        for batch in batches:
            found = np.zeros((len(batch), turns), "int64")
            v, sizes = batch["v"].to_numpy(), batch["v"].map(len).to_numpy()
            for dims in np.unique(sizes):
                if dims not in turned:
                    need = math.ceil(bits * turns / dims)
                    turned[dims] = np.concatenate([rotation(int(dims), seed) for seed in range(1, need + 1)])[: bits * turns]
                mine = np.flatnonzero(sizes == dims)
                signs = units(v[mine]) @ turned[dims].T >= 0
                found[mine] = (signs.reshape(len(mine), turns, bits) * weights).sum(2)
            yield pd.DataFrame({"class": batch["class"], "n": batch["n"], "v": v, "codes": list(found)})

    kind = classes.schema["v"].dataType.simpleString()
    coded = classes.mapInPandas(relieved(keyed), f"class long, n long, v {kind}, codes array<int>")
    # A bucket's name holds the vector's length, so that vectors of other lengths don't meet.
    spread = cut(coded).select("class", "n", "v", "codes", F.posexplode("codes").alias("turn", "code"))
    spread = spread.withColumn("key", F.xxhash64("turn", "code", F.size("v")))
    large = spread.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    blocks = F.coalesce(F.ceil(F.col("size") / (BLOCK // 2)), F.lit(1)).cast("int")
    placed = spread.join(large, "key", "left").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), F.col("blocks")).cast("int"))
    # Block i meets the blocks j >= i: a row goes to each pair that its block is in.
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    spread = placed.withColumn("pair", F.explode(meet)).withColumn("key", F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", "pair.i", "pair.j")))
    spread = spread.select("key", "class", "n", "v", "codes", "turn", F.when(F.col("pair.i") == F.col("pair.j"), F.lit(-1)).otherwise(F.when(F.col("block") == F.col("pair.i"), 0).otherwise(1)).alias("side"))

    def compared(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in key_runs(batches, "key"):
            edges = bounds(group["key"].to_numpy())
            ids, n, side, turn = (group[c].to_numpy() for c in ("class", "n", "side", "turn"))
            v, codes = group["v"].to_numpy(), group["codes"].to_numpy()
            out: list[tuple[np.ndarray, ...]] = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                sizes = {len(x) for x in v[lo:hi]} if hi - lo > 1 else ()
                for dims in sizes:  # one, unless two keys' hashes are the same
                    mine = np.arange(lo, hi) if len(sizes) == 1 else np.array([k for k in range(lo, hi) if len(v[k]) == dims])
                    own = np.flatnonzero(side[mine] <= 0)
                    other = own if side[lo] < 0 else np.flatnonzero(side[mine] > 0)
                    if len(own) and len(other):
                        i, j = linked(ids[mine], own, other, units(v[mine]), np.stack(codes[mine]), turn[mine], cosine)
                        if len(i):
                            out.append(_summed(ids[mine], n[mine], i, j))
            if out:
                a, b, links = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"a": a, "b": b, "links": links})

    found = cut(dealt(spread, "key").mapInPandas(relieved(compared), "a long, b long, links long"))
    links = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b IS NOT NULL AND a <> b").select("a", "b"))
    named = classes.join(links, "class", "left").join(joined.select(F.col("node").alias("class"), "root"), "class", "left")
    named = named.select("v", F.coalesce("root", "class").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = rows.join(named, "v", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _summed(ids: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
    """A row for each class that has links here: their number in rows, and one link of a forest that joins the
    bucket's linked classes (b), so that rows grow with the classes and not with the pairs."""
    links = np.bincount(i, n[j], len(ids)) + np.bincount(j, n[i], len(ids))
    root, mine = np.arange(len(ids)), np.flatnonzero(links)
    while True:
        low, new = np.minimum(root[i], root[j]), root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == root).all():
            return ids[mine], ids[root[mine]], links[mine].astype("int64")
        root = new[new]


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("v")))
