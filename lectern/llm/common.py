"""Shared pieces: table access, lineage cuts, grouped streaming, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Edges up to this number (16 bytes each) are joined up by one task.
LOCAL_EDGES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a temporary one, in local mode only."""
    sc = spark.sparkContext
    known = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if known:
        return known
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(made := tempfile.mkdtemp(prefix="lectern-"))
    return made


def spare(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder now, and goes on from there; the files go with the DataFrame."""
    sc = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: How to drop what a worker keeps between tasks, by name.
KEPT: dict[str, Callable[[], None]] = {}


def relieved(run: Callable, *keeps: str) -> Callable:
    """run, a function over a task's batches, that drops what other operators keep in the worker, but for the names in
    keeps, and gives freed memory back when the task is done: Python workers live on between tasks and stages."""

    def inner(batches: Iterable) -> Iterator:
        from lectern.llm import common  # the worker's own, as this function travels by value

        for name, drop in common.KEPT.items():
            if name not in keeps:
                drop()
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return inner


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key are neighbours in one partition, for key_runs()."""
    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)


def key_runs(batches: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames made of whole groups of equal keys, from batches in the order of the key. Groups that
    reach over batches are joined, so memory holds a batch and the largest group."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        last = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if (keys != keys[-1]).any() else 0
        if last:
            yield pd.concat([*held, batch.iloc[:last]], ignore_index=True) if held else batch.iloc[:last]
            held = [batch.iloc[last:]]
        elif held and held[-1][key].iloc[-1] != keys[0]:
            yield pd.concat(held, ignore_index=True)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def bounds(keys: np.ndarray) -> np.ndarray:
    """Where groups of equal neighbours start, and the end."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


class Forest:
    """Union-find over hashable nodes; a root is the smallest node of its tree."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            self.up.setdefault(a, a)
            return False
        low, high = (a, b) if a < b else (b, a)
        self.up.setdefault(low, low)
        self.up[high] = low
        return True


def _join_up(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            forest.join(a, b)
    nodes = list(forest.up)
    yield pd.DataFrame({"node": np.array(nodes, "int64"), "root": np.array([forest.find(x) for x in nodes], "int64")})


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, root) of every node of edges (a, b: long); root is the smallest node that links reach.

    Each round, every node takes the name of the neighbour (or itself) that comes first in an order drawn
    anew by a hash; the graph is contracted by these names, which removes a constant share of its nodes,
    hubs included, as only minima travel. Every round is cut to the checkpoint folder. What is left with at
    most local_edges edges is joined up in one task."""
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges, names, turn = cut(ordered.distinct()), None, 0
    while edges.count() > local_edges:
        turn += 1
        both = edges.union(edges.select("b", "a"))
        first = both.groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(turn))).alias("b"))
        ahead = F.xxhash64("b", F.lit(turn)) < F.xxhash64("a", F.lit(turn))
        named = cut(first.select(F.col("a").alias("old"), F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("new")))
        at_b = named.select(F.col("old").alias("b"), F.col("new").alias("to_b"))
        at_a = named.select(F.col("old").alias("a"), F.col("new").alias("to_a"))
        moved = edges.join(at_a, "a").join(at_b, "b").where("to_a <> to_b")
        edges = cut(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
        if names is None:
            names = named.select(F.col("old").alias("node"), F.col("new").alias("name"))
        else:
            step = named.select(F.col("old").alias("name"), "new")
            names = cut(names.join(step, "name", "left").select("node", F.coalesce("new", "name").alias("name")))
    rest = edges.coalesce(1).mapInPandas(_join_up, "node long, root long")
    if names is None:
        return rest
    ended = names.join(rest.select(F.col("node").alias("name"), "root"), "name", "left")
    ended = cut(ended.select("node", F.coalesce("root", "name").alias("name")))
    least = ended.groupBy("name").agg(F.min("node").alias("root"))
    return ended.join(least, "name").select("node", "root")
