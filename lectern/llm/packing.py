"""Best-fit packing by exact complements (operator 5)."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import cut, relieved, table
from lectern.llm.tokens import CACHED_WORDS, encoder, vocabulary

SEQUENCE = 2048
END_ID = 0
#: Pieces that one ranking group holds, about.
RANKED = 250_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, cached: int = CACHED_WORDS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document's ids and end id, cut at every size ids.
    A null or empty text has the end id alone; rows repeated in docs are packed each. cached: words whose ids a
    worker keeps (about 400 bytes each at most)."""
    path = path or vocabulary()

    def cut_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path, cached).encode, END_ID.to_bytes(4, "little")
        for batch in batches:
            texts = (x.as_py() or b"" for x in batch.column("text"))
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts), strict=True):
                ids += end
                for n, at in enumerate(range(0, len(ids), size * 4)):
                    part = ids[at : at + size * 4]
                    for kept, value in zip(out, (doc, n, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        kept.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(relieved(cut_up, "tokens"), PIECES)


class Complements:
    """Which one, two or three of the available lengths sum to a gap exactly.

    counts[x] pieces of length x are left, and only become fewer. For each sum there is a place in the order of its
    pairs, and one in that of its triples, before which all are used up: so each is given up once, however
    often its sum is asked for."""

    def __init__(self, counts: list[int]) -> None:
        self.counts, size = counts, len(counts)
        self.pair_at = [s - 1 for s in range(size)]  # the larger of the pair, from the largest down
        self.triple_at = [s - 2 for s in range(size)]

    def of(self, gap: int) -> tuple[int, ...] | None:
        if not gap:
            return ()
        if self.counts[gap]:
            return (gap,)
        return self.pair(gap) or self.triple(gap)

    def pair(self, total: int, held: int = 0) -> tuple[int, int] | None:
        """A pair with this sum, besides one piece of length held."""
        counts, x = self.counts, self.pair_at[total]
        while 2 * x >= total and x:
            y = total - x
            if not counts[x] or not counts[y] or x == y and counts[x] < 2:
                if self.pair_at[total] == x:
                    self.pair_at[total] = x - 1
            elif counts[x] >= 1 + (x == held) + (x == y) and counts[y] >= 1 + (y == held) + (x == y):
                return x, y
            x -= 1
        return None

    def triple(self, total: int) -> tuple[int, int, int] | None:
        counts, x = self.counts, self.triple_at[total]
        while 3 * x >= total and x:
            if counts[x] and (found := self.pair(total - x, x)):
                return x, *found
            rest = total - x
            if self.triple_at[total] == x and (not counts[x] or 2 * self.pair_at[rest] < rest):
                self.triple_at[total] = x - 1
            x -= 1
        return None


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, how many such), which use up counts (of pieces, by length).

    From the longest length down, a piece's gap is looked up among the sums of one, two and three available
    lengths; a combination that fills it exactly is used as often as its lengths last. Pieces without one are
    filled by the largest lengths that fit. The work follows the number of lengths, not of pieces."""
    left = [0] * (size + 1)
    for length, n in counts.items():
        left[length] += n
    index = Complements(left)
    out: list[tuple[tuple[int, ...], int]] = []
    for first in range(size, 0, -1):
        while left[first]:
            left[first] -= 1  # from here on this piece is placed, whatever fills its gap
            found = index.of(size - first)
            if found is None:
                found, gap = (), size - first
                while gap and (best := next((x for x in range(min(gap, first), 0, -1) if left[x] > found.count(x)), 0)):
                    found, gap = (*found, best), gap - best
            uses = Counter((first, *found))
            times = 1 + min((left[x] - n + (x == first)) // n for x, n in uses.items())
            left[first] += 1
            for x, n in uses.items():
                left[x] -= n * times
            out.append(((first, *found), times))
    return out


def slots(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length, in order of rank: the first rank of each slot, the first sequence, and the place in it."""
    used: Counter[int] = Counter()
    found: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for lengths, times in planned:
        at = 0
        for x in lengths:
            found.setdefault(x, []).append((used[x], base, at))
            used[x] += times
            at += x
        base += times
    return {x: tuple(np.array(v, "int64").T) for x, v in found.items()}


def pack(cut_pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds (sequence_id, offset) to pieces. cut_pieces is read twice and should be cut from its lineage.

    Only the number of pieces of each length (at most size numbers) goes to the driver, and the plan made of
    them goes back. A piece finds its place by its rank among those of its length; the ranks are taken in
    groups of about RANKED pieces, so that one common length is no single task."""
    groups = max(8, cut_pieces.count() // RANKED)
    grouped = cut_pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    tallied = grouped.groupBy("length", "part").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = cut(tallied.select("length", "part", "n", F.coalesce(ahead, F.lit(0)).alias("ahead")))
    counts = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(plan(counts, size))

    def placed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(batch), "int64"), np.zeros(len(batch), "int64")
            for x in np.unique(lengths):
                mine = lengths == x
                first, base, at = places[int(x)]
                slot = np.searchsorted(first, ranks[mine], "right") - 1
                sequence[mine], offset[mine] = base[slot] + ranks[mine] - first[slot], at[slot]
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = grouped.withColumn("n", F.row_number().over(order)).join(offsets.drop("n"), ["length", "part"])
    ranked = ranked.select(*[c.split()[0] for c in PIECES.split(", ")], (F.col("n") - 1 + F.col("ahead")).alias("rank"))
    return ranked.mapInPandas(relieved(placed), PIECES + ", sequence_id long, offset long")


def packed(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, cached: int = CACHED_WORDS) -> DataFrame:
    return pack(cut(pieces(docs, path, size, cached)), size)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
