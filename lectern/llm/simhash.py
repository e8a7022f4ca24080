"""SimHash near-dedup with pigeonring candidates (operator 2)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import bounds, components, cut, dealt, key_runs, relieved, spare, table

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Buckets above this are joined up by pivots, smaller ones pair by pair; the ring's chain is asked in both.
SMALL = 64


def shingle_hashes(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of a whole text's words in lower case, repeats included; of all words, if fewer."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: A-Z and ASCII white space alone
    if not words:
        return np.zeros(0, "<u8")
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) > width else [b" ".join(words)]
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), "<u8")


def voted(hashes: np.ndarray) -> np.uint64:
    """The number whose bits are set in over half of the hashes; 0 for none."""
    votes = np.zeros(64, "int64")
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(part.view("uint8").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="uint32")
    return np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0]


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The SimHash of a whole text's word shingles."""
    return int(voted(shingle_hashes(text, width)))


def fingerprints(docs: DataFrame, width: int = SHINGLE, *more: str) -> DataFrame:
    """(doc_id, more long..., fp long) of whole texts; null and blank texts have 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py() or b"", width) for x in batch.column("text")], "uint64")
            columns = [*(batch.column(c) for c in ("doc_id", *more)), pa.array(found.view("int64"))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *more, "fp"])

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(relieved(run), ", ".join(f"{c} long" for c in ("doc_id", *more, "fp")))


class Ring:
    """The 64 bits as a ring of distance + 1 segments.

    If two fingerprints differ in at most distance bits, going round from some segment the differences of the
    first l segments sum to at most l * distance / segments, for every l. With one segment more than bits, that
    is: none in the first, at most one in the first two, and so on. So the pair is found under the name of its
    first segment and the next, given the two as they are and with each bit of the second turned; and the rest
    of the chain is checked before the full distance."""

    def __init__(self, distance: int = DISTANCE) -> None:
        self.distance, self.segments = distance, distance + 1
        if not 2 <= distance <= 15:
            raise ValueError("distance must be between 2 and 15")
        edges = [round(64 * i / self.segments) for i in range(self.segments + 1)]
        self.lows, self.widths = edges[:-1], [b - a for a, b in zip(edges, edges[1:], strict=False)]

    def part(self, fps: np.ndarray, i: int) -> np.ndarray:
        return (fps >> np.uint64(self.lows[i])) & np.uint64((1 << self.widths[i]) - 1)

    def names(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(name, position in fps, asks) of all names; asks is false for the segments as they are."""
        out = []
        for i in range(self.segments):
            j = (i + 1) % self.segments
            stem = (np.uint64(i) << np.uint64(58)) | (self.part(fps, i) << np.uint64(self.widths[j]))
            second, where = self.part(fps, j), np.arange(len(fps))
            out.append((stem | second, where, np.zeros(len(fps), bool)))
            out += [(stem | (second ^ np.uint64(1 << b)), where, np.ones(len(fps), bool)) for b in range(self.widths[j])]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def near(self, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which pairs pass the chain from their first segment on, and then the full distance."""
        differ = a ^ b
        left, total = np.arange(len(a)), np.zeros(len(a), "int64")
        for step in range(self.segments):
            i = (first[left] + step) % self.segments
            low, wide = np.array(self.lows, "uint64")[i], np.array(self.widths, "uint64")[i]
            total = total + np.bitwise_count((differ[left] >> low) & ((np.uint64(1) << wide) - np.uint64(1)))
            ok = total * self.segments <= (step + 1) * self.distance
            left, total = left[ok], total[ok]
        out = np.zeros(len(a), bool)
        out[left[np.bitwise_count(differ[left]) <= self.distance]] = True
        return out


def _all_near(fps: np.ndarray, distance: int, ring: Ring | None = None, first: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join up what any links among fps would, at most one for each. With a ring, a link is a pair that passes
    its chain from the segment first on, else any within distance. Pivots take what is near them; then only the balls
    whose pivots are close enough, and that aren't joined yet, are compared."""

    def close(one: int, others: np.ndarray) -> np.ndarray:
        if ring is None:
            return np.bitwise_count(fps[others] ^ fps[one]) <= distance
        return ring.near(np.full(len(others), fps[one]), fps[others], np.full(len(others), first))

    links, balls, rest = [], [], np.arange(len(fps))
    while len(rest):
        near = close(rest[0], rest)
        balls.append(rest[near])
        links.append((np.full(near.sum(), rest[0]), rest[near]))
        rest = rest[~near]
    up = list(range(len(balls)))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    pivots = fps[[b[0] for b in balls]]
    for x in range(len(balls)):
        for y in np.flatnonzero(np.bitwise_count(pivots[x + 1 :] ^ pivots[x]) <= 3 * distance) + x + 1:
            if find(x) != find(int(y)):
                for p in balls[x]:
                    if len(hit := balls[y][close(p, balls[y])]):
                        links.append((np.array([p]), hit[:1]))
                        up[find(x)] = find(int(y))
                        break
    return links


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (fp) at most distance bits apart that join up all that are.

    A bucket holds distinct fingerprints that are alike in two segments (26 bits), whatever the number of their
    documents, at 17 bytes each. Where near copies crowd a bucket, pivots join them up without their pairs."""
    ring = Ring(distance)

    def named(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                own = batch["fp"].to_numpy()[at : at + 2_000].view("uint64")
                name, where, asks = ring.names(own)
                yield pd.DataFrame({"name": name.view("int64"), "fp": own[where].view("int64"), "asks": asks})

    def compared(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in key_runs(batches, "name"):
            name, fp, asks = group["name"].to_numpy(), group["fp"].to_numpy().view("uint64"), group["asks"].to_numpy()
            edges = bounds(name)
            sizes = np.diff(edges)
            large = sizes > SMALL
            in_large = np.repeat(large, sizes)
            first = (name.view("uint64") >> np.uint64(58)).astype("int64")
            out = []
            for step in range(1, int(sizes[~large].max(initial=1))):
                i = np.flatnonzero((name[step:] == name[:-step]) & ~in_large[step:] & ~(asks[step:] & asks[:-step]))
                if len(i):
                    j = i + step
                    ok = ring.near(fp[i], fp[j], first[i])
                    out.append((fp[i[ok]], fp[j[ok]]))
            for lo, hi in zip(edges[:-1][large], edges[1:][large], strict=True):
                own = np.unique(fp[lo:hi])
                out += [(own[i], own[j]) for i, j in _all_near(own, distance, ring, int(first[lo]))]
            a, b = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, "uint64"),) * 2
            yield pd.DataFrame({"a": a.view("int64"), "b": b.view("int64")}).query("a != b").drop_duplicates()

    spread = fps.select("fp").mapInPandas(relieved(named), "name long, fp long, asks boolean")
    return dealt(spread, "name").mapInPandas(relieved(compared), "a long, b long")


def near_groups(docs: DataFrame, distance: int = DISTANCE, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) of each row of docs. Equal fingerprints are one class before any comparison;
    component_id is the smallest doc_id that links reach. Null and blank texts have fingerprint 0 and link like
    any other; a row with a null doc_id gets its component's id, null if it has none."""
    rows = cut(fingerprints(docs, width))
    return rows.join(_components(rows, distance), "fp").select("doc_id", "fp", "component_id")


def _components(rows: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component_id) of each fingerprint in rows (doc_id, fp)."""
    classes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = components(links(classes, distance))
    grouped = classes.join(joined.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    grouped = cut(grouped)
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return grouped.join(smallest, "root").select("fp", "root", "component_id")


def one_each(docs: DataFrame, first: DataFrame) -> DataFrame:
    """One row of docs for each name (of repeats.named) in first (name); of rows repeated whole, any."""
    name = spare(docs, "name")
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    left = docs.withColumn(name, F.xxhash64(F.col("doc_id").cast("long"), F.length(text), text)).join(first.select(F.col("name").alias(name)), name)
    return left.dropDuplicates([name]).select(*docs.columns)


def first_of_groups(docs: DataFrame, distance: int = DISTANCE, width: int = SHINGLE) -> DataFrame:
    """docs with one row of each group of near copies: the one with the smallest doc_id (of equals, the smallest
    hash of id and text; of rows repeated whole, any). A row without a doc_id stays if its group has no other.
    Other columns pass, whatever their names."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    named = docs.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("long"), F.length(text), text).alias("name"))
    rows = cut(fingerprints(named, width, "name"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "name")
    return one_each(docs, rows.join(_components(rows, distance), "fp").groupBy("root").agg(F.min_by("name", order).alias("name")))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
