"""Groups of documents whose word shingles are alike: SimHash candidates, widened to a stated similarity.

Fingerprints few bits apart find copies with few edits. A similarity of 0.8 moves a tenth of all bits and more, out
of the reach of any names that a ring of segments could give, so here each document also has banded minima of its
shingles' hashes as names, and every pair that any of these brings together is looked at. A first turn joins what
neighbours in buckets can; a second turn takes all pairs that share a bucket and aren't joined yet."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import bounds, components, cut, dealt, key_runs, relieved
from lectern.llm.repeats import mix, named, picked, stored
from lectern.llm.simhash import DISTANCE, links, one_each, shingle_hashes, voted

WIDTH, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares a band of three minima with probability 0.51, and one of twelve with 0.9998.
BANDS, ROWS = 12, 3
#: Neighbours in a bucket that a member is compared with in the first turn, besides the bucket's first.
NEXT = 3
#: Members of a bucket that a task compares at most with each other in the second turn; larger ones meet block by block.
BLOCK = 2_048
#: Bits of the largest sketch.
SKETCH = 1 << 17


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of a text's shingles; none for a blank one."""
    return np.unique(shingle_hashes(text, width))


def bands(hashes: np.ndarray) -> np.ndarray:
    """BANDS names, each made of the minima of ROWS orders of the hashes."""
    if not len(hashes):
        return np.zeros(BANDS, "int64")
    least = np.array([mix(hashes ^ np.uint64(1_000_003 * (k + 1))).min() for k in range(BANDS * ROWS)]).reshape(BANDS, ROWS)
    name = np.zeros(BANDS, "uint64")
    for k in range(ROWS):
        name = mix(name * np.uint64(3) + least[:, k])
    return name.view("int64")


def sketch_bits(size: int) -> int:
    """Bits of the sketch of a set of so many hashes: a power of two, at least eight for a hash up to SKETCH bits."""
    return min(SKETCH, max(64, 1 << (8 * size - 1).bit_length()))


def parities(hashes: np.ndarray) -> np.ndarray:
    """A set's sketch: bit i is the parity of the number of its hashes that are i modulo sketch_bits. The bits in which
    two sketches differ are never more than the hashes in which their sets do."""
    m = sketch_bits(len(hashes))
    odd = np.bincount((hashes & np.uint64(m - 1)).astype("int64"), minlength=m) & 1
    return np.packbits(odd.astype("uint8"), bitorder="little").view("uint64")


def possible(sizes: np.ndarray, sketches: list[np.ndarray], roots: np.ndarray, side: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (positions) of a bucket's members, or of its two sides, that can be of at least the similarity and have
    other roots. A pair is left out only if the sizes, or the least difference that the sketches show, rule it out."""
    order = np.argsort(sizes, kind="stable")
    sizes, roots, side, sketches = sizes[order], roots[order], side[order], [sketches[k] for k in order]
    widths = np.array([len(x) for x in sketches])
    left, right = [np.zeros(0, "int64")], [np.zeros(0, "int64")]
    for wide in np.unique(widths):
        mine = np.flatnonzero(widths == wide)
        # Larger sketches are folded to this width, which keeps parities; smaller ones stand before in the order.
        first = mine[0]
        last = int(np.searchsorted(sizes, sizes[mine[-1]] / similarity * (1 + 1e-9), "right"))
        known = np.array([np.bitwise_xor.reduce(x.reshape(-1, wide), axis=0) for x in sketches[first:last]])
        for i in mine:
            end = int(np.searchsorted(sizes, sizes[i] / similarity * (1 + 1e-9), "right"))
            j = np.arange(i + 1, end)
            j = j[(roots[j] != roots[i]) & ((side[i] < 0) | (side[j] != side[i]))]
            if len(j):
                differ = np.bitwise_count(known[j - first] ^ known[i - first]).sum(1, dtype="int64")
                # |A - B| + |B - A| <= (|A| + |B|) * (1 - s) / (1 + s) holds for a similarity of s and more.
                j = j[differ <= (sizes[i] + sizes[j]) * ((1 - similarity) / (1 + similarity)) + 1e-6]
                left.append(np.full(len(j), i))
                right.append(j)
    return order[np.concatenate(left)], order[np.concatenate(right)]


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def similar_classes(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """(name, doc_id, class) of each row of docs, by repeats.named: rows are of one class if steps between documents of
    at least the similarity (Jaccard, of word shingle sets) join them. Two documents meet if they share any of BANDS
    bands, or if links of at most distance bits join their fingerprints; all that meet are looked at. Blank and null
    texts are one class."""
    rows = named(docs)

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, size, fp, every = [], [], [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py(), width)
                own = np.unique(hashes)
                same.append(int(mix(own ^ np.uint64(len(own))).sum(dtype="uint64").view("int64")))
                size.append(len(own))
                fp.append(int(voted(hashes).view("int64")))
                every.append(bands(own))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(batch) + 1, BANDS), pa.int32()), pa.array(np.concatenate([*every, np.zeros(0, "int64")])))
            columns = [batch.column("name"), batch.column("doc_id"), pa.array(same, pa.int64()), pa.array(size, pa.int64()), pa.array(fp, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "doc_id", "same", "size", "fp", "bands"])

    found = stored(rows.select("name", "doc_id", "text").mapInArrow(relieved(sketch), "name long, doc_id long, same long, size long, fp long, bands array<long>"))
    # Equal shingle sets are one class before anything meets; its smallest name stands for it.
    classes = stored(found.groupBy("same", "size").agg(F.min("name").alias("name"), F.min_by("fp", "name").alias("fp"), F.min_by("bands", "name").alias("bands")))
    alike = stored(links(classes.select("fp").distinct(), distance))
    by_fp = classes.groupBy("fp").agg(F.min("name").alias("name"))
    near = alike.join(by_fp.select(F.col("fp").alias("a"), F.col("name").alias("x")), "a").join(by_fp.select(F.col("fp").alias("b"), F.col("name").alias("y")), "b").select("x", "y")
    # Fingerprints that links join are one bucket, so that all their sets meet and not one of each.
    chained = components(alike).select(F.col("node").alias("fp"), F.col("root").alias("chain"))
    linked = stored(classes.where("size > 0").join(chained, "fp", "left").select("name", "size", F.concat("bands", F.array(F.coalesce("chain", "fp"))).alias("names")))
    keyed = linked.select("name", "size", F.posexplode("names").alias("i", "v")).select(F.xxhash64("i", "v").alias("key"), "size", "name")
    several = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")

    def met(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in key_runs(batches, "key"):
            key, name = group["key"].to_numpy(), group["name"].to_numpy()
            new = np.concatenate([[True], key[1:] != key[:-1]])
            first = name[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
            pairs = [(first, name)] + [(name[:-k][ok], name[k:][ok]) for k in range(1, NEXT + 1) for ok in [key[k:] == key[:-k]]]
            x, y = (np.concatenate(p) for p in zip(*pairs, strict=True))
            yield pd.DataFrame({"x": x, "y": y}).query("x != y").drop_duplicates()

    members = stored(keyed.join(several, "key"))
    pairs = members.repartition("key").sortWithinPartitions("key", "size", "name").mapInPandas(relieved(met), "x long, y long").union(near)
    sizes = classes.select("name", "size")
    whole = rows.select("name", "text")
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y").distinct()
    pairs = pairs.join(sizes.select(F.col("name").alias("x"), F.col("size").alias("n")), "x").join(sizes.select(F.col("name").alias("y"), F.col("size").alias("m")), "y")
    pairs = stored(pairs.where(F.least("n", "m") >= F.greatest("n", "m") * similarity).select("x", "y"))
    joined = stored(components(verified(whole, pairs, similarity, width)))

    rooted = members.join(joined.select(F.col("node").alias("name"), "root"), "name", "left").select("key", "name", "size", F.coalesce("root", "name").alias("root"))
    rest = stored(unjoined(whole, rooted, similarity, width).join(pairs, ["x", "y"], "left_anti"))
    more = verified(whole, rest, similarity, width)
    joined = components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    named_classes = classes.select("same", "size", "name").join(joined.select(F.col("node").alias("name"), "root"), "name", "left").select("same", "size", F.coalesce("root", "name").alias("class"))
    return found.select("name", "doc_id", "same", "size").join(named_classes, ["same", "size"]).select("name", "doc_id", "class")


def hashed(rows: DataFrame, wanted: DataFrame, made: Callable, width: int) -> DataFrame:
    """(name, hashes binary) of the rows (name, text) whose names are wanted: what made gives of their shingle sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column("name"), pa.array([made(shingle_set(x.as_py(), width)).tobytes() for x in part.column("text")], pa.binary())], names=["name", "hashes"])

    return stored(picked(rows, stored(wanted)).select("name", "text").mapInArrow(relieved(run), "name long, hashes binary")).dropDuplicates(["name"])


def verified(rows: DataFrame, pairs: DataFrame, similarity: float, width: int) -> DataFrame:
    """The pairs (x, y) of names in rows (name, text), as (a, b), whose whole shingle sets have the similarity."""
    known = hashed(rows, pairs.select(F.col("x").alias("name")).union(pairs.select("y")).distinct(), lambda own: own, width)

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("p"), batch.column("q"), strict=True)
            ok = [similar(np.frombuffer(p.as_py(), "uint64"), np.frombuffer(q.as_py(), "uint64"), similarity) for p, q in sides]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(known.select(F.col("name").alias("x"), F.col("hashes").alias("p")), "x").join(known.select(F.col("name").alias("y"), F.col("hashes").alias("q")), "y")
    return both.select(F.col("x").alias("a"), F.col("y").alias("b"), "p", "q").mapInArrow(relieved(compared), "a long, b long")


def unjoined(rows: DataFrame, keyed: DataFrame, similarity: float, width: int) -> DataFrame:
    """Distinct pairs (x, y) of keyed (key, name, size, root) that share a key, have other roots and can have the
    similarity: all of them, block by block in large buckets. Buckets that are joined up whole aren't read."""
    open_keys = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key", F.when(F.col("n") > BLOCK, F.ceil(F.col("n") / (BLOCK // 2))).otherwise(1).cast("int").alias("blocks"))
    left = stored(keyed.join(open_keys, "key"))
    sketches = hashed(rows, left.select("name").distinct(), parities, width)
    block = F.pmod(F.xxhash64("name", F.lit(1)), F.col("blocks")).cast("int")
    # Block i meets the blocks j >= i: a row goes to each pair that its block is in.
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    placed = left.join(sketches, "name").withColumn("block", block).withColumn("pair", F.explode(meet))
    side = F.when(F.col("pair.i") == F.col("pair.j"), -1).otherwise(F.when(F.col("block") == F.col("pair.i"), 0).otherwise(1))
    placed = placed.select(F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", "pair.i", "pair.j")).alias("key"), "name", "size", "root", "hashes", side.alias("side"))

    def met(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in key_runs(batches, "key"):
            edges = bounds(group["key"].to_numpy())
            name, size, root, side = (group[c].to_numpy() for c in ("name", "size", "root", "side"))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                own = [np.frombuffer(x, "uint64") for x in group["hashes"].iloc[lo:hi]]
                i, j = possible(size[lo:hi], own, root[lo:hi], side[lo:hi], similarity)
                if len(i):
                    a, b = name[lo:hi][i], name[lo:hi][j]
                    yield pd.DataFrame({"x": np.minimum(a, b), "y": np.maximum(a, b)})

    return dealt(placed, "key").mapInPandas(relieved(met), "x long, y long").distinct()


def first_of_groups(docs: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """docs with one row of each class of similar_classes: the one with the smallest doc_id (of equals, the smallest
    hash of id and text; of rows repeated whole, any). A row without a doc_id stays if its class has no other. Null, empty
    and blank texts are one class; texts may be of any length. An empty table gives an empty one; other columns pass,
    whatever their names."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "name")
    first = cut(similar_classes(docs, similarity, width).groupBy("class").agg(F.min_by("name", order).alias("name")).select("name"))
    return one_each(docs, first)
