"""Depth-limited radix sort of suffixes, as far as windows of a fixed length can tell them apart.

A row for each suffix would be many times the corpus. Every window has one anchor: a place that the window's own
content picks, so that equal windows have their anchors at equal offsets. Neighbouring windows mostly share one, and
a row stands for such a stretch of suffixes. The first pass deals stretches out by the content around the anchor
(key). Equal stretches are one from then on, and if a key has no other, all its windows repeat. Where a key has
different ones, the suffixes at their anchors, and what stands before them read backwards, are sorted by
most-significant-digit passes over their content, down to the window's length and no further; the windows whose two
sides are in equal groups at their depths are the repeats."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import bounds, cut, dealt, key_runs, relieved, shared_dir

#: Symbols that are looked at in one go; longer texts go on in the next, with a window's overlap.
STRETCH = 1 << 22
#: Different stretches of a key that a task sorts; keys with more are dealt out by further passes first.
SORTED = 1_000
#: By how many places windows of a range start apart in these passes, at most. In the last, equal windows alone meet.
FINER = (16, 1)
#: Ids that are broadcast at most, to read the texts of some documents alone; more are joined by a shuffle.
NAMED = 1_000_000

SPANS = "key long, span long, name long, owner long, at int, lo int, n int"
STRETCHES = "key long, span long, least long, most long, many boolean, at int, n int, units binary"
#: Odd, and 3 modulo 8, so that their powers repeat as late as can be.
_BASES = (np.uint64(0x9E3779B97F4A7C1B), np.uint64(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as are asked for."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, "uint64")

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 12)
            self.up, self.down = (np.concatenate([np.ones(1, "uint64"), np.cumprod(np.full(size, b, "uint64"))]) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


class Named:
    """64-bit names of the stretches of a sequence of 64-bit symbols, each in constant time."""

    _powers: dict[int, Powers] = {}

    def __init__(self, symbols: np.ndarray, base: int) -> None:
        if base not in self._powers:
            self._powers[base] = Powers(_BASES[base])
        up, self.down = self._powers[base].of(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, "uint64")
        np.cumsum(symbols * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


@dataclass(frozen=True)
class Kind:
    """What a text is a sequence of.

    split: text to units (bytes or words); symbols: units to 64-bit symbols; picks: units and symbols to a
    number for each place between units, the least of which in a window is its anchor (0 to the length);
    joined: units back to text. margin: how much of the content on either side picks and key depend on."""

    window: int
    margin: int
    split: Callable
    symbols: Callable
    picks: Callable
    joined: Callable
    digits: Callable  # from cuts of units and a length to a row of 64-bit digits for each cut, zeros after its end
    per: int  # units of a digit
    first_stays: bool  # whether windows stay in the document with the smallest id
    by_document: bool = True  # whether only windows that other documents have repeat, and not those of the same one


def spans(units: object, kind: Kind) -> tuple[np.ndarray, ...]:
    """(key, span, at, lo, n) of a text: the windows that start at lo to lo + n - 1 have their anchor at lo + at."""
    w, r = kind.window, kind.margin
    total = len(units)
    out = []
    for begin in range(0, max(0, total - w + 1), STRETCH):
        part = units[begin : begin + STRETCH + w - 1]
        symbols = kind.symbols(part)
        picks = kind.picks(part, symbols)  # of places 0 .. len
        wide = w - 2 * r + 1  # places in which a window's anchor can be
        low = (picks & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(picks), dtype="uint64")
        size, m = 1, low
        while 2 * size <= wide:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < wide:
            m = np.minimum(m[: len(low) - wide + 1], m[wide - size :])
        anchor = (m[r : r + len(part) - w + 1] & np.uint64(0xFFFFFF)).astype("int64")
        edges = bounds(anchor)
        lo, hi, p = edges[:-1], edges[1:], anchor[edges[:-1]]
        first, second = Named(symbols, 0), Named(symbols, 1)
        at, n = p - lo, hi - lo
        key = first.of(p - r, p + r)
        span = mix(second.of(lo, hi + w - 1) ^ mix((at << 32 | n).astype("uint64")))
        out.append((key, span, at, lo + begin, n))
    if not out:
        return (np.zeros(0, "uint64"),) * 2 + (np.zeros(0, "int64"),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def ordered(digits: np.ndarray, group: np.ndarray, per: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): rows of digits sorted within their groups by most-significant-digit passes, and how many units
    each row in that order has in common with the one before it (0 where a group starts). A digit holds per units.

    Each pass sorts the groups that are left by their next digit and splits them where it changes; a row that is
    alone in its group is in its place and takes no further part."""
    order = np.argsort(group, kind="stable")
    start = np.concatenate([[True], group[order][1:] != group[order][:-1], [True]])
    shared = np.where(start[:-1], 0, digits.shape[1] * per)
    left = np.flatnonzero(~(start[:-1] & start[1:]))
    for turn in range(digits.shape[1]):
        if not len(left):
            break
        digit, own = digits[order[left], turn], np.cumsum(start[left])
        turned = np.lexsort((digit, own))
        order[left], digit = order[left][turned], digit[turned]
        new = np.flatnonzero((digit[1:] != digit[:-1]) & ~start[left][1:]) + 1
        start[left[new]] = True
        differ = (digit[new] ^ digit[new - 1]).astype(">u8").view("uint8").reshape(-1, 8)
        shared[left[new]] = turn * per + np.argmax(differ != 0, axis=1) * per // 8
        left = left[~(start[left] & start[left + 1])]
    return order, shared


def classes(order: np.ndarray, shared: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """For each depth, a number for each row: rows have the same if their first depth units are equal."""
    out = np.empty((len(depths), len(order)), "int64")
    out[:, order] = np.cumsum(shared[None, :] < depths[:, None], axis=1)
    return out


def alike(at: np.ndarray, n: np.ndarray, least: np.ndarray, most: np.ndarray, many: np.ndarray, ahead: tuple[np.ndarray, np.ndarray], back: tuple[np.ndarray, np.ndarray], window: int) -> list[tuple[int, int, int, int, int]]:
    """(row, first window, last window, least owner, greatest owner) of the windows that occur more than once, or in a stretch that
    does, among stretches that share an anchor.

    ahead and back are what ordered() says of the suffixes that start at the anchors, and of what stands before them
    read backwards. The windows that start a units before their anchor are equal where the suffixes are in one class
    at depth window - a and the reversed beginnings in one class at depth a. Both change only at some values of a, so
    one grouping stands for all a between two of them."""
    low, high, m = at - n + 1, at, len(at)
    edges = np.unique(np.concatenate([low, high + 1, ahead[1] * -1 + window, back[1] + 1]))
    edges = edges[(edges >= low.min()) & (edges <= high.max() + 1)]
    first, last = edges[:-1], edges[1:] - 1
    there = (low[None, :] <= first[:, None]) & (high[None, :] >= last[:, None])
    names = classes(*ahead, window - first) * (m + 1) + classes(*back, first) + np.arange(len(first))[:, None] * (m + 1) ** 2
    part, row = np.nonzero(there)
    _, of = np.unique(names[part, row], return_inverse=True)
    size = np.bincount(of, 1 + many[row])  # a stretch that occurs more than once counts twice
    small, large = np.full(len(size), np.iinfo("int64").max), np.full(len(size), np.iinfo("int64").min)
    np.minimum.at(small, of, least[row])
    np.maximum.at(large, of, most[row])
    hit = size[of] > 1
    part, row, small, large = part[hit], row[hit], small[of[hit]], large[of[hit]]
    turned = np.lexsort((-part, row))  # windows in order: the first has the largest a
    part, row, small, large = part[turned], row[turned], small[turned], large[turned]
    begin, end = at[row] - last[part], at[row] - first[part]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (begin[1:] != end[:-1] + 1) | (small[1:] != small[:-1]) | (large[1:] != large[:-1])])[: len(row)]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(row))[: len(starts)] - 1
    return list(zip(row[starts].tolist(), begin[starts].tolist(), end[ends].tolist(), small[starts].tolist(), large[starts].tolist(), strict=True))


def sorted_windows(part: pd.DataFrame, kind: Kind) -> pd.DataFrame:
    """(key, span, a, b, least, most) of the windows a to b that repeat, of stretches (STRETCHES) in the order of key:
    all of a key are there."""
    texts, at = [kind.split(x) for x in part["units"]], part["at"].to_numpy("int64")
    wide = kind.window - kind.margin
    keys, n, many = part["key"].to_numpy(), part["n"].to_numpy("int64"), part["many"].to_numpy(bool)
    least, most = (part[c].to_numpy("int64") for c in ("least", "most"))
    edges = bounds(keys)
    group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    sides = []
    for cuts in ([x[a : a + wide] for x, a in zip(texts, at, strict=True)], [x[max(0, a - wide) : a][::-1] for x, a in zip(texts, at, strict=True)]):
        sides.append(ordered(kind.digits(cuts, wide), group, kind.per))
    rows = []
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        ahead, back = ((order[lo:hi] - lo, shared[lo:hi]) for order, shared in sides)
        rows += [(k + lo, *x) for k, *x in alike(at[lo:hi], n[lo:hi], least[lo:hi], most[lo:hi], many[lo:hi], ahead, back, kind.window)]
    of, a, b, small, large = (np.array(x, "int64") for x in zip(*rows, strict=True)) if rows else (np.zeros(0, "int64"),) * 5
    return pd.DataFrame({"key": keys[of], "span": part["span"].to_numpy()[of], "a": a, "b": b, "least": small, "most": large})


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet under the shared folder, and read again. Column by column it takes a third of the
    room that a checkpoint does; the folder's owner clears it."""
    at = f"{shared_dir(df.sparkSession).rstrip('/')}/spans-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def named(docs: DataFrame) -> DataFrame:
    """(doc_id, text binary, name): a row's name is a hash of its id and text."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("name", F.xxhash64("doc_id", F.length("text"), "text"))


def picked(texts: DataFrame, by_name: DataFrame) -> DataFrame:
    """texts joined with by_name (a row a name); other texts don't travel. The names are broadcast if they are
    NAMED at most (8 bytes each)."""
    names = by_name.select("name")
    if by_name.count() <= NAMED:
        texts = texts.join(F.broadcast(names), "name", "left_semi")
    return texts.join(by_name, "name")


def removed(docs: DataFrame, kind: Kind) -> DataFrame:
    """(name, doc_id, runs array of (a, b)) of rows with repeated windows: units a to b - 1 go, in order, runs
    apart from each other. Rows that occur whole more than once (same id and text) are not compared with each other."""
    spark, texts = docs.sparkSession, named(docs)
    if kind.by_document:
        texts = texts.where("doc_id IS NOT NULL")

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, name, text in zip(batch.column("doc_id").to_pylist(), batch.column("name").to_pylist(), batch.column("text"), strict=True):
                key, span, at, lo, n = spans(kind.split(text.as_py()), kind)
                owner = np.full(len(key), doc) if kind.by_document else mix(np.uint64(name & (1 << 64) - 1) ^ mix(lo.astype("uint64"))).view("int64")
                out.append((key.view("int64"), span.view("int64"), np.full(len(key), name), owner, at, lo, n))
            columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0)] * 7
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c.astype("int64"), k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in SPANS.split(", ")])

    found = stored(texts.select("doc_id", "name", "text").mapInArrow(relieved(scan), SPANS))
    keys = found.groupBy("key").agg(F.min("owner").alias("a"), F.max("owner").alias("b"), F.min("span").alias("s"), F.max("span").alias("t"))
    keys = keys.where("a <> b").select("key", (F.col("s") != F.col("t")).alias("differ"))
    shared = stored(found.join(stored(keys), "key"))  # both sides are dealt out anew, so that Spark can split a hot key
    copies = shared.groupBy("key", "span").agg(F.min("owner").alias("least"), F.max("owner").alias("most"), (F.min("owner") != F.max("owner")).alias("many"), F.min_by(F.struct("name", "at", "lo", "n"), "owner").alias("one"), F.first("differ").alias("differ"))
    copies = stored(copies.select("key", "span", "least", "most", "many", "differ", "one.*"))
    alike = copies.where("NOT differ AND many").select("key", "span", F.lit(0).alias("a"), (F.col("n") - 1).alias("b"), "least", "most")
    resolved = stored(alike.union(_sorted_spans(texts, copies.where("differ"), kind)))  # joined unstored, rows of its union were lost on check_l
    hit = shared.join(resolved, ["key", "span"])
    if kind.first_stays:
        hit = hit.where("owner > least")
    elif kind.by_document:
        hit = hit.where("least < most")
    gone = hit.select("name", (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b") + kind.window).alias("b"))
    return stored(gone.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("runs")))


def _sorted_spans(texts: DataFrame, copies: DataFrame, kind: Kind) -> DataFrame:
    """(key, span, a, b, least, most) of the windows a to b of spans that repeat, for keys with different spans."""
    fields = ["key", "span", "least", "most", "many", "at", "n"]
    wanted = copies.groupBy("name").agg(F.collect_list(F.struct(*fields, "lo")).alias("spans"))

    def cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = {c: batch.column(c) for c in [*fields, "lo"]}
            edges = lists["lo"].offsets.to_numpy()
            flat = {c: x.values for c, x in lists.items()}
            lo, n = flat["lo"].to_numpy(), flat["n"].to_numpy()
            for first in range(0, len(batch), 100):
                units = []
                last = min(first + 100, len(batch))
                for row in range(first, last):
                    text = kind.split(batch.column("text")[row].as_py())
                    units += [kind.joined(text[lo[k] : lo[k] + n[k] + kind.window - 1]) for k in range(edges[row], edges[row + 1])]
                part = slice(edges[first], edges[last])
                yield pa.RecordBatch.from_arrays([*(flat[c][part] for c in fields), pa.array(units, pa.binary())], names=[*fields, "units"])

    wants = picked(texts.select("name", "text"), wanted).select("text", *[F.col(f"spans.{c}").alias(c) for c in [*fields, "lo"]])
    rows = stored(stored(wants.mapInArrow(relieved(cut_out), STRETCHES)).dropDuplicates(["key", "span"]))
    return _passes(rows, kind, [w for w in FINER if w < kind.window // 4])


def _passes(rows: DataFrame, kind: Kind, finer: list[int]) -> DataFrame:
    """sorted_windows() of stretches (STRETCHES, a row a key and span). A key with over SORTED of them gets another
    pass first: its windows are dealt out by how far they start before the anchor, in ranges of finer[0], and by the
    content that all windows of a range have in common; stretches that are equal then are one."""

    def sort(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in key_runs(batches, "key"):
            cuts, edges = 0, bounds(group["key"].to_numpy())[1:]
            for edge in edges:
                if edge - cuts >= SORTED or edge == len(group):
                    yield sorted_windows(group.iloc[cuts:edge], kind)
                    cuts = edge

    schema = "key long, span long, a int, b int, least long, most long"
    large = rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > SORTED).select("key")
    large = cut(large) if finer else large
    if not finer or not large.head(1):
        return dealt(rows, "key").mapInPandas(relieved(sort), schema)
    few = dealt(rows.join(large, "key", "left_anti"), "key").mapInPandas(relieved(sort), schema)
    wide, window = finer[0], kind.window

    def deal(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 200):
                out = []
                for r in batch.iloc[k : k + 200].itertuples(index=False):
                    units, i = kind.split(r.units), 0
                    one, two = (Named(kind.symbols(units), x) for x in (0, 1))
                    while i < r.n:  # windows i to j - 1 start a = at - i units or less before the anchor, in one range
                        band = (r.at - i) // wide
                        j = min(r.n, r.at - band * wide + 1)
                        ends = [np.array([x]) for x in (r.at - band * wide, r.at - (band + 1) * wide + 1 + window, i, j - 1 + window)]
                        key = mix(one.of(*ends[:2]) ^ mix(np.array([r.key & (1 << 64) - 1, band], "uint64")).sum())
                        span = mix(two.of(*ends[2:]) ^ mix(np.array([(r.at - i) << 32 | (j - i)], "uint64")))
                        out.append((key.view("int64")[0], span.view("int64")[0], r.least, r.most, r.many, r.at - i, j - i, kind.joined(units[i : j - 1 + window]), r.key, r.span, i))
                        i = j
                yield pd.DataFrame(out, columns=[*(c.split()[0] for c in STRETCHES.split(", ")), "old_key", "old_span", "i"])

    parts = stored(rows.join(large, "key").mapInPandas(relieved(deal), STRETCHES + ", old_key long, old_span long, i int"))
    one = F.min_by(F.struct("at", "n", "units"), "old_span").alias("one")
    merged_parts = stored(parts.groupBy("key", "span").agg(F.min("least").alias("least"), F.max("most").alias("most"), (F.bool_or("many") | (F.count("*") > 1)).alias("many"), one).select("key", "span", "least", "most", "many", "one.*"))
    found = _passes(merged_parts, kind, finer[1:]).join(parts.select("key", "span", "old_key", "old_span", "i"), ["key", "span"])
    return few.union(found.select(F.col("old_key").alias("key"), F.col("old_span").alias("span"), (F.col("a") + F.col("i")).alias("a"), (F.col("b") + F.col("i")).alias("b"), "least", "most"))


def merged(runs: Iterable) -> list[tuple[int, int]]:
    """Runs in order, as few as cover the same."""
    out: list[list[int]] = []
    for a, b in sorted((x["a"], x["b"]) for x in runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept(units: object, gone: list[tuple[int, int]], joined: Callable) -> bytes:
    """The text without the runs."""
    starts, ends = [0, *(b for _, b in gone)], [*(a for a, _ in gone), len(units)]
    parts = [units[a:b] for a, b in zip(starts, ends, strict=True) if a < b]
    return joined([x for p in parts for x in p] if isinstance(units, list) else b"".join(parts))
