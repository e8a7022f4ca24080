"""Vectors as short codes: an integer codebook for each part (operator 12)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import relieved, table
from lectern.llm.topk import usable

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Blocks of a part whose means are compared, coarse to fine.
LEVELS = (1, 2, 4)
#: Integers up to this size are computed with in 64 bits; larger ones as Python's, which have no end.
WIDE = 1 << 27
#: Numbers of a chunk that a task works on at once.
CHUNK = 1 << 20
#: Digits, in bits, that sums of any size travel in.
DIGIT = 40
#: Labels that are broadcast with their sums at most; more are joined by key.
SENT = 50_000
LONG = np.iinfo("int64")


@dataclass
class Sketch:
    """Block means and residual norms of rows (n by m) at each level, and the rows' norms, in doubles."""

    rows: np.ndarray
    means: list[np.ndarray] = field(default_factory=list)
    rests: list[np.ndarray] = field(default_factory=list)
    sizes: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        n, m = self.rows.shape
        self.norms = np.sqrt((self.rows**2).sum(1))
        for blocks in LEVELS:
            edges = np.unique(np.arange(blocks) * m // blocks)
            sizes = np.diff(np.append(edges, m))
            means = np.add.reduceat(self.rows, edges, 1) / sizes if m else np.zeros((n, 1))
            rests = np.sqrt(np.add.reduceat((self.rows - np.repeat(means, sizes, 1)) ** 2, edges, 1)) if m else np.zeros((n, 1))
            self.means.append(means)
            self.rests.append(rests)
            self.sizes.append(sizes if m else np.ones(1))


def below(x: Sketch, c: Sketch, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lower bounds of the squared distances between rows i of x and j of c: in each block the means' part is exact, and
    what is left differs at least by the difference of its norms. What rounding can add is taken off."""
    means = ((x.means[level][i] - c.means[level][j]) ** 2 * x.sizes[level]).sum(1)
    rests = ((x.rests[level][i] - c.rests[level][j]) ** 2).sum(1)
    return means + rests - (x.rows.shape[1] + 16) * 2.0**-50 * (x.norms[i] + c.norms[j]) ** 2


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each of rows (n by m integers, 64 bits or Python's) the nearest of entries by squared distance, ties to the
    lower index; those distances; and how many exact distances were computed.

    A row's first exact distance is that to the entry with the least coarse bound. Entries whose lower bound lies
    above it go, level by level; those that stay get exact distances too."""
    n, k = len(rows), len(entries)
    shift = max(0, *(int(np.abs(x).max(initial=0)).bit_length() - 27 for x in (rows, entries)))
    x, c = (Sketch(_doubles(a, shift)) for a in (rows, entries))
    whole = np.zeros((n, k), rows.dtype)
    i, j = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    bound = below(x, c, 0, i, j)
    first = bound.reshape(n, k).argmin(1)
    known = ((rows - entries[first]) ** 2).sum(1)
    most = _doubles(known, 2 * shift) * (1 + 2.0**-50) + 2.0**-1000
    for level in range(len(LEVELS)):
        bound = bound if level == 0 else below(x, c, level, i, j)
        left = bound <= most[i]
        i, j = i[left], j[left]
    other = j != first[i]
    i, j = i[other], j[other]
    whole[:] = np.iinfo("int64").max if rows.dtype != object else max(known, default=0) + 1
    whole[np.arange(n), first] = known
    whole[i, j] = ((rows[i] - entries[j]) ** 2).sum(1)
    best = whole.argmin(1) if rows.dtype != object else np.array([min(range(k), key=lambda e, w=w: (w[e], e)) for w in whole], "int64")
    return best, whole[np.arange(n), best], n + len(i)


def _doubles(x: np.ndarray, shift: int) -> np.ndarray:
    """x / 2**shift in doubles, within their rounding."""
    if x.dtype != object:
        return np.ldexp(x.astype(float), -shift)
    return np.array([_double(int(v), shift) for v in x.ravel()], float).reshape(x.shape)


def _double(v: int, shift: int) -> float:
    spare = max(0, v.bit_length() - 64)
    return math.ldexp(float(v >> spare), spare - shift)


def quantized(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of doubles as integers: 64 bits where they are small, Python's where not."""
    y = np.floor(x * SCALE)
    if np.abs(y).max(initial=0) <= WIDE:
        return y.astype("int64")
    return np.array([int(v) * SCALE if abs(v) > 2.0**60 else int(np.floor(v * SCALE)) for v in x.ravel()], object).reshape(x.shape)


def width(longest: int, parts: int) -> int:
    """Components of a part."""
    return -(-longest // parts)


def _chunks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integers) of a batch's vectors, which are padded with zeros to dims."""
    column = batch.column("v")
    step = max(1, CHUNK // max(dims, 1))
    for at in range(0, len(column), step):
        rows = column.slice(at, step)
        sizes = rows.value_lengths().to_numpy(zero_copy_only=False)
        values = rows.flatten().to_numpy(zero_copy_only=False).astype(float)
        if (sizes == dims).all():
            yield at, quantized(values.reshape(len(rows), dims))
        else:
            wide = np.zeros((len(rows), dims))
            wide[np.arange(dims)[None, :] < sizes[:, None]] = values
            yield at, quantized(wide)


def _assigned(x: np.ndarray, books: list[np.ndarray], wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry by part, and the distances."""
    codes, errors = np.zeros((len(x), len(books)), "int64"), np.zeros((len(x), len(books)), object)
    for p, book in enumerate(books):
        own = x[:, p * wide : (p + 1) * wide]
        small = own.dtype != object and np.abs(book).max(initial=0) <= WIDE
        if not small or wide * (2 * WIDE) ** 2 > LONG.max and np.abs(own).max(initial=0) * np.sqrt(wide) > WIDE:
            own, book = own.astype(object), book.astype(object)
        codes[:, p], errors[:, p], _ = nearest(own, book.astype(own.dtype))
    return codes, errors


@dataclass
class Codebooks:
    """entries[p]: the entries of part p, a row of integers each; dims: components of a padded vector."""

    entries: list[np.ndarray]
    dims: int

    def digest(self) -> str:
        """SHA-256 of all entries' components, in decimal, by part, entry and place."""
        return hashlib.sha256(",".join(str(int(v)) for book in self.entries for v in book.ravel()).encode()).hexdigest()


def kept(vectors: DataFrame) -> DataFrame:
    """Rows of vectors (vec_id, v, label) that take part: v has no null and no non-finite component."""
    return vectors.where(usable(F.col("v"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"), "label")


def fitted(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of rows (kept()). They start as the vectors of the smallest ids, of equal ids by content, null ids
    last; of fewer rows, as many as there are. A round is one pass in which each task adds up its rows by entry; the
    driver gets parts * entries sums, whatever the number of rows, and divides, rounding down."""
    shape = rows.agg(F.max(F.size("v"))).first()[0]
    wide = width(shape or 0, parts)
    dims = wide * parts
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    start = np.zeros((len(seeds), dims))
    for row, seed in zip(start, seeds, strict=True):
        row[: len(seed["v"])] = seed["v"]
    start = quantized(start)
    books = Codebooks([start[:, p * wide : (p + 1) * wide] for p in range(parts)], dims)
    for _ in range(rounds if len(seeds) else 0):
        books = _moved(rows, books, wide)
    return books


def _moved(rows: DataFrame, books: Codebooks, wide: int) -> Codebooks:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, object) for b in books.entries]
        sizes = [np.zeros(len(b), "int64") for b in books.entries]
        for batch in batches:
            for _, x in _chunks(batch, books.dims):
                codes, _ = _assigned(x, books.entries, wide)
                for p, (total, size) in enumerate(zip(sums, sizes, strict=True)):
                    size += np.bincount(codes[:, p], minlength=len(size))
                    for e in np.unique(codes[:, p]):
                        total[e] += x[codes[:, p] == e, p * wide : (p + 1) * wide].sum(0)
        told = [(p, e, -1, 0, int(size[e])) for p, size in enumerate(sizes) for e in np.flatnonzero(size)]
        for p, e, *_ in list(told):
            told += [(p, e, at, digit, value) for at, total in enumerate(sums[p][e]) for digit, value in _digits(int(total))]
        columns = list(zip(*told, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "at", "digit", "value"])

    told = rows.select("v").mapInArrow(relieved(run), "part long, entry long, at long, digit long, value long")
    found = told.groupBy("part", "entry", "at", "digit").agg(F.sum("value").alias("value")).collect()
    sizes = {(r["part"], r["entry"]): r["value"] for r in found if r["at"] < 0}
    sums = {key: [0] * wide for key in sizes}
    for r in found:
        if r["at"] >= 0:
            sums[r["part"], r["entry"]][r["at"]] += r["value"] << (DIGIT * r["digit"])
    new = []
    for p, book in enumerate(books.entries):
        rows_ = [[s // sizes[p, e] for s in sums[p, e]] if (p, e) in sizes else [int(v) for v in book[e]] for e in range(len(book))]
        small = all(abs(v) <= WIDE for r in rows_ for v in r)
        new.append(np.array(rows_, "int64" if small else object).reshape(book.shape))
    return Codebooks(new, books.dims)


def _digits(total: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a number in signed digits of DIGIT bits; zeros aren't told."""
    sign, left, place = (-1 if total < 0 else 1), abs(total), 0
    while left:
        if low := left & ((1 << DIGIT) - 1):
            yield place, sign * low
        left, place = left >> DIGIT, place + 1


def encoded(rows: DataFrame, books: Codebooks, parts: int = PARTS) -> DataFrame:
    """(vec_id, label, code, error) of each of rows: two hex digits of each part's nearest entry, and the sum of the
    squared distances (the largest long if it is larger)."""
    wide, label = width(books.dims, parts), rows.schema["label"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for _, x in _chunks(batch, books.dims):
                code, error = _assigned(x, books.entries, wide)
                codes += [bytes(c).hex() for c in code.astype("uint8")]
                errors += [min(int(e), LONG.max) for e in error.sum(1)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    return rows.mapInArrow(relieved(run), f"vec_id long, label {label}, code string, error long")


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(vec_id, code, error, label_error) of the rows of vectors (vec_id, v, label) that take part, and their codebooks.

    Vectors of any length are cut into parts of one width, that of the longest; shorter ones, and lengths that parts
    don't divide, are padded with zeros. Vectors that are null or hold null or non-finite components are left out.
    Rows with a null vec_id are coded too; rows repeated whole, and ids with several vectors, are rows of their own.
    label_error is error summed over the rows of a label, null ones together, and the largest long if it is larger.
    An empty table gives no rows, and codebooks without entries. Other columns play no part. Entries must be 256 at
    most."""
    rows = kept(vectors)
    books = fitted(rows, parts, entries, rounds)
    coded = encoded(rows, books, parts)
    sums = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(int(LONG.max)).cast("decimal(38,0)")).cast("long").alias("label_error"))
    sums = sums.withColumnRenamed("label", "of")
    if vectors.select("label").distinct().limit(SENT + 1).count() <= SENT:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error"), books


def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = compressed(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("v"), "label"))
    return found.withColumn("codebooks_sha256", F.lit(books.digest()))


def _rounds_sql() -> str:
    """CTEs a1, b1 ... a6, b6, a7: assignments of a round, and the codebooks that it ends with."""
    out = []
    for n in range(1, ROUNDS + 2):
        out.append(f"""
     a{n} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, struct_pack(d := d, entry := entry)) AS entry, min(d) AS d
             FROM (SELECT x.vec_id, x.part, b.entry, list_sum(list_transform(list_zip(x.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM x JOIN b{n - 1} b USING (part)) GROUP BY vec_id, part)""")
        if n <= ROUNDS:
            out.append(f"""
     s{n} AS (SELECT part, entry, place, sum(val) AS total, count(*) AS n
             FROM (SELECT a.part, a.entry, unnest(x.v) AS val, generate_subscripts(x.v, 1) AS place FROM a{n} a JOIN x USING (vec_id, part)) GROUP BY part, entry, place),
     m{n} AS (SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM s{n} GROUP BY part, entry),
     b{n} AS MATERIALIZED (SELECT part, entry, coalesce(m{n}.v, b{n - 1}.v) AS v FROM b{n - 1} LEFT JOIN m{n} USING (part, entry))""")
    return ",".join(out)


ORACLE = f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
     x AS MATERIALIZED (SELECT vec_id, part, q[part * len(q) // {PARTS} + 1 : (part + 1) * len(q) // {PARTS}] AS v FROM e, range({PARTS}) r(part)),
     b0 AS (SELECT part, CAST(n AS BIGINT) AS entry, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM e) USING (vec_id) WHERE n < {ENTRIES}),{_rounds_sql()},
     c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS + 1} GROUP BY vec_id),
     h AS (SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(v) AS val, generate_subscripts(v, 1) AS place FROM b{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN e USING (vec_id), h
"""
