"""Toxicity by a factorization machine over hashed terms (operator 3)."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import relieved, table

#: Labelled rows that a model is fitted on, at most; the rows whose hashed id comes first.
SAMPLE = 12_000
BUCKETS = 1 << 20
#: Labelled rows that must have a term for it to get a weight and factors.
SUPPORT = 4
FACTORS = 8
EPOCHS, BATCH, RATE = 30, 128, 0.1
#: Steps at least, however few rows there are.
STEPS = 600
#: Terms (the most frequent) whose pairs are looked at for where factors start, and how many standard errors from
#: nothing what the weights leave over must lie for a pair.
PAIRED, CLEAR = 1024, 6.0
#: Pulls towards zero: of each weight, and of each term's factors together. What signal holds up against them stays.
WEIGHT_PULL, FACTOR_PULL = 3e-3, 1.2e-2
STRIPPED = bytes(b for b in range(128) if not chr(b).isalnum())
CACHED_WORDS = 150_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Terms(dict):
    """From a word to its bucket; a word counts without the signs around it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = zlib.crc32(word.strip(STRIPPED)) % BUCKETS
        return self[word]

    def of(self, text: bytes) -> set[int]:
        return set(map(self.__getitem__, set(text.lower().split())))


@dataclass
class Model:
    """Logit of a set of terms: bias, weights, and for each two terms the product of their factors."""

    column: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    shift: float = 0.0

    def logit(self, columns: list[int]) -> float:
        v = self.factors[columns]
        total = v.sum(0)
        return self.bias + float(self.weights[columns].sum() + 0.5 * (total @ total - (v * v).sum()))

    def score(self, terms: set[int]) -> float:
        z = self.logit([self.column[t] for t in self.column.keys() & terms]) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Sums:
    """Sums over the terms of each row of a batch."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.row, self.n = np.repeat(np.arange(len(lengths)), lengths), len(lengths)

    def of(self, values: np.ndarray) -> np.ndarray:
        if values.ndim == 1:
            return np.bincount(self.row, values, self.n)
        return np.stack([np.bincount(self.row, x, self.n) for x in values.T], 1)


def fit(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """A model from term sets and 0/1 labels; without both classes, a constant one (score 0 without labels).

    All terms that SUPPORT rows have take part, whatever they say alone, so that the factors can learn what two
    say together. Steps of AdaGrad over batches; after each, weights and factors are pulled towards zero, so that
    those of most terms stay there. For a third of the time weights learn alone; then factors start from the pairs
    whose rows the weights misjudge (of frequent terms), and from small random numbers. A fifth of the rows is kept from the fit and sets the shift with which 0.5 is
    the best threshold by F1."""
    n, positive = len(labels), int(labels.sum())
    if not 0 < positive < n:
        return Model({}, 30.0 if n and positive else -30.0, np.zeros(0), np.zeros((0, FACTORS)))
    rng = np.random.default_rng(seed)
    kept = rng.random(n) < 0.2
    if not 0 < labels[~kept].sum() < (~kept).sum():
        kept[:] = False
    seen = np.bincount(np.concatenate([*(r for r, k in zip(rows, kept, strict=True) if not k), np.zeros(0, "int32")]), minlength=BUCKETS)
    terms = np.flatnonzero(seen >= SUPPORT)
    where = np.full(BUCKETS, -1, "int32")
    where[terms] = np.arange(len(terms))
    own = [c[c >= 0] for c in (where[r] for r in rows)]
    lengths, flat = np.array([len(c) for c in own]), np.concatenate([*own, np.zeros(0, "int32")])
    ends = np.cumsum(lengths)
    base = labels[~kept].mean()
    bias, w, v = float(np.log(base / (1 - base))), np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), FACTORS))
    past = [1e-8, np.full(len(terms), 1e-8), np.full(len(terms), 1e-8)]

    def logits(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Sums]:
        sums = Sums(lengths[part])
        columns = flat[np.repeat(ends[part] - np.cumsum(lengths[part]), lengths[part]) + np.arange(lengths[part].sum())]
        total = sums.of(v[columns])
        return bias + sums.of(w[columns]) + 0.5 * ((total * total).sum(1) - sums.of((v[columns] ** 2).sum(1))), total, columns, sums

    batches = max(1, int((~kept).sum()) // BATCH)
    turns = max(epochs, -(-STEPS // batches))
    start, v[:] = v.copy(), 0
    for turn in range(turns):
        if turn == turns // 3:
            part, often = np.flatnonzero(~kept), np.argsort(-seen[terms], kind="stable")[:PAIRED]
            z, _, columns, sums = logits(part)
            place = np.full(len(terms), -1)
            place[often] = np.arange(len(often))
            mine = place[columns] >= 0
            x = np.zeros((len(part), len(often)), "float32")
            x[sums.row[mine], place[columns[mine]]] = 1
            v[:] = start
            v[often] += _together(x, labels[part] - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        for part in np.array_split(rng.permutation(np.flatnonzero(~kept)), batches):
            z, total, columns, sums = logits(part)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)
            used, of = np.unique(columns, return_inverse=True)
            each = g[sums.row]
            dw = np.bincount(of, each, len(used))
            dv = np.stack([np.bincount(of, each * (total[sums.row, k] - v[columns, k]), len(used)) for k in range(FACTORS)], 1)
            past[0] += g.sum() ** 2
            past[1][used] += dw * dw
            past[2][used] += (dv * dv).mean(1)
            bias -= RATE / past[0] ** 0.5 * g.sum()
            step = RATE / np.sqrt(past[1][used])
            x = w[used] - step * dw
            w[used] = np.sign(x) * np.maximum(0, np.abs(x) - step * WEIGHT_PULL)
            step = RATE / np.sqrt(past[2][used])[:, None]
            x = v[used] - step * dv
            v[used] = x * np.maximum(0, 1 - step * FACTOR_PULL / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12))
    held = w.astype(bool) | v.any(1)
    model = Model({int(t): i for i, t in enumerate(terms[held])}, bias, w[held], v[held])
    if kept.any():
        model.shift = -_threshold(logits(np.flatnonzero(kept))[0], labels[kept])
    return model


def _together(x: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Factors for the terms of x (rows by terms, 0/1) whose products are about what is left over, on the mean, where
    two of them meet; pairs that aren't CLEAR count as nothing."""
    met = x.T @ x
    mean = x.T @ (x * left.astype("float32")[:, None]) / np.maximum(met, 1)
    mean[(np.abs(mean) * np.sqrt(met) < CLEAR * left.std()) | (met < SUPPORT)] = 0
    np.fill_diagonal(mean, 0)
    size, axes = np.linalg.eigh(mean.astype(float))
    best = np.argsort(-size)[:FACTORS]
    out = np.zeros((len(mean), FACTORS))
    out[:, : len(best)] = axes[:, best] * np.sqrt(np.maximum(size[best], 0))
    return out


def _threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit above which F1 is best, in the middle of the gap below it; 0 where no label is 1."""
    order = np.argsort(-logits, kind="stable")
    ranked, found = logits[order], np.cumsum(labels[order])
    if not labels.sum():
        return 0.0
    f1 = 2 * found / (np.arange(1, len(ranked) + 1) + labels.sum())
    best = int(np.argmax(f1))
    return float((ranked[best] + ranked[min(best + 1, len(ranked) - 1)]) / 2)


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of labels.toxic, fitted in one task on at most sample labelled rows that aren't held out. Of
    several labels of a document the largest counts; null labels and labels without a document don't, null texts have no
    terms, and of repeated rows each counts. Texts may be of any length, as terms count once. Without labels, or without
    documents, the model says 0 of all; other columns, whatever their names, play no part."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    own = own.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def terms(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Terms()
        for batch in batches:
            sets = [np.fromiter(known.of(x or b""), "int32").tobytes() for x in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": sets})

    def learn(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = pd.concat([*batches, pd.DataFrame({"doc_id": [], "toxic": [], "terms": []})]).sort_values(["doc_id", "terms"])
        model = fit([np.frombuffer(x, "int32") for x in found["terms"]], (found["toxic"].to_numpy() == 1).astype("int64"))
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    rows = _whole(docs).join(F.broadcast(own), "doc_id").mapInPandas(relieved(terms), "doc_id long, toxic int, terms binary")
    made = rows.repartition(1).mapInPandas(relieved(learn), "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else fit([], np.zeros(0, "int64"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of whole texts, of any length: terms count once. A null or empty text has the score
    of no terms; rows repeated whole, and ids with several texts, are scored each."""
    kept = docs.sparkSession.sparkContext.broadcast(model)  # FACTORS + 1 numbers for each term that SUPPORT of at most SAMPLE rows have

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = kept.value, Terms()
        for batch in batches:
            scores = [own.score(known.of(x.as_py() or b"")) for x in batch.column("text")]
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(x >= 0.5) for x in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    return _whole(docs).mapInArrow(relieved(run), "doc_id long, score double, predicted int")


def cleaned(docs: DataFrame, model: Model) -> DataFrame:
    """docs without the rows whose text, of any length, scores 0.5 or more; all columns stay as they are, whatever their
    names. Null and empty texts have the score of no terms, rows repeated whole are judged each, and an empty table gives
    an empty one."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = kept.value, Terms()
        for batch in batches:
            texts = ((x.as_py() or "").encode() for x in batch.column("text"))
            yield batch.filter(pa.array([own.score(known.of(x)) < 0.5 for x in texts], pa.bool_()))

    return docs.mapInArrow(relieved(run), docs.schema)


def _whole(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scored(docs, trained(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
