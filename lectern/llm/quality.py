"""Quality by supervised subword embeddings (operator 13)."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import relieved, table
from lectern.llm.toxicity import _threshold, held_out

#: Labelled rows that a model is fitted on, at most; the rows whose hashed id comes first.
SAMPLE = 12_000
#: Vectors (2 to this power) that features are hashed to, and their length.
BITS, WIDTH = 17, 8
#: Characters of a word's n-grams, the spaces round it among them.
GRAMS = (3, 4)
EPOCHS, BATCH, RATE = 5, 16, 12.0
#: Steps at least, however few rows there are.
STEPS = 2_000
#: From this score on a document is good.
GOOD = 0.3
#: Characters of a text that are hashed at once; a longer text is cut between words, and in words longer than this.
STRETCH = 1 << 20

_FACTOR, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.array([chr(c) in " \t\n\v\f\r" for c in range(33)])


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """text in pieces of size characters at most, cut at white space where there is some."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at + 1, at + size) for c in " \t\n\v\f\r")
        cut = at + size if cut <= at else cut
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def features(text: str) -> np.ndarray:
    """Buckets of a stretch's words, of its pairs of neighbouring words, and of the words' character n-grams; each as
    often as it is there. A word next to itself is one pair, whatever the word."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "uint32")
    space = _SPACE[np.minimum(codes, 32)] & (codes <= 32)
    stays = np.append(True, ~(space[1:] & space[:-1]))
    inner = ~space[stays]
    codes = np.where(inner, codes[stays], 32).astype("uint64")
    if len(codes) < 3:
        return np.zeros(0, "int32")
    starts = np.flatnonzero(inner & ~np.append(False, inner[:-1]))
    lengths = np.diff(np.append(starts, len(codes) + 1 - int(inner[-1]))) - 1
    place = np.arange(len(codes)) - np.repeat(np.append(0, starts), np.diff(np.append(np.append(0, starts), len(codes))))
    powers = np.cumprod(np.full(int(lengths.max()) + 2, _FACTOR))
    words = np.add.reduceat(np.where(inner, codes * powers[np.minimum(place, len(powers) - 1)], np.uint64(0)), starts)
    pairs = np.where(words[1:] == words[:-1], np.uint64(1), (words[1:] * _FACTOR) ^ words[:-1])
    found = [words, pairs * _SPREAD + np.uint64(2)]
    for n in GRAMS:
        grams, whole = codes[: len(codes) - n + 1].copy(), np.ones(max(0, len(codes) - n + 1), bool)
        for k in range(1, n):
            grams = grams * _FACTOR + codes[k : len(codes) - n + 1 + k]
            if k < n - 1:
                whole &= inner[k : len(codes) - n + 1 + k]
        found.append(grams[whole] * _SPREAD + np.uint64(n))
    h = np.concatenate(found)
    h ^= h >> np.uint64(32)
    h *= _SPREAD
    return (h >> np.uint64(64 - BITS)).astype("int32")


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a whole text in order, and how often each is there."""
    parts = [np.unique(features(x), return_counts=True) for x in stretches(text)]
    if len(parts) == 1:
        return parts[0]
    total = np.zeros(1 << BITS, "int64")
    for ids, n in parts:
        total[ids] += n
    ids = np.flatnonzero(total)
    return ids.astype("int32"), total[ids]


@dataclass
class Model:
    """vectors: one for each bucket; a document is their mean; softmax of mean @ output + bias."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    shift: float = 0.0

    def slopes(self) -> np.ndarray:
        """What each bucket's vector says for label 1 against 0."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype("float64")

    def score(self, text: str, slopes: np.ndarray) -> float:
        total, n = 0.0, 0
        for part in stretches(text):
            ids = features(part)
            total, n = total + float(slopes[ids].sum()), n + len(ids)
        z = total / max(n, 1) + float(self.bias[1] - self.bias[0]) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """A model from (buckets, counts) and 0/1 labels; without both classes, a constant one (score 1 without labels).

    Stochastic gradient descent over batches with a rate that falls to nothing; vectors start small and random, the
    output at nothing but for its bias. A fifth of the rows is kept from the fit and sets the shift with which GOOD is
    the threshold that finds the rows of label 0 best by F1."""
    n, positive = len(labels), int(labels.sum())
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype("float32")
    output, bias = np.zeros((WIDTH, 2), "float32"), np.zeros(2, "float32")
    if not 0 < positive < n:
        bias[1] = -30.0 if n and not positive else 30.0
        return Model(vectors, output, bias)
    kept = rng.random(n) < 0.2
    if not 0 < labels[~kept].sum() < (~kept).sum():
        kept[:] = False
    own = np.flatnonzero(~kept)
    lengths = np.array([len(ids) for ids, _ in rows])
    ids = np.concatenate([r[0] for r in rows])
    shares = np.concatenate([(r[1] / max(r[1].sum(), 1)).astype("float32") for r in rows])
    ends = np.cumsum(lengths)
    share = labels[own].mean()
    bias[:] = np.log([1 - share, share])

    def mean(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        each = lengths[part]
        at = np.repeat(ends[part] - np.cumsum(each), each) + np.arange(each.sum())
        row, used, weight = np.repeat(np.arange(len(part)), each), ids[at], shares[at]
        out = np.zeros((len(part), WIDTH), "float32")
        some = each > 0
        if some.any():
            out[some] = np.add.reduceat(vectors[used] * weight[:, None], (np.cumsum(each) - each)[some], 0)
        return out, row, used, weight

    batches = max(1, len(own) // BATCH)
    turns = max(epochs, -(-STEPS // batches))
    target = np.eye(2, dtype="float32")[labels]
    for turn in range(turns):
        for k, part in enumerate(np.array_split(rng.permutation(own), batches)):
            rate = RATE * (1 - (turn * batches + k) / (turns * batches))
            x, row, used, weight = mean(part)
            wrong = (_softmax(x @ output + bias) - target[part]) / len(part)
            back = wrong @ output.T
            output -= rate * (x.T @ wrong)
            bias -= rate / 10 * wrong.sum(0)
            seen, of = np.unique(used, return_inverse=True)
            step = np.stack([np.bincount(of, weight * back[row, d], len(seen)) for d in range(WIDTH)], 1) if len(seen) else np.zeros((0, WIDTH))
            vectors[seen] -= rate * step.astype("float32")
    model = Model(vectors, output, bias)
    if kept.any():
        z = mean(np.flatnonzero(kept))[0] @ output + bias
        low = z[:, 0] - z[:, 1]
        model.shift = float(np.log(GOOD / (1 - GOOD)) + _threshold(low, 1 - labels[kept]))
    return model


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of labels.quality, fitted in one task on at most sample labelled rows that aren't held out. Of several
    labels of a document the smallest counts; null labels and labels without a document don't."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    own = own.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [counted(x or "") for x in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "ids": [i.tobytes() for i, _ in found], "n": [n.astype("int32").tobytes() for _, n in found]})

    def learn(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = pd.concat([*batches, pd.DataFrame({"doc_id": [], "quality": [], "ids": [], "n": []})]).sort_values(["doc_id", "ids", "n"])
        rows = [(np.frombuffer(i, "int32"), np.frombuffer(n, "int32")) for i, n in zip(found["ids"], found["n"], strict=True)]
        yield pd.DataFrame({"model": [pickle.dumps(fit(rows, (found["quality"].to_numpy() == 1).astype("int64")))]})

    rows = _whole(docs).join(F.broadcast(own), "doc_id").mapInPandas(relieved(counts), "doc_id long, quality int, ids binary, n binary")
    made = rows.repartition(1).mapInPandas(relieved(learn), "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else fit([], np.zeros(0, "int64"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of whole texts of any length: the probability of label 1, and 1 where it is GOOD or
    more. A null, empty or blank text has no features and gets the bias's score; rows repeated whole, and ids with
    several texts, are scored each; a null doc_id stays. An empty table gives no rows; other columns, whatever their
    names, play no part."""
    kept = docs.sparkSession.sparkContext.broadcast((model, model.slopes()))  # 2**BITS vectors, whatever the documents

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, slopes = kept.value
        for batch in batches:
            scores = [own.score(x.as_py() or "", slopes) for x in batch.column("text")]
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(x >= GOOD) for x in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    return _whole(docs).mapInArrow(relieved(run), "doc_id long, score double, predicted int")


def _whole(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scored(docs, trained(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
