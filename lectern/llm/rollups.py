"""Delta-maintained token counts (operator 9)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import cut, relieved, shared_dir, table
from lectern.llm.tokens import encoder, vocabulary
from lectern.sources import trees

KEYS = ["source", "lang", "tokenizer"]
ITEM = ["doc_id", "part", "tokenizer"]
LEDGER = "doc_id long, part string, tokenizer string, source string, lang string, tokens long, n_docs long, gone boolean, at long"
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
#: Commits after which the changes since the last whole ledger are folded into a new one.
FOLD = 16
#: Items of a batch that are broadcast at most, to find what they counted for; more are joined by a shuffle.
LOOKED_UP = 50_000
#: Words whose ids a worker keeps: few, as the heaps of executors fill up while five commits run.
CACHED_WORDS = 100_000


class Rollup:
    """Totals by source, language and tokenizer version, kept by signed changes under a folder.

    Each commit is a folder of its number with its own changes, the totals after it, and the batch ids applied so
    far. What an item counts for is what the last change of it says; each fold-th commit also holds the whole ledger
    up to it, so that a commit writes as much as its batch holds, and reads what came since the last ledger.
    A commit is written whole under another name and renamed, and readers take the highest number, so that a batch
    that was cut short has never been; a batch id that is already there changes nothing. Of two writers that make the
    same number, the one whose rename comes second raises and has changed nothing; it may apply its batch again. What
    writers that died have left under other names goes by clear().

    Changes are rows (doc_id, source, lang, tokenizer, tokens, op), op being 'insert', 'revise' or 'delete', and may
    have part (string, '' by default), which tells items of a doc_id apart, and n_docs (1 by default), the documents
    that an item stands for. An insert or revise sets what (doc_id, part, tokenizer) counts for, a delete takes it
    away; of several in a batch the delete wins, then the largest (tokens, source, lang, n_docs). Null tokens count
    as 0; null sources and languages are values of their own. Other ops, null doc_ids and null tokenizers are counted
    nowhere."""

    def __init__(self, spark: SparkSession, folder: str, fold: int = FOLD, looked_up: int = LOOKED_UP) -> None:
        self.spark, self.folder, self.fold, self.looked_up = spark, folder.rstrip("/"), fold, looked_up
        self._store = trees.Store(spark, self.folder)

    def version(self) -> int:
        return max(self._numbers(), default=0)

    def _read(self, name: str, schema: str) -> DataFrame:
        at = self.version()
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{at}/{name}") if at else self.spark.createDataFrame([], schema)

    def totals(self) -> DataFrame:
        return self._read("totals", TOTALS)

    def applied(self) -> DataFrame:
        return self._read("batches", "batch_id string")

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in self._names() if n.isdigit())

    def _names(self) -> list[str]:
        return [path for path, *_ in self._store.inside("")] if self._store.exists("") else []

    def clear(self) -> int:
        """Removes what commits that were cut short have left, for when no writer runs; how many there were."""
        left = [n for n in self._names() if n.startswith(".")]
        for name in left:
            self._store.drop(name)
        return len(left)

    def _base(self) -> int:
        """The last commit with a whole ledger, or 0."""
        return max((n for n in self._numbers() if self._store.exists(f"{n}/ledger")), default=0)

    def _said(self, base: int) -> DataFrame:
        """All that the last ledger and the changes since say, older ones too."""
        parts = [f"{self.folder}/{base}/ledger"] if base else []
        parts += [f"{self.folder}/{n}/changes" for n in self._numbers() if n > base]
        return self.spark.read.schema(LEDGER).parquet(*parts) if parts else self.spark.createDataFrame([], LEDGER)

    def ledger(self) -> DataFrame:
        """What each item counts for now."""
        return _last(self._said(self._base())).where("NOT gone")

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commits a batch; False, and nothing done, if it is already in."""
        if not self.applied().where(F.col("batch_id") == batch_id).isEmpty():
            return False
        at, base, made = self.version() + 1, self._base(), f"{self.folder}/.{uuid.uuid4().hex}"
        for name, default in (("part", F.lit("")), ("n_docs", F.lit(1))):
            changes = changes.withColumn(name, F.coalesce(name, default) if name in changes.columns else default)
        one = F.struct(F.col("op") == "delete", F.coalesce("tokens", F.lit(0)), "source", "lang", "n_docs")
        rows = changes.where("op IN ('insert', 'revise', 'delete') AND doc_id IS NOT NULL AND tokenizer IS NOT NULL")
        best = rows.groupBy(*ITEM).agg(F.max_by(F.struct("source", "lang", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), F.col("n_docs").cast("long").alias("n_docs"), (F.col("op") == "delete").alias("gone")), one).alias("x"))
        best.select(*ITEM, "x.*", F.lit(at).cast("long").alias("at")).write.parquet(f"{made}/changes")
        new, said = self.spark.read.schema(LEDGER).parquet(f"{made}/changes"), self._said(base)
        items = new.select(*ITEM)
        old = _last(said.join(F.broadcast(items) if new.count() <= self.looked_up else items, ITEM, "left_semi"))
        signed = lambda rows, sign: rows.where("NOT gone").select(*KEYS, (sign * F.col("n_docs")).alias("d"), (sign * F.col("tokens")).alias("t"))
        before = self.totals().select(*KEYS, F.col("n_docs").alias("d"), F.col("n_tokens").alias("t"))
        summed = before.union(signed(old, -1)).union(signed(new, 1)).groupBy(*KEYS).agg(F.sum("d").alias("n_docs"), F.sum("t").alias("n_tokens"))
        summed.where("n_docs <> 0 OR n_tokens <> 0").select(*KEYS, F.col("n_docs").cast("long"), F.col("n_tokens").cast("long")).write.parquet(f"{made}/totals")
        self.applied().union(self.spark.createDataFrame([(batch_id,)], "batch_id string")).coalesce(1).write.parquet(f"{made}/batches")
        if at - base >= self.fold:
            _last(said.union(new)).where("NOT gone").write.parquet(f"{made}/ledger")
        self._placed(made.rpartition("/")[2], at)
        if at - base >= self.fold:
            for n in self._numbers():
                if n < base:  # a reader may still be at the last commit, which needs base and what follows
                    self._store.drop(str(n))
        return True

    def _placed(self, made: str, at: int) -> None:
        """The commit itself: a name that isn't there yet, given in one step."""
        if not self._store.place(made, str(at)):
            self._store.drop(made)
            raise RuntimeError(f"commit {at} is there already: another writer was faster")


def _last(said: DataFrame) -> DataFrame:
    """Of what is said of an item, the last. A later commit says it but once."""
    columns = [c.split()[0] for c in LEDGER.split(", ")]
    last = said.groupBy(*ITEM).agg(F.max_by(F.struct(*columns[3:]), "at").alias("x"))
    return last.select(*ITEM, "x.*")


def counted(docs: DataFrame, path: str | None = None, version: str = "word_bpe_49k") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens) of whole texts by the word BPE and by white space ('words').
    A null text has no tokens."""
    path = path or vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, CACHED_WORDS).encode
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column("text")]
            n = [len(ids) // 4 for ids in encode(texts)] + [len(x.split()) for x in texts]
            twice = pa.concat_batches([batch, batch])
            names = pa.array([version] * len(texts) + ["words"] * len(texts), pa.string())
            columns = [*(twice.column(c) for c in ("doc_id", "source", "lang")), names, pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "source", "lang", "tokenizer", "tokens"])

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(relieved(run, "tokens"), "doc_id long, source string, lang string, tokenizer string, tokens long")


def items(counts: DataFrame) -> DataFrame:
    """Counts of rows (doc_id, source, lang, tokenizer, tokens), summed to items of a Rollup. Rows that share a doc_id
    count each; rows without one are items of the doc_id 0 with a part of their own."""
    rows = counts.groupBy("doc_id", *KEYS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_docs"))
    part = F.to_json(F.struct(F.col("doc_id").isNull().alias("no_id"), "source", "lang"))
    return rows.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), part.alias("part"), *KEYS, "tokens", "n_docs")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all rows of documents after five commits to a new rollup: inserts with a provisional count (a quarter
    of n_chars), the counts that a tokenizer gives as revisions, the same batch again (which changes nothing), deletes
    of the items without a token, and their insertion anew. Null and blank texts count as documents of 0 tokens,
    rows without a doc_id or with a repeated one as documents of their own; an empty table has no totals."""
    docs = table(spark, sf_dir, "documents")
    kept = Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    known = cut(items(counted(docs)))
    names = F.explode(F.array(F.lit("word_bpe_49k"), F.lit("words"))).alias("tokenizer")
    first = items(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", names, F.floor(F.col("n_chars") / 4).cast("long").alias("tokens")))
    kept.apply("provisional", first.withColumn("op", F.lit("insert")))
    revised = known.withColumn("op", F.lit("revise"))
    kept.apply("counted", revised)
    kept.apply("counted", revised)
    blank = known.where("tokens = 0")
    kept.apply("blank", blank.withColumn("op", F.lit("delete")))
    kept.apply("blank again", blank.withColumn("op", F.lit("insert")))
    return kept.totals()
