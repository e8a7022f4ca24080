"""A training-data pipeline: toxic documents go, one of each group of near copies stays, passages that repeat go,
personal data is hidden, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's
docs. All but the last return the columns of documents, and pass further columns on, whatever their names. Every
stage takes whole texts of any length; an empty table gives an empty one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import packing, pii, shingles, suffixes, toxicity
from lectern.llm.common import shared_dir, table

#: Words whose ids a worker keeps in the last stage: fewer than where packing runs alone, as the stages before have
#: filled the executors' heaps by then.
CACHED_WORDS = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine predicts to be toxic go; it learns from labels that aren't held out.
    Null and empty texts have the score of no terms. Rows repeated whole, and ids with several texts, are judged
    each. Without labels nothing goes."""
    return toxicity.cleaned(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (SimHash candidates, widened to five-word shingles of similarity 0.8), the one with the smallest
    doc_id stays: of equals any one, of rows without a doc_id one if the group has no other. Null, empty and blank
    texts are copies of each other."""
    return shingles.first_of_groups(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in a run of 50 that also starts in another document go from all documents that have it, the first too, as
    operator 10 has it; runs are found by its sort of suffixes, down to 50 words, as 400 bytes can't see them all. The
    documents stay. Rows with the same doc_id take nothing from each other, nor does a text from itself; rows without a
    doc_id and null texts stay as they are; a text that is all repeated becomes empty."""
    return suffixes.deduplicated(docs, suffixes.word_kind(first_stays=False))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind. Null texts stay null, empty ones empty; each row counts by itself."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048 at most. A null or empty text has the end id alone; every row is packed,
    repeated ones too; equal lengths are placed in order of id, piece and content."""
    return packing.packed(docs, cached=CACHED_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", drop_repeats),
    ("personal_data", hide_personal_data),
    ("packing", pack),
]

#: Tokens and trained models aren't in SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written under the shared folder and read again."""
    docs, at = table(spark, sf_dir, "documents"), f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
