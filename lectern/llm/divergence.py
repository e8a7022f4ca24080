"""How sources of a language differ in the terms that they use (operator 11)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import cut, relieved, table

#: Documents of a language that a term must be in to be kept.
SUPPORT = 30
#: Added to every count, and what probabilities are multiplied by.
ADDED, SCALE = 5, 1_000_000_000
#: Terms reported of each group.
REPORTED = 50
#: Entries (a term of a group) that a task counts before it hands them on.
HELD = 400_000
#: Groups that are broadcast at most (some 100 bytes each); more are joined by key.
SENT = 50_000
#: Sources of a language that meet the others in one block of pairs.
BLOCK = 1_024

#: Every byte of a term: letters of ASCII in lower case, and all that isn't ASCII. Other bytes become spaces.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
COUNTED = "lang string, source string, term binary, n long, docs long"


def counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): how often a group has a term, and in how many of its rows. Each task adds up what
    it reads, held entries at a time, before the rows are dealt by group and term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[Counter, Counter]] = {}
        entries = 0

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), (often, rows) in found.items():
                terms = list(often)
                same = [pa.array([x] * len(terms), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(terms, pa.binary()), pa.array(often.values(), pa.int64()), pa.array([rows[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            found.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
                words = text.as_py().translate(FOLDED).split(b" ")
                often, rows = found.setdefault((lang, source), (Counter(), Counter()))
                entries -= len(often)
                often.update(words)
                del often[b""]
                entries += len(often)
                rows.update(set(words))
                if entries > held:
                    entries = 0
                    yield from told()
        yield from told()

    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), text.alias("text"))
    return rows.mapInArrow(relieved(run), COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * terms)), exact for whole numbers of up to 20 digits."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + ADDED).cast("decimal(20,0)")
    below = total.cast("decimal(20,0)") + ADDED * terms.cast("decimal(18,0)")
    return F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(1,0)"))) + 1


def audit(docs: DataFrame, support: int = SUPPORT, reported: int = REPORTED) -> DataFrame:
    """(lang, source, part, item, value, rank) of each (lang, source) of docs (text, lang, source).

    Terms are runs of letters, A-Z in lower case and all characters beyond ASCII as they are; a language keeps those
    that support of its rows have. part 'pair' ranks the other sources of the language by how far they are from this
    one, over all kept terms; part 'term' ranks the terms that the group uses more than its language does.

    A pair's distance is never summed over the vocabulary. Each side's terms are priced as if the other had none of
    them, from a histogram of the group's counts: their sum is a closed form, but for the counts so low that the
    other's share of an absent term lies above theirs. Terms that neither has cost a constant each. Then
    postings that both sides have, joined by term, put right what was priced one-sidedly.

    Null text, lang and source count as ''. Texts may be of any length; bytes beyond ASCII count as they are, UTF-8 or
    not. Every row counts by itself: repeated rows and ids as often as they are there. Groups without terms are
    there, their pairs too (value 0 where the language keeps no term). Ties go to the smaller item by UTF-8. An empty
    table gives no rows. Other columns, whatever their names, play no part."""
    by_term = Window.partitionBy("lang", "term")
    spread = counts(docs).repartition("lang", "term")
    spread = spread.select("lang", "source", "term", "n", *(F.sum(c).over(by_term).alias(f"all_{c}") for c in ("n", "docs")), F.min("source").over(by_term).alias("first"))
    kept = cut(spread.where(F.col("all_docs") >= support).drop("all_docs"))

    # The groups, with N, the number of own terms, and the language's N and V.
    there = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("k"), F.count_if(F.col("source") == F.col("first")).alias("v"))
    groups = there.join(own, ["lang", "source"], "left").na.fill(0, ["total", "k", "v"])
    langs = groups.groupBy("lang").agg(F.sum("v").alias("v"), F.sum("total").alias("all_total"))
    groups = groups.drop("v").join(langs, "lang")
    groups = cut(groups.withColumn("zero", share(F.lit(0), F.col("total"), F.col("v"))))
    few = groups.count() <= SENT

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    priced = kept.join(sent(groups.select("lang", "source", "total", "v", "zero", "all_total")), ["lang", "source"])
    priced = priced.withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    bins = cut(priced.groupBy("lang", "source", "p").agg(F.count("*").alias("terms")))

    sides = groups.join(bins.groupBy("lang", "source").agg(F.sum(F.col("p") * F.col("terms")).alias("mass")), ["lang", "source"], "left").na.fill(0, ["mass"])
    numbered = sides.select("lang", "source", "zero", "k", "v", "mass")
    both = _pairs(numbered, few)
    apart = F.abs(F.col("zero") - F.col("zero_"))
    alone = F.col("mass") - F.col("k") * F.col("zero_") + F.col("mass_") - F.col("k_") * F.col("zero") + (F.col("v") - F.col("k") - F.col("k_")) * apart
    flat = both.select("lang", F.col("source").alias("a"), F.col("source_").alias("b"), F.coalesce(alone, F.lit(0)).alias("value"))

    # Counts whose share is below another group's share of nothing: |p - z| is z - p there, and not p - z.
    others = groups.select("lang", F.col("source").alias("source_"), F.col("zero").alias("zero_"))
    most = groups.groupBy("lang").agg(F.max("zero").alias("most"))
    low = bins.join(F.broadcast(most) if few else most, "lang").where("p < most")
    low = low.join(sent(others), "lang").where("p < zero_ AND source <> source_")
    turned = low.select("lang", F.least("source", "source_").alias("a"), F.greatest("source", "source_").alias("b"), (2 * F.col("terms") * (F.col("zero_") - F.col("p"))).alias("value"))

    # Terms that both have.
    mine = priced.select("lang", "term", "source", "p", "zero")
    met = mine.join(mine.select("lang", "term", *(F.col(c).alias(f"{c}_") for c in ("source", "p", "zero"))), ["lang", "term"]).where("source < source_")
    right = F.abs(F.col("p") - F.col("p_")) - F.abs(F.col("p") - F.col("zero_")) - F.abs(F.col("p_") - F.col("zero")) + apart
    overlap = met.select("lang", F.col("source").alias("a"), F.col("source_").alias("b"), right.alias("value"))

    pairs = flat.union(turned).union(overlap).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", "value", ways.alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    more = priced.withColumn("value", F.col("p") - share(F.col("all_n"), F.col("all_total"), F.col("v"))).where("value > 0")
    terms = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")

    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(ranks)) for x in (pairs, terms)]
    return ranked[0].union(ranked[1].where(F.col("rank") <= reported)).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


def _pairs(groups: DataFrame, few: bool) -> DataFrame:
    """Each two groups of a language once, the columns of the greater source with _ at the end. A language's sources are
    dealt into blocks, and each meets all in every block: the pairs of one language, which are rows of the result, are
    made by many tasks."""
    n = 1 if few else -(-groups.count() // BLOCK)
    left = groups.withColumn("block", F.pmod(F.xxhash64("source"), F.lit(n)))
    right = groups.select("lang", *(F.col(c).alias(f"{c}_") for c in groups.columns if c != "lang"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("block"))
    return left.join(F.broadcast(right) if few else right, ["lang", "block"]).where("source < source_")


def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
     t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
     k AS (SELECT lang, term, count(*) AS all_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
     v AS (SELECT lang, count(*) AS v, CAST(sum(all_n) AS BIGINT) AS all_total FROM k GROUP BY lang),
     g AS (SELECT DISTINCT lang, source FROM d),
     c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
     s AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY lang, source),
     p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * v.v) AS p,
                  1 + (1000000000 * (k.all_n + 5)) // (v.all_total + 5 * v.v) AS q
           FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s ON g.lang = s.lang AND g.source = s.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
     f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
     x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
           FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
           UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
     y AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM x)
SELECT lang, source, part, item, value, rank FROM y WHERE part = 'pair' OR rank <= 50
"""
