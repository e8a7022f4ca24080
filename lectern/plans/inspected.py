"""Named queries over the inspection of published documents, with faults put into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import quality
from lectern.plans import inspection
from lectern.plans.catalogue import query
from lectern.session import table

VERSES = '[{"verse":1,"text":"a","tokens":[{"token":"a"}],"spans":[{"tag":"q"},{}]},{"verse":2,"text":"b"}]'
LAYOUT = '[{"order":0,"type":"heading","anchor":{"verse":1,"edge":"before"},"text":"T","heading_type":"x","canonical":false},{"order":1,"type":"paragraph","start":1,"end":2}]'
#: What a document has in place of its verses or its layout, and the rules that it breaks by that.
FAULTS = [
    ("verses", '[{"verse":1,"text":"a","tokens":[{}],"spans":[]},{"verse":3,"text":"b"}]', ["verse numbers", "editorial place"]),
    ("verses", '[{"verse":1,"text":"","tokens":[{}],"spans":[]},{"verse":2,"text":"\\\\nb"}]', ["empty text", "leading line end"]),
    ("verses", '[{"verse":1,"text":"a","tokens":[1],"spans":[2]},{"verse":2,"text":"b"}]', ["tokens", "spans"]),
    ("verses", '[{"verse":1,"text":"a","tokens":[{}]},{"verse":2,"text":"b"}]', ["tokens without spans"]),
    ("verses", '[{"verse":1,"text":"a","titles":[]},{"verse":2,"text":"b"}]', ["titles", "no tokens"]),
    ("verses", "[]", ["no verses", "editorial place"]),
    ("verses", '[{"verse":1,"text":"\\\\"source\\\\":","tokens":[{"x\\\\"source":1}],"spans":[]},{"verse":2,"text":"b"}]', []),
    ("verses", '[{"verse":1,"text":"a","tokens":[{"deep":[{"sour\\\\u0063e":1}]}],"spans":[]},{"verse":2,"text":"b"}]', ["forbidden"]),
    ("editorial", "[]", ["editorial"]),
    ("editorial", LAYOUT.replace('"order":1', '"order":2'), ["editorial order"]),
    ("editorial", LAYOUT.replace('"paragraph"', '"other"'), ["editorial type"]),
    ("editorial", LAYOUT.replace('"end":2', '"end":2,"more":1'), ["editorial members"]),
    ("editorial", LAYOUT.replace('"edge":"before"', '"side":"before"'), ["editorial anchor"]),
    ("editorial", LAYOUT.replace('"edge":"before"', '"edge":"after"'), ["editorial edge"]),
    ("editorial", LAYOUT.replace('"text":"T"', '"text":" "'), ["editorial blank heading"]),
    ("editorial", LAYOUT.replace('"canonical":false', '"canonical":0'), ["editorial canonical"]),
    ("editorial", LAYOUT.replace('"start":1,"end":2', '"start":2,"end":1'), ["editorial range"]),
    ("editorial", LAYOUT.replace('"verse":1', '"verse":2'), ["reading order"]),
    ("editorial", LAYOUT.replace('"start":1,"end":2', '"start":2,"end":2'), ["coverage"]),
    ("editorial", LAYOUT.replace('"start":1,"end":2', '"start":1,"end":1'), ["coverage end"]),
]


def _chapter(fault: Column, book: Column, chapter: Column) -> Column:
    """A chapter document with the fault of a number, none for numbers beyond."""
    inner = {part: F.when(F.lit(False), "") for part in ("verses", "editorial")}
    for n, (part, text, _) in enumerate(FAULTS):
        inner[part] = inner[part].when(fault == n, text.replace("\\\\", "\\"))
    number = lambda c: c.cast("string")
    return F.concat(F.lit('{"book_nr":'), number(book), F.lit(',"chapter":'), number(chapter), F.lit(',"verses":'), inner["verses"].otherwise(VERSES), F.lit(',"editorial":'), inner["editorial"].otherwise(LAYOUT), F.lit("}"))


def _values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows) + ")"


RULES = _values([(n, rule) for n, (_, _, rules) in enumerate(FAULTS) for rule in rules])


@query(f"SELECT o_orderkey, rule FROM orders JOIN {RULES} v(n, rule) ON o_orderkey % {len(FAULTS) + 3} = n UNION ALL SELECT o_orderkey, 'number' FROM orders WHERE o_orderkey % {len(FAULTS) + 3} = {len(FAULTS)} UNION ALL SELECT o_orderkey, 'book' FROM orders WHERE o_orderkey % {len(FAULTS) + 3} = {len(FAULTS) + 1}")
def inspect_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that chapter documents break, each with another fault, a wrong number or book, or none."""
    key, of = F.col("o_orderkey"), F.col("o_orderkey") % (len(FAULTS) + 3)
    body = _chapter(of, F.when(of == len(FAULTS) + 1, 0).otherwise(key), F.when(of == len(FAULTS), 0).otherwise(key))
    rows = table(spark, sf_dir, "orders").repartition(spark.sparkContext.defaultParallelism).select("o_orderkey", body.alias("body"))
    return quality.broken_rules(quality.chapter_facts(rows, ["o_orderkey"], "o_orderkey", "o_orderkey", "body"), ["o_orderkey"])


@query("""
SELECT doc_id, CASE doc_id % 6 WHEN 1 THEN 'source' WHEN 3 THEN 'source,source_contract' WHEN 4 THEN 'source_contract' WHEN 5 THEN NULL ELSE '' END AS members FROM documents
""")
def forbidden_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forbidden members at any depth of documents' texts as JSON: a name with a quote before it is another one, a text isn't
    a name, an escaped letter is a letter, and what is cut off is no JSON."""
    text, of = F.to_json(F.struct(F.concat(F.lit('"source":'), "text").alias("t"))), F.col("doc_id") % 6
    put = lambda before, after: F.concat(F.lit(before), text, F.lit(after))
    json = (
        F.when(of == 0, put('{"x\\"source": 1, "y": ', "}")).when(of == 1, put('[[{"a": [{"source": null}]}], ', "]")).when(of == 2, put('{"sources": ', "}"))
        .when(of == 3, put('{"source_contract": {"source" : {}}, "z": ', "}")).when(of == 4, put('{"sourc\\u0065_contract": ', "}")).otherwise(put('{"source": ', ""))
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(quality.forbidden_members(json), ",").alias("members"))


@query(f"""
WITH c AS (SELECT DISTINCT conv_id, conv_id % 3 AS t FROM conversations), d AS (SELECT DISTINCT 't' || t AS abbr FROM c),
     k AS (SELECT conv_id, 't' || t AS abbr, conv_id % 29 AS f FROM c)
SELECT abbr || '/' || conv_id || '/1' AS place, rule FROM k JOIN {RULES} v(n, rule) ON f = n
UNION ALL SELECT abbr || '/' || conv_id || '/2', 'missing chapter' FROM k UNION ALL SELECT abbr || '/' || conv_id, 'book name' FROM k WHERE conv_id % 7 = 3 UNION ALL SELECT abbr || '/' || conv_id, 'book missing' FROM k WHERE conv_id % 7 = 4
UNION ALL SELECT abbr, 'abbreviation' FROM d WHERE abbr = 't1' UNION ALL SELECT abbr, 'forbidden' FROM d WHERE abbr = 't2' UNION ALL SELECT 'none', 'missing translation'
UNION ALL SELECT 'none/1', 'book missing' UNION ALL SELECT 'none/1/1', 'missing chapter'
UNION ALL SELECT * FROM (VALUES ('out', 'size'), ('out/large', 'size'), ('out/.x.tmp', 'temporary'), ('out/l', 'link'), ('void', 'empty'), ('gone', 'missing')) v(place, rule)
""")
def inspect_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call finds all faults of a tree made of conversations: of chapters, books, translations, files and roots."""
    convs = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    conv, abbr = F.col("conv_id"), F.concat(F.lit("t"), (F.col("conv_id") % 3).cast("string"))
    chapters = convs.select(abbr.alias("abbreviation"), conv.alias("nr"), F.lit(1).cast("bigint").alias("chapter"), _chapter(conv % 29, conv, F.lit(1)).alias("body"))
    name = F.concat(F.lit("Book "), F.when(conv % 7 == 3, "x").otherwise(conv.cast("string")))
    listed = convs.where("conv_id % 7 <> 4").groupBy(abbr.alias("abbreviation")).agg(F.collect_list(F.struct(conv.alias("nr"), name.alias("name"))).alias("books"))
    more = F.when(F.col("abbreviation") == "t2", F.lit("x")).alias("source")
    translations = listed.select("abbreviation", F.to_json(F.struct(F.when(F.col("abbreviation") == "t1", "other").otherwise(F.col("abbreviation")).alias("abbreviation"), "books", more)).alias("body"))
    wanted = convs.select(abbr.alias("abbreviation"), conv.alias("nr"), F.array(F.concat(F.lit("book"), conv.cast("string"))).alias("aliases"), F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("chapter"))
    none = spark.range(1).select(F.lit("none"), F.lit(1).cast("bigint"), F.array(F.lit("a")), F.lit(1).cast("bigint"))
    files = spark.createDataFrame([("out", "large", "file", 100), ("out", "a", "file", 5), ("out", ".x.tmp", "file", 1), ("out", "l", "link", 0), ("void", "e", "file", 0)], "root string, path string, kind string, size long")
    roots = spark.createDataFrame([("out",), ("void",), ("gone",)], "root string")
    return inspection.inspect(translations, chapters, files, roots, wanted.union(none), 100).violations
