"""Inspection of a published corpus: every violation as a row, and the reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lectern.operators import nesting, quality
from lectern.session import settled


def violations(verses: DataFrame, editorial: DataFrame, wanted: DataFrame, chapters: DataFrame, group: list[str]) -> DataFrame:
    """(group..., rule): missing chapters (wanted's keys without a row in chapters), and what breaks the rules of verses
    and of layouts."""
    gone = quality.missing_targets(wanted, chapters, group).select(*group, F.lit("missing chapter").alias("rule"))
    of_verses = quality.verse_violations(verses, group).select(*group, "rule")
    return gone.unionByName(of_verses).unionByName(quality.editorial_violations(editorial, verses, group).select(*group, "rule"))


def reports(verses: DataFrame, files: DataFrame, group: list[str]) -> dict[str, DataFrame]:
    """sizes (files root, path, size), largest, coverage, tags, profiles of verses as JSON, and a representative verse a
    chapter: one with structure, else with spans, else the first."""
    has = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    rank = F.when(F.coalesce(F.col("paragraph"), F.lit(False)), 0).when(has("spans"), 1).otherwise(2)
    profiled = verses.withColumn("json", F.to_json(F.struct(*[c for c in verses.columns if c not in group])))
    return {
        "sizes": quality.size_report(files, "root", "path", "size"),
        "largest": quality.largest(files, "path", "size"),
        "coverage": quality.coverage(verses, group, "tokens", "spans"),
        "tags": quality.tag_counts(verses, "spans"),
        "profiles": quality.key_profile(profiled, group, "json"),
        "representative": nesting.representative(verses, group, rank, "verse"),
    }


@dataclass
class Inspection:
    """violations: (place, rule). chapters: a row a chapter document with its counts. tags: (tag, n). sizes: by root and
    over all. largest: the largest files. totals: what was counted while the documents were read."""

    violations: DataFrame
    chapters: DataFrame
    tags: DataFrame
    sizes: DataFrame
    largest: DataFrame
    totals: dict[str, int]


def inspect(translations: DataFrame, chapters: DataFrame, files: DataFrame, roots: DataFrame, wanted: DataFrame, limit: int = quality.MAX_FILE) -> Inspection:
    """All that is wrong with a published tree, and the reports on it, in one call.

    translations: (abbreviation, body). chapters: (abbreviation, nr, chapter, body); those of wanted books are read, once.
    files: (root, path, kind, size), as trees.entries lists them. roots: (root). wanted: (abbreviation, nr, aliases,
    chapter), a row for each chapter that must be there, with the names that its book may have, as normalized_name
    gives them. A file at the limit, a folder of nothing, a name that an interrupted write left, links, a translation that
    isn't its name's, members that no document may have, missing and misnamed books, missing chapters, and each rule of
    quality.chapter_facts that a chapter breaks are rows of their own."""
    at = ["abbreviation", "nr", "chapter"]
    books = wanted.select("abbreviation", "nr", "aliases").distinct()
    seen = Observation()
    read = quality.chapter_facts(chapters.join(books.select("abbreviation", "nr").distinct(), ["abbreviation", "nr"], "left_semi"), at, "nr", "chapter", "body")
    read = read.observe(seen, F.count("*").alias("chapters"), F.coalesce(F.sum("verses"), F.lit(0)).alias("verses"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum(F.size("tags")), F.lit(0)).alias("spans"), F.count_if(F.size("rules") > 0).alias("broken"))
    facts = settled(read)
    v = F.try_parse_json("body")
    own = translations.select("abbreviation", v.alias("v"), quality.forbidden_members(F.col("body")).alias("members"))
    own = settled(own.select("abbreviation", "members", F.try_variant_get("v", "$.abbreviation", "string").alias("said"), F.try_variant_get("v", "$.books", "array<struct<nr:bigint,name:string>>").alias("books")))
    named = own.select("abbreviation", F.explode("books").alias("b")).select("abbreviation", F.col("b.nr").cast("bigint").alias("nr"), F.coalesce("b.name", F.lit("")).alias("name"))
    named = nesting.first_wins(named.withColumn("k", F.monotonically_increasing_id()), ["abbreviation", "nr"], [], ["k"])
    place = lambda *parts: F.concat_ws("/", *[F.col(c).cast("string") for c in parts])
    told = lambda rows, where, rule="rule": rows.select(where.alias("place"), F.col(rule).alias("rule"))
    fixed = lambda rows, where, rule: rows.select(where.alias("place"), F.lit(rule).alias("rule"))
    regular, below = files.where("kind = 'file'"), F.concat_ws("/", "root", "path")
    found = [
        told(quality.size_gate(roots, regular, "root", "size", limit), F.col("root")),
        told(quality.oversized(regular.withColumn("whole", below), "whole", "size", limit), F.col("path")),
        fixed(files.where("kind IN ('link', 'other')"), below, "link"),
        fixed(wanted.select("abbreviation").distinct().join(own, "abbreviation", "left_anti"), F.col("abbreviation"), "missing translation"),
        fixed(own.where(F.size("members") > 0), F.col("abbreviation"), "forbidden"), fixed(own.where("NOT said <=> abbreviation"), F.col("abbreviation"), "abbreviation"),
        told(quality.misnamed(books, named, ["abbreviation", "nr"], "name", "aliases").withColumn("rule", F.concat(F.lit("book "), "rule")), place("abbreviation", "nr")),
        fixed(quality.missing_targets(wanted, facts, at), place(*at), "missing chapter"),
        told(quality.broken_rules(facts, at), place(*at)),
    ]
    tags = facts.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n")).orderBy("tag")
    shown = facts.select(*at, "verses", "with_tokens", "with_spans", "tokens", F.size("tags").cast("bigint").alias("spans"), "headings", "paragraphs")
    return Inspection(reduce(DataFrame.unionByName, found), shown, tags, quality.size_report(regular, "root", "path", "size"), quality.largest(regular.withColumn("whole", below), "whole", "size"), seen.get)
