"""Ordered layout: covering ranges, headings, and their common order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def covering_ranges(rows: DataFrame, group: list[str], position: str, start: Column) -> DataFrame:
    """(group..., start, end) long: inclusive ranges that cover each group's positions without a gap.

    A range opens at each row whose start flag is true, and at the first row if a later one is; it closes before
    the next. Groups without a true flag have none. Null flags count as false."""
    flagged = rows.select(*group, F.col(position).alias("__at"), F.coalesce(start, F.lit(False)).alias("__start"))
    ordered, whole = Window.partitionBy(*group).orderBy("__at"), Window.partitionBy(*group)
    opened = F.col("__start") | (F.row_number().over(ordered) == 1)
    islands = (
        flagged.withColumn("__any", F.bool_or("__start").over(whole))
        .where("__any")
        .withColumn("__open", opened)
        .withColumn("__island", F.sum(F.col("__open").cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return islands.groupBy(*group, "__island").agg(F.min("__at").cast("long").alias("start"), F.max("__at").cast("long").alias("end")).drop("__island")


def positions(rows: DataFrame, group: list[str], number: str, order: list[str]) -> DataFrame:
    """(group..., number, position): a valid number's dense place in order; of repeated numbers the last place."""
    window = Window.partitionBy(*group).orderBy(*order)
    placed = rows.where(F.col(number) > 0).withColumn("position", F.row_number().over(window))
    return placed.groupBy(*group, number).agg(F.max("position").alias("position"))


def heading_rows(titles: DataFrame, group: list[str]) -> DataFrame:
    """Headings of titles (group..., verse, level, seq, type, text, canonical): blank texts go, a missing type is
    'unspecified', canonical is true only if it is exactly that, and of equal ones (verse, text, type, canonical)
    the first stays. level 0 are the chapter's own, at its first verse, which come before a verse's."""
    from lectern.functions.text import is_blank

    kind = F.when(F.coalesce(is_blank(F.col("type"), ""), F.lit(True)), "unspecified").otherwise(F.col("type"))
    rows = titles.where(~F.coalesce(is_blank(F.col("text"), ""), F.lit(True))).withColumn("type", kind).withColumn("canonical", F.coalesce("canonical", F.lit(False)))
    turn = F.row_number().over(Window.partitionBy(*group, "verse", "text", "type", "canonical").orderBy("level", "seq"))
    return rows.withColumn("__turn", turn).where("__turn = 1").drop("__turn")


def editorial(verses: DataFrame, titles: DataFrame, group: list[str]) -> DataFrame:
    """(group..., order, type, verse, text, heading_type, canonical, start, end) of verses (group..., ordinal, verse,
    paragraph) and titles: headings at their verse and ranges that cover the chapter, in reading order from 0, a
    heading before the range that starts at its verse."""
    placed = verses.where(F.col("verse") > 0).withColumn("position", F.row_number().over(Window.partitionBy(*group).orderBy("ordinal")).cast("bigint"))
    ranges = covering_ranges(placed, group, "position", F.col("paragraph"))
    at = lambda name, out: placed.select(*group, F.col("position").alias(name), F.col("verse").alias(out))
    ranges = ranges.join(at("start", "v_start"), [*group, "start"]).join(at("end", "v_end"), [*group, "end"])
    heads = heading_rows(titles, group).join(positions(verses, group, "verse", ["ordinal"]), [*group, "verse"])
    both = heads.select(*group, "position", F.lit(0).alias("kind"), "level", "seq", F.lit("heading").alias("type"), "verse", "text", F.col("type").alias("heading_type"), "canonical").unionByName(
        ranges.select(*group, F.col("start").alias("position"), F.lit(1).alias("kind"), F.lit("paragraph").alias("type"), F.col("v_start").alias("start"), F.col("v_end").alias("end")), allowMissingColumns=True
    )
    order = F.row_number().over(Window.partitionBy(*group).orderBy("position", "kind", F.col("level").asc_nulls_last(), F.col("seq").asc_nulls_last())) - 1
    return both.select(*group, order.cast("bigint").alias("order"), "type", "verse", "text", "heading_type", "canonical", "start", "end")
