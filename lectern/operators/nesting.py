"""Nesting flat rows into documents, and first-wins and last-wins reductions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nest(rows: DataFrame, group: list[str], order: list[str], fields: list[str], name: str, kept: list[Column] = ()) -> DataFrame:
    """A row a group with an array of structs of fields, in order; kept are more aggregates."""
    ordered = F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], F.struct(*fields).alias("__v"))))
    return rows.groupBy(*group).agg(F.transform(ordered, lambda x: x["__v"]).alias(name), *kept)


def last_wins(rows: DataFrame, group: list[str], key: Column, value: str, order: str) -> DataFrame:
    """(group..., key, value, first): of rows with the same key (lower case) the last value, and the first place."""
    keyed = rows.withColumn("key", F.lower(key))
    return keyed.groupBy(*group, "key").agg(F.max_by(value, order).alias("value"), F.min(order).alias("first"))


def as_map(rows: DataFrame, group: list[str]) -> DataFrame:
    """last_wins' rows as one map a group, its keys in the order in which they were first seen."""
    entries = F.transform(F.array_sort(F.collect_list(F.struct("first", "key", "value"))), lambda x: F.struct(x["key"], x["value"]))
    return rows.groupBy(*group).agg(F.map_from_entries(entries).alias("entries"))


def first_wins(rows: DataFrame, group: list[str], same: list[Column], order: list[str]) -> DataFrame:
    """The first of the rows of a group that agree in same."""
    turn = F.row_number().over(Window.partitionBy(*group, *same).orderBy(*order))
    return rows.withColumn("__turn", turn).where("__turn = 1").drop("__turn")


def representative(rows: DataFrame, group: list[str], priority: Column, position: str) -> DataFrame:
    """The row of each group with the least (priority, position)."""
    best = F.min_by(F.struct(*rows.columns), F.struct(priority.alias("p"), F.col(position).alias("q")))
    return rows.groupBy(*group).agg(best.alias("x")).select("x.*")


def with_children(parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """Parents that have a child."""
    return parents.join(children.select(*keys).distinct(), keys, "left_semi")


def with_file_and_folder(parents: DataFrame, files: DataFrame, folders: DataFrame, keys: list[str]) -> DataFrame:
    """Children named by their parents that have a file and a folder of their own: those a listing shows."""
    return with_children(with_children(parents, files, keys), folders, keys)


def cells(rows: DataFrame, group: list[str], chapters: str, verses: str) -> DataFrame:
    """(group..., chapter, verse) of a grid: chapters from 1 to a number, each with verses from 1 to its element of an
    array of numbers."""
    outer = rows.select(*group, verses, F.explode(F.when(F.col(chapters) > 0, F.sequence(F.lit(1), F.col(chapters).cast("int")))).alias("chapter"))
    last = F.get(F.col(verses), F.col("chapter") - 1).cast("int")
    return outer.select(*group, "chapter", F.explode(F.when(last > 0, F.sequence(F.lit(1), last))).alias("verse"))


def scanned(grid: DataFrame, texts: DataFrame, group: list[str], text: str) -> DataFrame:
    """cells() with the text at each place, without places that have none."""
    return grid.join(texts, [*group, "chapter", "verse"]).where(F.length(text) > 0)


def first_sample(rows: DataFrame, group: list[str], order: list[str], flag: Column) -> DataFrame:
    """(group..., flag): what the first row of each group, in order, says for all of it; false for null."""
    return rows.groupBy(*group).agg(F.coalesce(F.min_by(flag, F.struct(*order)), F.lit(False)).alias("flag"))


def filtered_map(entries: Column, part: str) -> Column:
    """A map's entries whose key contains part."""
    return F.map_filter(entries, lambda k, v: F.contains(k, F.lit(part)))


def with_defaults(entries: Column, prefix: str, keys: list[str], defaults: dict[str, Column] | None = None) -> list[Column]:
    """Columns prefix_key of a map's values, empty or as given where a key is missing."""
    given = defaults or {}
    return [F.coalesce(F.try_element_at(entries, F.lit(k)), given.get(k, F.lit(""))).alias(f"{prefix}_{k.lower()}") for k in keys]
