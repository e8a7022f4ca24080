"""Lookup joins with explicit defaults, and gates over sets of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a dimension that is broadcast at most; a larger one is joined by its key.
BROADCAST_ROWS = 200_000


def small(dim: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """dim with a broadcast hint, if it has limit rows at most."""
    return F.broadcast(dim) if dim.limit(limit + 1).count() <= limit else dim


def with_default(rows: DataFrame, dim: DataFrame, keys: dict[str, str], value: str, default: Column, name: str) -> DataFrame:
    """rows with name: dim's value at the keys (rows' column to dim's column), or the default where dim has no row or
    a null. dim has one row a key."""
    renamed = dim.select(*[F.col(d).alias(f"__{r}") for r, d in keys.items()], F.col(value).alias("__value"))
    condition = [rows[r] == renamed[f"__{r}"] for r in keys]
    joined = rows.join(renamed, condition, "left")
    return joined.withColumn(name, F.coalesce("__value", default)).drop("__value", *[f"__{r}" for r in keys])


def title(rows: DataFrame, titles: DataFrame, abbr: str, description: str, name: str) -> DataFrame:
    """rows with title: by abbreviation, else the description unless it is empty, else the name."""
    return with_default(rows, titles, {abbr: "abbr"}, "title", F.coalesce(F.nullif(F.col(description), F.lit("")), F.col(name)), "title")


def language(rows: DataFrame, corrections: DataFrame, names: DataFrame, directions: DataFrame, code: str, own_direction: str) -> DataFrame:
    """rows with lang, language and direction. All three are looked up by the code as given; what isn't found is the
    code itself, empty, and the row's own direction in upper case."""
    found = with_default(rows, corrections, {code: "code"}, "value", F.col(code), "lang")
    found = with_default(found, names, {code: "code"}, "value", F.lit(""), "language")
    return with_default(found, directions, {code: "code"}, "value", F.upper(F.col(own_direction)), "direction")


def book_number(rows: DataFrame, numbers: DataFrame, name: str, testament: str, book: str) -> DataFrame:
    """rows with nr: by the source's name, else by place: as given in the first part, 39 after it in the second;
    null, a violation, for others."""
    by_place = F.when(F.col(testament) == 1, F.col(book)).when(F.col(testament) == 2, F.col(book) + 39)
    return with_default(rows, numbers, {name: "source_name"}, "nr", by_place, "nr")


def merged_config(config: Column, key: str, default: Column) -> Column:
    """A map's value, which counts even if it is empty, else the default."""
    return F.coalesce(F.try_element_at(config, F.lit(key)), default)


def unapproved(requested: DataFrame, approved: DataFrame, key: str) -> DataFrame:
    """Requested keys that aren't approved, in order."""
    return requested.select(key).distinct().join(approved.select(key).distinct(), key, "left_anti").orderBy(key)


def approved_only(requested: DataFrame, approved: DataFrame, key: str) -> DataFrame:
    """Requested rows that are approved; their order column goes with them."""
    return requested.join(approved.select(key).distinct(), key, "left_semi")


def conflicts(rows: DataFrame, key: str, content: Column) -> DataFrame:
    """(key, n_rows, n_contents): keys under which contents differ."""
    counted = rows.withColumn("__hash", F.sha1(content)).groupBy(key).agg(F.count("*").alias("n_rows"), F.countDistinct("__hash").alias("n_contents"))
    return counted.where("n_contents > 1")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """(key, n): keys that occur more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def key_differences(keys: Column, required: list[str], allowed: list[str] | None = None) -> Column:
    """(missing, extra): required keys that an array lacks, and keys beyond the allowed ones (required by default)."""
    need, may = (F.array(*[F.lit(k) for k in x]) for x in (required, allowed or required))
    return F.struct(F.array_sort(F.array_except(need, keys)).alias("missing"), F.array_sort(F.array_except(keys, may)).alias("extra"))


def first_valid(candidates: DataFrame, key: str, rank: str, valid: Column) -> DataFrame:
    """The valid row of least rank for each key: a source, or what it falls back to."""
    return candidates.where(valid).groupBy(key).agg(F.min_by(F.struct(*candidates.columns), rank).alias("x")).select("x.*")
