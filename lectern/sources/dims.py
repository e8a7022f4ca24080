"""Dimensions and settings from small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.text import strip


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, key, value) of JSON objects, a file each: their members, in the order they have there."""
    return json_entries(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value"))


def json_entries(files: DataFrame) -> DataFrame:
    """json_map's rows of files (file, value)."""
    text = files.select("file", F.from_json("value", "map<string,string>").alias("m"))
    return text.select("file", F.posexplode(F.map_entries("m")).alias("ordinal", "e")).select("file", "ordinal", "e.key", "e.value")


def overrides(spark: SparkSession, folder: str, prefix: str = "books_") -> DataFrame:
    """(abbr, nr, name) of files named by prefix and abbreviation, each a JSON object from number to name."""
    return override_rows(json_map(spark, f"{folder.rstrip('/')}/{prefix}*.json"), prefix)


def override_rows(rows: DataFrame, prefix: str = "books_") -> DataFrame:
    """overrides' rows of json_entries."""
    abbr = F.regexp_extract("file", rf"^{prefix}(.*)\.json$", 1)
    return rows.select(abbr.alias("abbr"), F.col("key").try_cast("int").alias("nr"), F.col("value").alias("name")).where("nr IS NOT NULL")


def settings(spark: SparkSession, path: str) -> DataFrame:
    """(key, value, flag) of a file of key=value lines: the first '=' parts them, '#' begins a comment line, both sides
    are stripped, the last of a key's lines wins, and a blank value counts as none. flag: the value is '1'."""
    return setting_rows(spark.read.text(path, wholetext=True).select(F.lit("").alias("file"), "value")).drop("file")


def setting_rows(files: DataFrame) -> DataFrame:
    """settings' rows of files (file, value), with file."""
    whole = files.select("file", F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    lines = whole.where("line NOT RLIKE '^\\\\s*#' AND line LIKE '%=%'")
    parts = lines.select("file", "n", strip(F.split("line", "=", 2)[0]).alias("key"), strip(F.split("line", "=", 2)[1]).alias("value"))
    last = parts.where("value <> ''").groupBy("file", "key").agg(F.max_by("value", "n").alias("value"))
    return last.withColumn("flag", F.col("value") == "1")


def policy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(approved (ordinal, module), violations (rule)) of an allow-list: version 1, denial by default, and names that
    are there, not blank, and not repeated."""
    approved, broken = policy_rows(spark.read.text(path, wholetext=True).select(F.lit("").alias("file"), "value"))
    return approved.drop("file"), broken.drop("file")


def policy_rows(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """policy's rows of files (file, value), with file."""
    kind = "schema_version bigint, `default` string, approved_modules array<string>"
    rows = files.select("file", F.from_json("value", kind).alias("p")).select("file", "p.*")
    names = F.col("approved_modules")
    rules = F.array(
        F.when(~F.col("schema_version").eqNullSafe(1), "version"), F.when(~F.col("default").eqNullSafe("deny"), "default"), F.when(F.coalesce(F.size(names), F.lit(0)) < 1, "no modules"),
        F.when(F.exists(names, lambda n: n.isNull() | (F.length(strip(n)) == 0)), "blank module"), F.when(F.size(F.array_distinct(names)) != F.size(names), "repeated module"),
    )
    return rows.select("file", F.posexplode("approved_modules").alias("ordinal", "module")), rows.select("file", F.explode(F.array_compact(rules)).alias("rule"))


def ordered(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, module, abbr) of a module map in the order it is written: the order of processing."""
    return ordered_rows(json_map(spark, path))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """ordered's rows of json_entries."""
    return rows.select((F.row_number().over(Window.partitionBy("file").orderBy("ordinal")) - 1).alias("ordinal"), F.col("key").alias("module"), F.col("value").alias("abbr"))
