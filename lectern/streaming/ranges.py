"""Counts and covering ranges over unbounded logs: an extension, as the batch sources are bounded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.layout import covering_ranges


def windowed_counts(stream: DataFrame, time: str, size: str, late: str, *keys: str) -> DataFrame:
    """(start, end, keys..., n) of records by tumbling window; a window is final once records are later than late."""
    window = F.window(time, size)
    counted = stream.withWatermark(time, late).groupBy(window, *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def ranges_of_batches(group: list[str], position: str, start: Column, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes each micro-batch's covering ranges with the batch's id, so that a sink that
    replaces what it has of an id gets each batch once. Groups are taken to end within a batch."""

    def run(batch: DataFrame, number: int) -> None:
        write(covering_ranges(batch, group, position, start).withColumn("batch", F.lit(number)), number)

    return run
