"""Checks and folds over ordered rows. Violations are rows; nothing raises."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.lookups import small
from lectern.session import settled

#: Bytes of results that a task of streamed() holds before it hands them on.
HELD = 16 << 20


def numbering_gaps(rows: DataFrame, group: list[str], order: list[str], number: str, first: int = 0) -> DataFrame:
    """(group..., checked, violations): rows of a group, and those whose number isn't first, first + 1, ... in order."""
    window = Window.partitionBy(*group).orderBy(*order)
    expected = F.row_number().over(window) - 1 + first
    wrong = F.coalesce(F.col(number) != F.col("__n"), F.lit(True))
    numbered = rows.withColumn("__n", expected)
    return numbered.groupBy(*group).agg(F.count("*").alias("checked"), F.count_if(wrong).alias("violations"))


def stage_regressions(rows: DataFrame, group: list[str], order: list[str], stage: Column) -> DataFrame:
    """(group..., checked, violations): staged rows of a group, and those below a stage reached before. Rows without
    a stage float."""
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    staged = rows.withColumn("__stage", stage)
    ahead = staged.withColumn("__most", F.max("__stage").over(window)).where("__stage IS NOT NULL")
    return ahead.groupBy(*group).agg(F.count("*").alias("checked"), F.count_if(F.col("__stage") < F.col("__most")).alias("violations"))


def overlapping_groups(rows: DataFrame, group: list[str], order: list[str], opens: Column, closes: Column) -> DataFrame:
    """(group..., violations): rows after which the number of open brackets isn't 0 or 1."""
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    depth = F.sum(F.coalesce(opens, F.lit(False)).cast("int") - F.coalesce(closes, F.lit(False)).cast("int")).over(window)
    return rows.withColumn("__depth", depth).groupBy(*group).agg(F.count_if(~F.col("__depth").isin(0, 1)).alias("violations"))


def merge_runs(rows: DataFrame, group: list[str], order: str, same: list[str], text: str, sep: str = "") -> DataFrame:
    """(group..., same..., first, last, text): neighbours that agree in same as one row, their texts joined in order."""
    window = Window.partitionBy(*group).orderBy(order)
    new = F.lit(False)
    for c in same:
        new = new | ~F.col(c).eqNullSafe(F.lag(c).over(window))
    new = new | (F.row_number().over(window) == 1)
    run = rows.withColumn("__new", new).withColumn("__run", F.sum(F.col("__new").cast("int")).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"])
    return run.groupBy(*group, *same, "__run").agg(F.min(order).cast("long").alias("first"), F.max(order).cast("long").alias("last"), F.array_join(parts, sep).alias("text")).drop("__run")


def range_gaps(ranges: DataFrame, group: list[str], start: str, end: str) -> DataFrame:
    """(group..., start, end, rule): ranges that begin after or before the place behind the last one, or end too soon."""
    window = Window.partitionBy(*group).orderBy(start, end)
    behind = F.coalesce(F.lag(end).over(window), F.lit(0)) + 1
    rule = F.when(F.col(start) > F.col("__behind"), "gap").when(F.col(start) < F.col("__behind"), "overlap").when(F.col(end) < F.col(start), "reversed")
    return ranges.withColumn("__behind", behind).withColumn("rule", rule).where("rule IS NOT NULL").drop("__behind")


def scanned(rows: DataFrame, group: list[str], order: str, block: Column, sums: dict[str, Column], most: dict[str, Column] | None = None, last: dict[str, Column] | None = None) -> DataFrame:
    """rows with running values of each group in order, by blocks of neighbours that many tasks work on: for each of sums
    the sum over the rows before, for each of most the greatest value before, for each of last the last value that
    isn't null up to the row itself.

    Each block is summed up alone, the summaries are run over (a row a block), and what came before a block is added to
    what its own rows run to. order must be unique in a group, and a block's rows must be neighbours."""
    most, last, own = most or {}, last or {}, [*group, "__block"]
    facts = {**{f"__s_{k}": v for k, v in sums.items()}, **{f"__m_{k}": v for k, v in most.items()}, **{f"__l_{k}": v for k, v in last.items()}}
    rows = rows.select("*", block.alias("__block"), *[v.alias(k) for k, v in facts.items()])
    ends = rows.groupBy(*own).agg(
        *[F.sum(f"__s_{k}").alias(f"__s_{k}") for k in sums], *[F.max(f"__m_{k}").alias(f"__m_{k}") for k in most],
        *[F.max_by(f"__l_{k}", F.when(F.col(f"__l_{k}").isNotNull(), F.col(order))).alias(f"__l_{k}") for k in last],
    )
    over = Window.partitionBy(*group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *own, *[F.coalesce(F.sum(f"__s_{k}").over(over), F.lit(0)).alias(f"__bs_{k}") for k in sums], *[F.max(f"__m_{k}").over(over).alias(f"__bm_{k}") for k in most],
        *[F.last(f"__l_{k}", True).over(over).alias(f"__bl_{k}") for k in last],
    )
    same = [F.col(c).eqNullSafe(F.col(f"__on{i}")) for i, c in enumerate(own)]
    right = small(settled(carried.select(*[F.col(c).alias(f"__on{i}") for i, c in enumerate(own)], *carried.columns[len(own) :])))
    joined = rows.join(right, same).drop(*[f"__on{i}" for i in range(len(own))])
    window = Window.partitionBy(*own).orderBy(order)
    before, through = window.rowsBetween(Window.unboundedPreceding, -1), window.rowsBetween(Window.unboundedPreceding, 0)
    found = joined.select(
        *[c for c in rows.columns if not c.startswith("__")], *[(F.col(f"__bs_{k}") + F.coalesce(F.sum(f"__s_{k}").over(before), F.lit(0))).alias(k) for k in sums],
        *[F.greatest(f"__bm_{k}", F.max(f"__m_{k}").over(before)).alias(k) for k in most], *[F.coalesce(F.last(f"__l_{k}", True).over(through), f"__bl_{k}").alias(k) for k in last],
    )
    return found


def streamed(rows: DataFrame, group: list[str], order: list[str], value: Column, start: Callable, add: Callable, end: Callable, kind: str) -> DataFrame:
    """(group..., the columns of kind): a state for each group, started by start(), that add(state, bytes) takes through the
    group's values in order, and end(state) makes the result of. A group's rows go by one task, as its state is one
    sequence, but batch by batch: neither the rows nor the values are held. Null values are passed over; a group of
    nothing else has the result of a fresh state."""
    columns = [c.split()[0] for c in kind.split(", ")]
    schema = ", ".join([*(f"`{g}` {rows.schema[g].dataType.simpleString()}" for g in group), kind])
    dealt = rows.select(*group, *order, value.cast("binary").alias("__value")).repartition(*group).sortWithinPartitions(*group, *order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        key, state, held, kinds, told, size = None, None, False, [], [], 0

        def result() -> None:
            nonlocal size
            told.append((*key, *end(state)))
            size += sum(len(x) for x in told[-1] if isinstance(x, bytes | str))

        def out() -> pa.RecordBatch:
            nonlocal size
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*told, strict=True), kinds, strict=True)], names=[*group, *columns])
            told.clear()
            size = 0
            return made

        for batch in batches:
            kinds = [*(batch.schema.field(g).type for g in group), *(fixed[c.split()[1]] for c in kind.split(", "))]
            keys = zip(*[batch.column(g).to_pylist() for g in group], strict=True)
            for own, x in zip(keys, batch.column("__value"), strict=True):
                if not held or own != key:
                    if held:
                        result()
                    key, state, held = own, start(), True
                    if len(told) >= 1024 or size > HELD:
                        yield out()
                if (data := x.as_py()) is not None:
                    add(state, data)
        if held:
            result()
            yield out()

    return dealt.select(*group, "__value").mapInArrow(run, schema)


def ordered_digest(rows: DataFrame, group: list[str], order: list[str], line: Column, end: str = "\n") -> DataFrame:
    """(group..., n_lines, sha256): SHA-256 over each group's lines in order, each with its end. A line after the other
    goes into the hash, as the digest is one sequence by definition; groups are the unit of parallel work. A null line is
    an empty one."""
    tail = end.encode()
    add = lambda h, x: (h[0].update(x), h[0].update(tail), h.__setitem__(1, h[1] + 1))
    return streamed(rows, group, order, F.coalesce(line.cast("binary"), F.lit(b"")), lambda: [hashlib.sha256(), 0], add, lambda h: (h[1], h[0].hexdigest()), "n_lines long, sha256 string")


def touched_words(words: DataFrame, ranges: DataFrame, group: list[str], name: str, block: int = 256) -> DataFrame:
    """(group..., name, word_start, word_end) of ranges (group..., name, start, end): the least and greatest number of the
    words (group..., number, start, end) that each touches (ends exclusive); 0, 0 for none. Both are dealt out by
    blocks of places, so that a range meets the words near it alone."""
    blocks = F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.greatest("start", F.col("end") - 1)) / block)))
    near = words.select(*group, "number", F.col("start").alias("__a"), F.col("end").alias("__b"), blocks.alias("__block"))
    met = ranges.select("*", blocks.alias("__block")).join(near, [*group, "__block"]).where((F.col("__b") > F.col("start")) & (F.col("__a") < F.col("end")))
    found = met.groupBy(*group, name).agg(F.min("number").alias("lo"), F.max("number").alias("hi"))
    joined = ranges.select(*group, name).join(found, [*group, name], "left")
    return joined.select(*group, name, F.coalesce("lo", F.lit(0)).alias("word_start"), F.coalesce("hi", F.lit(0)).alias("word_end"))


def overlapping_words(words: Column, start: Column, end: Column) -> Column:
    """(word_start, word_end): the least and greatest number of words (start, end, number) that a range of places
    (end exclusive) touches; 0, 0 for none."""
    hit = F.transform(F.filter(words, lambda w: (w["end"] > start) & (w["start"] < end)), lambda w: w["number"])
    return F.struct(F.coalesce(F.array_min(hit), F.lit(0)).alias("word_start"), F.coalesce(F.array_max(hit), F.lit(0)).alias("word_end"))
