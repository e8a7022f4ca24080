"""Where words and tokens stand in a text. One pass over each text in Arrow batches, as long texts have too many words
for folds that copy what they have so far."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = "array<struct<word:string,number:int,start:int,end:int>>"
PLACES = "array<struct<token:string,start:int,end:int>>"
#: Rows of a result that are Python objects at once.
HELD = 65_536


class Lists:
    """An Arrow array of lists of structs, built from columns of plain lists."""

    def __init__(self, fields: list[tuple[str, pa.DataType]]) -> None:
        self.fields, self.columns = fields, [[] for _ in fields]
        self.ends, self.missing, self.n = [0], [], 0
        self.parts: list[pa.StructArray] = []

    def add(self, rows: list[list] | None) -> None:
        """One more list, as columns; None for null."""
        self.missing.append(rows is None)
        for own, new in zip(self.columns, rows or [], strict=False):
            own += new
        self.n += len(rows[0]) if rows else 0
        self.ends.append(self.n)
        if len(self.columns[0]) > HELD:
            self._settle()

    def _settle(self) -> None:
        arrays = [pa.array(c, kind) for c, (_, kind) in zip(self.columns, self.fields, strict=True)]
        self.parts.append(pa.StructArray.from_arrays(arrays, names=[name for name, _ in self.fields]))
        self.columns = [[] for _ in self.fields]

    def done(self) -> pa.ListArray:
        self._settle()
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.concat_arrays(self.parts), mask=pa.array(self.missing, pa.bool_()))


def _listed(fields: list[tuple[str, pa.DataType]], rows: Callable, *columns: pa.Array) -> pa.ListArray:
    """rows' lists of each row of columns; null where a column is."""
    out = Lists(fields)
    for values in zip(*columns, strict=True):
        plain = [x.as_py() for x in values]
        out.add(None if None in plain else rows(*plain))
    return out.done()


def bounds(text: str) -> list[tuple[int, int]]:
    """(start, end) of a text's words in code points, ends exclusive."""
    return [m.span() for m in re.finditer(r"\S+", text)]


def _words(text: str) -> list[list]:
    found = bounds(text)
    return [[text[a:b] for a, b in found], list(range(1, len(found) + 1)), [a for a, _ in found], [b for _, b in found]]


def following(text: str, tokens: Iterable[str | None]) -> Iterator[tuple[int, int]]:
    """(start, end) of each token at its first occurrence behind the last one that was found; (-1, -1) where there is
    none, for empty tokens and null."""
    behind = 0
    for token in tokens:
        at = text.find(token, behind) if token else -1
        if at < 0:
            yield -1, -1
            continue
        behind = at + len(token)
        yield at, behind


def _aligned(tokens: list[str | None], text: str) -> list[list]:
    found = list(following(text, tokens))
    return [tokens, [a + 1 for a, _ in found], [max(b, 0) for _, b in found]]


def words(c: Column) -> Column:
    """array of (word, number from 1, start, end): words with their places in code points, end exclusive. Null for
    null."""
    fields = [("word", pa.string()), ("number", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    return F.arrow_udf(lambda texts: _listed(fields, _words, texts), WORDS)(c.cast("string"))


def aligned(tokens: Column, text: Column) -> Column:
    """array of (token, start, end), 1-based and inclusive: each token at its first occurrence after the last one
    that was found; (0, 0) where there is none, and the place stays. Null for a null text or null tokens."""
    fields = [("token", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
    return F.arrow_udf(lambda found, texts: _listed(fields, _aligned, found, texts), PLACES)(tokens.cast("array<string>"), text.cast("string"))


def _told(rows: DataFrame, keep: tuple[str, ...], columns: list[str], fields: list[tuple[str, pa.DataType, str]], found: Callable) -> DataFrame:
    """(keep..., fields): a row for each that found(columns' values) gives, none for rows with a null in columns. HELD of them
    are held at a time, however long a text or a batch of texts is."""
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep), *(f"{name} {kind}" for name, _, kind in fields)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keep, *(name for name, _, _ in fields)]
        for batch in batches:
            of: list[int] = []
            facts: list[tuple] = []

            def out(batch: pa.RecordBatch = batch, of: list[int] = of, facts: list[tuple] = facts) -> pa.RecordBatch:
                own = [batch.column(c).take(pa.array(of, pa.int64())) for c in keep]
                made = pa.RecordBatch.from_arrays([*own, *(pa.array(x, kind) for x, (_, kind, _) in zip(zip(*facts, strict=True), fields, strict=True))], names=names)
                of.clear()
                facts.clear()
                return made

            for i in range(len(batch)):
                values = [batch.column(c)[i].as_py() for c in columns]
                if any(x is None for x in values):
                    continue
                for fact in found(*values):
                    of.append(i)
                    facts.append(fact)
                    if len(facts) >= HELD:
                        yield out()
            if facts:
                yield out()

    return rows.select(*dict.fromkeys([*keep, *columns])).mapInArrow(run, schema)


def word_rows(rows: DataFrame, text: str, *keep: str) -> DataFrame:
    """(keep..., word, number, start, end): words() of a column, a row a word."""
    fields = [("word", pa.string(), "string"), ("number", pa.int32(), "int"), ("start", pa.int32(), "int"), ("end", pa.int32(), "int")]
    return _told(rows, keep, [text], fields, lambda text: ((m[0], n, *m.span()) for n, m in enumerate(re.finditer(r"\S+", text), 1)))


def aligned_rows(rows: DataFrame, tokens: str, text: str, *keep: str) -> DataFrame:
    """(keep..., i, token, start, end): aligned() of two columns, a row a token, numbered from 0."""
    fields = [("i", pa.int32(), "int"), ("token", pa.string(), "string"), ("start", pa.int32(), "int"), ("end", pa.int32(), "int")]

    def found(tokens: list[str | None], text: str) -> Iterator[tuple]:
        for i, (token, (a, b)) in enumerate(zip(tokens, following(text, tokens), strict=True)):
            yield i, token, a + 1, max(b, 0)

    return _told(rows, keep, [tokens, text], fields, found)
