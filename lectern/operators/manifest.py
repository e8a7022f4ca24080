"""Content-addressed manifests of documents at several levels."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import is_public_name
from lectern.operators.sequences import streamed


def hashed(docs: DataFrame, body: Column, url: Column) -> DataFrame:
    """docs with url and the SHA-1 of the final bytes of each."""
    return docs.withColumn("url", url).withColumn("sha", F.sha1(body.cast("binary")))


def digests(parts: DataFrame, group: list[str], turn: str, body: str) -> DataFrame:
    """(group..., sha): hashed()'s digest of bodies that are pieces, in order of turn; a piece after the other goes into it,
    and then the line feed behind the last."""

    def end(h: object) -> tuple[str]:
        h.update(b"\n")
        return (h.hexdigest(),)

    return streamed(parts, group, [turn], F.col(body), hashlib.sha1, lambda h, x: h.update(x), end, "sha string")


def details(docs: DataFrame, dropped: list[str]) -> DataFrame:
    """docs without their bulky columns: what a detail map tells of each."""
    return docs.select(*[c for c in docs.columns if c not in dropped])


def detail_map(docs: DataFrame, group: list[str], key: str, dropped: list[str]) -> DataFrame:
    """(group..., body): a JSON map from key to each row's details, in key order; null fields are left out."""
    kept = [c for c in docs.columns if c not in [*dropped, *group]]
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.struct(*kept).alias("v"))))
    return docs.groupBy(*group).agg(F.to_json(F.map_from_entries(entries)).alias("body"))


def listing(docs: DataFrame, group: list[str], columns: list[Column], order: list[str], header: str) -> DataFrame:
    """(group..., body): a TSV with a header line and a line a row, in order."""
    line = F.concat_ws("\t", *columns)
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("__line")))), lambda x: x["__line"])
    return docs.groupBy(*group).agg(F.concat(F.lit(header + "\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("body"))


def checksum_map(docs: DataFrame, group: list[str], key: str, sha: str = "sha") -> DataFrame:
    """(group..., body): a JSON map from key to hash, in key order."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.col(sha).alias("v"))))
    return docs.groupBy(*group).agg(F.to_json(F.map_from_entries(entries)).alias("body"))


def sheets(docs: DataFrame, name: str, header: list[str], columns: list[str]) -> DataFrame:
    """(path, turn, body) of the four files that tell what a folder has, in pieces, of docs (folder, order, key, sha, url,
    head, columns): name (a TSV of columns), checksum (a TSV), checksum.json (hashes by key), name.json (head with url and
    hash, by key). All are in order, and a row is a line; the last line has no end. A piece is what a file says of one of
    docs, so a folder of any size is never one value."""
    quoted = F.to_json(F.array("key"))
    member = lambda value: F.concat(F.substring(quoted, 2, F.length(quoted) - 2), F.lit(":"), value)
    more = F.concat(F.substring("head", 1, F.length("head") - 1), F.lit(","), F.substring(F.to_json(F.struct("url", "sha")), 2, 1 << 30))
    lines = {name: F.concat_ws("\t", *columns), "checksum": F.concat_ws("\t", columns[0], "key", "sha"), "checksum.json": member(F.concat(F.lit('"'), "sha", F.lit('"'))), f"{name}.json": member(more)}
    rows = docs.select("folder", "order", *[v.alias(f"line{i}") for i, v in enumerate(lines.values())])
    window = Window.partitionBy("folder").orderBy(*rows.columns[1:])
    rows = rows.withColumns({"turn": F.row_number().over(window).cast("bigint"), "last": ~F.lead(F.lit(True), 1, False).over(window)})
    first = F.col("turn") == 1
    sheet = lambda i, top: F.concat(F.when(first, "\t".join(top)).otherwise(""), F.lit("\n"), F.coalesce(f"line{i}", F.lit("")))
    whole = lambda i: F.concat(F.when(first, "{").otherwise(","), F.coalesce(f"line{i}", F.lit("")), F.when(F.col("last"), "}").otherwise(""))
    bodies = [sheet(0, header), sheet(1, ["#", "filename", "sha"]), whole(2), whole(3)]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), b.alias("body")) for n, b in zip(lines, bodies, strict=True)]))
    return rows.select("folder", "turn", each.alias("x")).select(F.when(F.col("folder") == "", F.col("x.name")).otherwise(F.concat_ws("/", "folder", "x.name")).alias("path"), "turn", "x.body")


def rollup_hash(docs: DataFrame, group: list[str], key: str, sha: str = "sha") -> DataFrame:
    """(group..., n, sha): a hash over the children's keys and hashes, by key; children are serialized already. A group's
    children are taken one after the other, however many there are."""

    def add(state: list, pair: bytes) -> None:
        state[0].update(b"," + pair if state[1] else pair)
        state[1] += 1

    pair = F.concat_ws(":", F.col(key).cast("string"), F.col(sha))
    return streamed(docs, group, [key, sha] if key != sha else [key], pair, lambda: [hashlib.sha1(), 0], add, lambda s: (s[1], s[0].hexdigest()), "n long, sha string")


def numbered(docs: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """docs with n = 1, 2, ... in order of name within group."""
    return docs.withColumn("n", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def integer_name(c: Column) -> Column:
    """The number that a name is, 0 for others: the order of numbered files."""
    return F.coalesce(F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint")), F.lit(0))


def public(files: DataFrame, name: str) -> DataFrame:
    """Manifest files that a mirror keeps."""
    return files.where(is_public_name(F.col(name)))
