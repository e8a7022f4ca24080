"""Releases of tools that a build needs: their policy, metadata, checksums and archives. What is wrong is a row."""

from __future__ import annotations

import hashlib
import io
import lzma
import tarfile
import zlib
from collections.abc import Iterable, Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import strip

# How versions, repositories and lines of checksums are written, and the members of a policy.
VERSION = r"^v?([0-9]+\.[0-9]+\.[0-9]+(?:[-+][0-9A-Za-z.-]+)?)$"
REPOSITORY = r"^[0-9A-Za-z_.-]+/[0-9A-Za-z_.-]+$"
CHECKSUM = r"^([0-9a-f]{64})\s+\*?([^\s]+)$"
POLICY = ["repository", "schema", "version"]
MEMBERS = "archive string, path string, kind string, size long, sha256 string, rule string"


def version(c: Column) -> Column:
    """A version without the v before it, null for what is none."""
    return F.nullif(F.regexp_extract(c, VERSION, 1), F.lit(""))


def _text(v: Column, path: str) -> Column:
    """A member of a variant that is a text, null for others."""
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))


def policies(rows: DataFrame, schema: str) -> DataFrame:
    """(source, repository, version, rules) of policies (source, body as JSON): the version is 'latest' or one without its
    v; rules are those broken: JSON, members, schema, repository, version."""
    v = F.col("v")
    read = rows.select("source", F.try_parse_json("body").alias("v"))
    asked = F.when(_text(v, "$.version") == "latest", "latest").otherwise(version(_text(v, "$.version")))
    keys = F.array_sort(F.json_object_keys(F.to_json(v)))
    rules = {
        "JSON": keys.isNull(), "members": keys != F.array(*[F.lit(m) for m in POLICY]), "schema": ~_text(v, "$.schema").eqNullSafe(F.lit(schema)),
        "repository": ~F.coalesce(_text(v, "$.repository").rlike(REPOSITORY), F.lit(False)), "version": asked.isNull(),
    }
    return read.select("source", _text(v, "$.repository").alias("repository"), asked.alias("version"), F.array_compact(F.array(*[F.when(when, F.lit(rule)) for rule, when in rules.items()])).alias("rules"))


def resolved(rows: DataFrame) -> DataFrame:
    """(source, id, version, rules) of releases (source, body as JSON, requested: 'latest' or a version): rules broken are
    JSON, tag (no version), version (another one than requested), unfinished (a draft or not final), id."""
    v, true = F.col("v"), lambda path: F.coalesce(F.try_variant_get(v, path, "boolean"), F.lit(False))
    read = rows.select("source", "requested", F.try_parse_json("body").alias("v"))
    found = version(_text(v, "$.tag_name"))
    number = F.when(F.schema_of_variant(F.try_variant_get(v, "$.id", "variant")) == "BIGINT", F.try_variant_get(v, "$.id", "bigint"))
    rules = {"JSON": v.isNull(), "tag": found.isNull(), "version": (F.col("requested") != "latest") & (found != F.col("requested")), "unfinished": true("$.draft") | true("$.prerelease"), "id": number.isNull()}
    return read.select("source", number.alias("id"), found.alias("version"), F.array_compact(F.array(*[F.when(when, F.lit(rule)) for rule, when in rules.items()])).alias("rules"))


def verified(assets: DataFrame, checksums: DataFrame) -> DataFrame:
    """(release, name, sha256, rule) of assets (release, name, content, digest: null or 'sha256:...'), checked against the
    checksums (release, name, content) of their name with .sha256 behind it. rule is the first that is broken: missing,
    format (not one ASCII line of a hash and a name), name, sha256, digest; null if none is."""
    text = F.col("line").cast("string")
    line = strip(text)
    said = checksums.select("release", F.regexp_replace("name", r"\.sha256$", "").alias("name"), F.col("content").alias("line"), F.endswith("name", F.lit(".sha256")).alias("is")).where("is").drop("is")
    both = assets.select("release", "name", F.sha2("content", 256).alias("sha256"), "digest").join(said, ["release", "name"], "left")
    rule = (
        F.when(F.col("line").isNull(), "missing").when(~F.coalesce(F.is_valid_utf8(text) & text.rlike(r"^[\x00-\x7f]*$") & line.rlike(CHECKSUM), F.lit(False)), "format")
        .when(F.regexp_extract(line, CHECKSUM, 2) != F.col("name"), "name").when(F.regexp_extract(line, CHECKSUM, 1) != F.col("sha256"), "sha256")
        .when(F.col("digest") != F.concat(F.lit("sha256:"), "sha256"), "digest")
    )
    return both.select("release", "name", "sha256", rule.alias("rule"))


def tar_members(archives: DataFrame, tail: str) -> DataFrame:
    """(archive, path, kind, size, sha256, rule) of what compressed tar archives (archive, content) have, read one after
    the other. Only files whose path ends in the parts of tail are hashed. rule: 'path' for members that lead out, 'kind'
    for what ends in tail but is no file, 'unreadable' for an archive that can't be read (its path is null)."""
    parts = PurePosixPath(tail).parts

    def facts(archive: str, data: bytes) -> Iterator[tuple]:
        try:
            with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as opened:
                for m in opened:
                    path = PurePosixPath(m.name)
                    wanted, digest = path.parts[-len(parts) :] == parts, None
                    kind = "file" if m.isfile() else "folder" if m.isdir() else "link" if m.islnk() or m.issym() else "other"
                    rule = "path" if path.is_absolute() or ".." in path.parts else "kind" if wanted and kind != "file" else None
                    if wanted and not rule:
                        digest, source = hashlib.sha256(), opened.extractfile(m)
                        while piece := source.read(1 << 20):
                            digest.update(piece)
                    yield archive, m.name, kind, m.size, digest and digest.hexdigest(), rule
                while opened.fileobj.read(1 << 20):  # to the end, where what is cut off shows
                    pass
        except (tarfile.TarError, EOFError, OSError, zlib.error, lzma.LZMAError):
            yield archive, None, None, None, None, "unreadable"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 2
        names = [c.split()[0] for c in MEMBERS.split(", ")]
        for batch in batches:
            for archive, data in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                columns = list(zip(*facts(archive, data.as_py() or b""), strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return archives.select("archive", "content").mapInArrow(run, MEMBERS)


def executables(archives: DataFrame, members: DataFrame) -> DataFrame:
    """(archive, path, sha256, rule) of the one file that each of archives (archive) has of tar_members' tail; rule is the
    least of its members' rules, or 'none' or 'several', and null where all is well."""
    found = F.col("sha256").isNotNull() & F.col("rule").isNull()
    each = members.groupBy("archive").agg(F.min("rule").alias("broken"), F.count_if(found).alias("n"), F.min(F.when(found, F.struct("path", "sha256"))).alias("one"))
    rows = archives.select("archive").distinct().join(each, "archive", "left")
    rule = F.coalesce("broken", F.when(F.coalesce("n", F.lit(0)) == 0, "none").when(F.col("n") > 1, "several"))
    well = rule.isNull()
    return rows.select("archive", F.when(well, F.col("one.path")).alias("path"), F.when(well, F.col("one.sha256")).alias("sha256"), rule.alias("rule"))
