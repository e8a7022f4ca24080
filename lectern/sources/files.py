"""Files as rows: documents of a tree, and archives. trees lists and writes."""

from __future__ import annotations

import hashlib
import io
import stat
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import is_safe_path


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size) of files below root that match a pattern, relative to it. trees.entries tells of folders, links and
    hidden names too."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    base = root.split(":", 1)[-1].rstrip("/") + "/"
    return files.select(F.substring_index("path", base, -1).alias("path"), F.col("length").alias("size"))


def documents(spark: SparkSession, root: str, reserved: list[str] = ()) -> DataFrame:
    """(path, name, body) of JSON files below root, without reserved names, for orderBy(path)."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    rows = files.select(F.col("_metadata.file_path").alias("path"), name.alias("name"), F.col("value").alias("body"))
    return rows.where(~F.col("name").isin(list(reserved))) if reserved else rows


#: The most members and expanded bytes of an archive, and what a merged tree must have one of.
MOST_MEMBERS, MOST_BYTES = 100_000, 4 * 1024**3
CONFIGURATION = ["mods.d", "mods.conf"]
MEMBERS = "archive string, path string, kind string, size long, sha256 string, content binary, rule string"
#: Bytes read from a member at once, and held of a task's members.
PIECE, HELD = 1 << 20, 16 << 20


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, content) of ZIP files, by whatever Spark can open. An archive is one value, so it has 2 GiB at most; what
    it expands to hasn't."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content")


def members(zips: DataFrame, most_members: int = MOST_MEMBERS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(archive, path, kind, size, sha256, content, rule) of the members of zips (archive, content): files, folders and
    links, in tasks that hold an archive and some megabytes of its members. Paths are without empty and '.' parts.

    What can't be merged has a rule: 'path' (absolute, with '..', backslashes or NUL, or nothing), 'link', and 'unreadable'
    for members and archives that can't be expanded. An archive with too many members, or that says it expands to too
    much, is one row with the rule 'members' or 'size', and isn't expanded. Links and refused members have no content."""

    def facts(archive: str, data: bytes) -> Iterator[tuple]:
        none = (None,) * 5
        try:
            opened = zipfile.ZipFile(io.BytesIO(data))
        except (zipfile.BadZipFile, ValueError):
            yield (archive, *none, "unreadable")
            return
        with opened:
            every = opened.infolist()
            if len(every) > most_members or sum(m.file_size for m in every) > most_bytes:
                yield (archive, *none, "members" if len(every) > most_members else "size")
                return
            for m in every:
                clean = PurePosixPath(m.orig_filename)
                kind = "link" if stat.S_ISLNK(m.external_attr >> 16) else "folder" if m.is_dir() else "file"
                bad = "\x00" in m.orig_filename or "\\" in m.orig_filename or clean.is_absolute() or not clean.parts or ".." in clean.parts
                path, rule = (m.orig_filename, "path") if bad else (str(clean), "link" if kind == "link" else None)
                if rule or kind == "folder":
                    yield archive, path, kind, 0, None, None, rule
                    continue
                digest, pieces = hashlib.sha256(), []
                try:
                    with opened.open(m) as source:
                        while piece := source.read(PIECE):
                            digest.update(piece)
                            pieces.append(piece)
                except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError):
                    yield archive, path, kind, m.file_size, None, None, "unreadable"
                    continue
                yield archive, path, kind, m.file_size, digest.hexdigest(), b"".join(pieces), None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        names = [c.split()[0] for c in MEMBERS.split(", ")]
        rows: list[tuple] = []
        size = 0

        def told() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for archive, data in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                for row in facts(archive, data.as_py() or b""):
                    rows.append(row)
                    size += len(row[5] or b"") + 256
                    if size > HELD:
                        yield told()
                        rows, size = [], 0
        if rows:
            yield told()

    return zips.select("archive", "content").mapInArrow(run, MEMBERS)


def refusals(found: DataFrame, needed: list[str] = CONFIGURATION) -> DataFrame:
    """(archive, path, rule) that keep members() from being merged into one tree: their own rules, files of one path with
    different bytes (rule 'conflict', a row for each archive that has one), and a tree without any of needed, as a
    file or a folder (rule 'configuration', once)."""
    files = found.where("kind = 'file' AND rule IS NULL")
    clash = files.groupBy("path").agg(F.countDistinct("sha256").alias("n")).where("n > 1").select("path")
    told = files.join(clash, "path", "left_semi").select("archive", "path", F.lit("conflict").alias("rule")).distinct()
    top = F.substring_index("path", "/", 1)
    has = found.agg(F.coalesce(F.bool_or(top.isin(needed) & F.col("rule").isNull()), F.lit(False)).alias("has")).where("NOT has")
    return found.where("rule IS NOT NULL").select("archive", "path", "rule").unionByName(told).unionByName(has.select(F.lit(None).cast("string").alias("archive"), F.lit(None).cast("string").alias("path"), F.lit("configuration").alias("rule")))


def merged(found: DataFrame) -> DataFrame:
    """(path, archive, size, sha256, content) of the files of one tree: of equal paths the first archive's by name, the
    others being the same where there are no refusals()."""
    files = found.where("kind = 'file' AND rule IS NULL")
    first = files.groupBy("path").agg(F.min("archive").alias("archive"))
    return files.join(first, ["path", "archive"], "left_semi").dropDuplicates(["path"]).select("path", "archive", "size", "sha256", "content")


def archive_conflicts(members: DataFrame, most_members: int = 100_000, most_bytes: int = 4 * 1024**3) -> DataFrame:
    """(archive, path, rule) of archive members (archive, path, size, sha256, is_link) that can't be merged into one
    tree: unsafe paths, links, one path with different contents, too many members, too large."""
    pick = lambda rows, rule: rows.select("archive", "path", F.lit(rule).alias("rule"))
    clash = members.groupBy("path").agg(F.countDistinct("sha256").alias("n"), F.min("archive").alias("archive")).where("n > 1")
    totals = members.groupBy("archive").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).withColumn("path", F.lit(None).cast("string"))
    return (
        pick(members.where(~is_safe_path(F.col("path"))), "path")
        .unionByName(pick(members.where("is_link"), "link"))
        .unionByName(pick(clash, "conflict"))
        .unionByName(pick(totals.where(F.col("n") > most_members), "members"))
        .unionByName(pick(totals.where(F.col("bytes") > most_bytes), "size"))
    )
