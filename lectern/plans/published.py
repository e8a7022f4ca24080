"""Named queries over trees of files: written, read back, listed, compared, mirrored and cleared."""

from __future__ import annotations

import hashlib
import io
import re
import tarfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.functions.members import Members
from lectern.plans import checks, corpus
from lectern.plans.catalogue import query
from lectern.session import settled, shared_folder, table
from lectern.sources import files, releases, trees


#: A SHA-1 as sheets tell it.
HEX = re.compile(rb"[0-9a-f]{40}")


def _root(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tree-{uuid.uuid4().hex}"


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, body, source): a file for each source of a language, its documents' hashes line by line."""
    docs = table(spark, sf_dir, "documents")
    rows = F.array_sort(F.collect_list(F.struct("doc_id", F.sha1(F.col("text").cast("binary")).alias("sha"))))
    lines = F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["doc_id"].cast("string"), x["sha"])), "\n")
    return docs.groupBy("lang", "source").agg(lines.alias("body")).select(F.concat("lang", F.lit("/"), "source", F.lit(".txt")).alias("path"), "body", "source")


#: The same files in SQL.
BODIES = "b AS (SELECT lang || '/' || source || '.txt' AS path, source, lang, string_agg(doc_id || ':' || sha1(text), chr(10) ORDER BY doc_id) AS body FROM documents GROUP BY lang, source)"


@query(f"WITH {BODIES} SELECT path, CAST(strlen(body) + 1 AS BIGINT) AS size, sha1(body || chr(10)) AS sha FROM b")
def tree_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written in two phases and read back: paths, sizes and hashes of their bytes."""
    root = _root(spark)
    trees.write(_bodies(spark, sf_dir), root, F.col("path"), F.col("body"))
    return trees.contents(spark, root).select("path", "size", F.sha1("content").alias("sha"))


@query(f"WITH {BODIES} SELECT path, 'file' AS kind, CAST(strlen(body) + 1 AS BIGINT) AS size FROM b UNION ALL SELECT DISTINCT lang, 'folder', CAST(0 AS BIGINT) FROM b")
def tree_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree as the file system lists it: files and folders."""
    root = _root(spark)
    trees.write(_bodies(spark, sf_dir), root, F.col("path"), F.col("body"))
    return trees.entries(spark, root).select("path", "kind", "size")


@query(f"""
WITH {BODIES}, n AS (SELECT path, CAST(substr(source, 4) AS INT) % 4 AS k FROM b)
SELECT path, CASE k WHEN 0 THEN 'added' WHEN 1 THEN 'changed' ELSE 'same' END AS change, 'same' AS again FROM n UNION ALL SELECT 'old/' || path, 'gone', NULL FROM n WHERE k = 2
""")
def tree_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older tree made the same as a newer one: what that changes, and that a second run changes nothing."""
    root, rows = _root(spark), settled(_bodies(spark, sf_dir))
    k = F.substring("source", 4, 9).cast("int") % 4
    old = rows.where(k > 0).select("path", F.when(k == 1, "other").otherwise(F.col("body")).alias("body"))
    gone = rows.where(k == 2).select(F.concat(F.lit("old/"), "path").alias("path"), "body")
    trees.write(old.union(gone), root, F.col("path"), F.col("body"))
    first = trees.mirrored(rows, root, F.col("path"), F.col("body"))
    again = trees.mirrored(rows, root, F.col("path"), F.col("body"))
    return first.join(again.withColumnRenamed("change", "again"), "path", "left")


@query("""
WITH e AS (SELECT DISTINCT lang, source FROM documents), h AS (SELECT DISTINCT source FROM documents WHERE doc_id % 50 = 0)
SELECT lang || '/' || source AS path FROM e WHERE source NOT IN (SELECT source FROM h) UNION ALL SELECT lang || '/' || source || '/deep/er' FROM e WHERE source NOT IN (SELECT source FROM h) UNION ALL SELECT lang || '/' || source || '/deep' FROM e
""")
def tree_empty_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that hold no file at any depth: some sources have files, none has one in its folder 'deep'."""
    docs = table(spark, sf_dir, "documents")
    source = docs.select("lang", "source").distinct()
    held = docs.where("doc_id % 50 = 0").select("source").distinct()
    top = source.select(F.concat_ws("/", "lang", "source").alias("path"), "source")
    folders = top.select("path").union(top.select(F.concat("path", F.lit("/deep")))).union(top.join(held, "source", "left_anti").select(F.concat("path", F.lit("/deep/er")))).union(source.select("lang").distinct())
    files = top.join(held, "source").select(F.concat("path", F.lit("/x")).alias("path")).union(source.select(F.concat("lang", F.lit("/y"))))
    found = folders.select("path", F.lit("folder").alias("kind")).union(files.select("path", F.lit("file")))
    return trees.empty_folders(found)


@query("""
WITH l AS (SELECT DISTINCT '/' || lang || '/' || source AS p FROM documents), r AS (SELECT DISTINCT '/' || lang || '/' || source || '/' || doc_id AS p FROM documents UNION SELECT DISTINCT '/' || lang FROM documents UNION SELECT DISTINCT '/' || lang || '/src1' FROM documents)
SELECT l.p AS "left", r.p AS "right" FROM l JOIN r ON l.p = r.p OR starts_with(r.p, l.p || '/') OR starts_with(l.p, r.p || '/')
""")
def path_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of which one is in the other, by their parts: /en/src1 isn't in /en/src10."""
    at = lambda *parts: F.concat(*[F.concat(F.lit("/"), p) for p in parts]).alias("path")
    docs = table(spark, sf_dir, "documents")
    right = docs.select(at("lang", "source", F.col("doc_id").cast("string"))).union(docs.select(at("lang"))).union(docs.select(at("lang", F.lit("src1"))))
    return trees.overlaps(docs.select(at("lang", "source")), right)


@query("""
WITH f AS (SELECT DISTINCT lang, source, CAST(substr(source, 4) AS INT) AS k FROM documents)
SELECT '/work/' || lang || '/' || source AS path, CASE WHEN k % 5 = 0 THEN 'link' WHEN k % 5 = 1 THEN 'published' WHEN k % 5 = 2 THEN 'not a folder' END AS rule FROM f WHERE k % 5 < 3
UNION ALL SELECT DISTINCT '/work/' || lang, 'repository' FROM f UNION ALL SELECT '/', 'root'
""")
def folders_to_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that may not be cleared: led to by links, published, no folders, around a repository, and the root."""
    rows = table(spark, sf_dir, "documents").select("lang", "source").distinct().withColumn("k", F.substring("source", 4, 9).cast("int") % 5)
    at = F.concat(F.lit("/work/"), "lang", F.lit("/"), "source")
    folders = rows.select(at.alias("path"), F.when(F.col("k") == 0, F.concat(F.lit("/else"), at)).otherwise(at).alias("resolved"), F.when(F.col("k") == 2, "file").when(F.col("k") == 3, "folder").when(F.col("k") == 1, "folder").alias("kind"))
    around = rows.select(F.concat(F.lit("/work/"), "lang").alias("path")).distinct().select("path", F.col("path").alias("resolved"), F.lit("folder").alias("kind"))
    top = spark.createDataFrame([("/", "/", "folder")], "path string, resolved string, kind string")
    repository = rows.select(F.concat(F.lit("/work/"), "lang", F.lit("/repo/x")).alias("path")).distinct()
    published = rows.where("k = 1").select(F.concat(at, F.lit("/out")).alias("path"))
    return trees.unsafe_to_clear(folders.union(around).union(top), repository, published)


class _Read:
    """A published file, chunk by chunk: its kind, what a hash (at most so much of it that a longer one differs) or a
    sheet says, whether a document tells its translation and ends as one, and the SHA-1 of it all."""

    def __init__(self, path: str) -> None:
        base = path.rpartition("/")[2]
        self.kind = "hash" if base.endswith(".sha") else "sheet" if base in tx.PUBLIC_NAMES else "document"
        self.sha, self.held, self.said, self.members = hashlib.sha1(), b"", [], Members("abbreviation")

    def add(self, chunk: bytes) -> None:
        self.sha.update(chunk)
        self.held += chunk
        if self.kind == "hash":
            self.held = self.held[:64]
        elif self.kind == "sheet":
            at = 0
            for x in HEX.finditer(self.held):
                self.said.append(x[0].decode())
                at = x.end()
            self.held = self.held[max(at, len(self.held) - 39):]
        else:
            self.members.add(chunk)
            self.held = self.held[-2:]

    def end(self) -> tuple[str, list[str] | None, bool | None, str]:
        said = [self.held.decode(errors="replace")] if self.kind == "hash" else sorted(self.said) if self.kind == "sheet" else None
        return self.kind, said, self.members.end() and self.held == b"}\n" if self.kind == "document" else None, self.sha.hexdigest()


@query(f"""
WITH {checks.BOOKS}, a AS (SELECT DISTINCT source, {checks.ABBR} AS abbr FROM b), t AS (SELECT {checks.ABBR} AS abbr, CAST(nr AS VARCHAR) AS nr FROM b),
     p AS (SELECT abbr || '.json' AS path FROM a UNION ALL SELECT abbr || '.sha' FROM a UNION ALL SELECT unnest(['translations', 'translations.json', 'checksum', 'checksum.json'])
           UNION ALL SELECT abbr || '/' || nr || '.' || unnest(['json', 'sha']) FROM t UNION ALL SELECT DISTINCT abbr || '/' || unnest(['books', 'books.json', 'checksum', 'checksum.json']) FROM a
           UNION ALL SELECT abbr || '/' || nr || '/1.' || unnest(['json', 'sha']) FROM t UNION ALL SELECT abbr || '/' || nr || '/' || unnest(['chapters', 'chapters.json', 'checksum', 'checksum.json']) FROM t)
SELECT path, true AS "right" FROM p
""")
def published_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of a build, written and read back: each hash is that of the document beside it, each sheet of checksums
    tells the hashes that are there, and each document is its folder's and its own name's."""
    built = checks._build(spark, sf_dir, whole=True)
    root = _root(spark)
    trees.write(corpus.pieces(built, "https://host/v3"), root, F.col("path"), F.col("body"), F.col("turn"))
    stem = F.regexp_replace("path", r"\.(json|sha)$", "")
    folder = lambda c: F.when(F.contains(c, F.lit("/")), F.regexp_replace(c, "/[^/]*$", "")).otherwise("")
    found = trees.folded(spark, root, _Read, _Read.add, _Read.end, "kind string, said array<string>, told boolean, sha string")
    rows = settled(found.select("path", stem.alias("stem"), folder(F.col("path")).alias("folder"), "kind", "said", "told", "sha"))
    docs = rows.where("kind = 'document' AND path LIKE '%.json'").select("stem", F.col("sha").alias("own"))
    there = docs.groupBy(folder(F.col("stem")).alias("folder")).agg(F.array_sort(F.collect_list("own")).alias("every"))
    joined = rows.join(docs, "stem", "left").join(there, "folder", "left")
    right = F.when(F.col("kind") == "hash", F.col("said")[0] == F.concat("own", F.lit("\n"))).when(F.col("kind") == "sheet", F.col("said") == F.col("every")).otherwise(F.col("told"))
    return joined.select("path", F.coalesce(right, F.lit(False)).alias("right"))


def _zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(archive, content): an archive for each source of a language, with its documents and a folder 'mods.d'. Of each
    eight sources one has a path that leads out, one a link, one a file that others have otherwise, one is cut off, and
    one has too many members; all have one file that is the same in all."""
    docs = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", "text")

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, z, data, k = None, None, None, 0  # of the archive that is being written: its documents aren't held

        def begun(own: tuple[str, str]) -> None:
            nonlocal key, z, data, k
            key, k, data = own, int(own[1][3:]) % 8, io.BytesIO()
            z = zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED)
            put("mods.d/", "")
            put("same/./all", "the same")

        def put(name: str, body: str) -> None:
            z.writestr(zipfile.ZipInfo(name), body)

        def ended() -> pa.RecordBatch:
            lang, source = key
            if k == 0:
                put("../out", "x")
            if k == 1:
                link = zipfile.ZipInfo("docs/link")
                link.external_attr = 0o120777 << 16
                z.writestr(link, "/etc")
            if k in (2, 3):
                put(f"clash/{lang}", source)
            if k == 5:
                for n in range(MEMBERS):
                    put(f"many/{n}", "")
            z.close()
            raw = data.getvalue()
            return pa.RecordBatch.from_pydict({"archive": [f"{lang}-{source}.zip"], "content": [raw[: len(raw) // 2] if k == 4 else raw]})

        for batch in batches:
            for lang, source, doc_id, text in zip(*(batch.column(c) for c in ("lang", "source", "doc_id", "text")), strict=True):
                own = lang.as_py(), source.as_py()
                if own != key:
                    if key is not None:
                        yield ended()
                    begun(own)
                put(f"docs/{own[0]}/{doc_id}.txt", text.as_py())
        if key is not None:
            yield ended()

    dealt = docs.repartition("lang", "source").sortWithinPartitions("lang", "source", "doc_id")
    return dealt.mapInArrow(packed, "archive string, content binary")


#: Members that an archive may have in these queries, beside which no source has as many documents of a language.
MEMBERS = 20_000
ZIPS = "z AS (SELECT DISTINCT lang, source, CAST(substr(source, 4) AS INT) % 8 AS k, lang || '-' || source || '.zip' AS archive FROM documents)"


@query(f"""
WITH {ZIPS}, c AS (SELECT lang FROM z WHERE k IN (2, 3) GROUP BY lang HAVING count(*) > 1)
SELECT archive, '../out' AS path, 'path' AS rule FROM z WHERE k = 0 UNION ALL SELECT archive, 'docs/link', 'link' FROM z WHERE k = 1 UNION ALL SELECT archive, 'clash/' || lang, 'conflict' FROM z JOIN c USING (lang) WHERE k IN (2, 3)
UNION ALL SELECT archive, NULL, 'unreadable' FROM z WHERE k = 4 UNION ALL SELECT archive, NULL, 'members' FROM z WHERE k = 5
""")
def archive_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keeps archives made of documents from being merged."""
    return files.refusals(settled(files.members(_zips(spark, sf_dir), MEMBERS).drop("content")))


@query(f"""
WITH {ZIPS}
SELECT 'docs/' || lang || '/' || doc_id || '.txt' AS path, archive, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS sha256 FROM documents JOIN z USING (lang, source) WHERE k NOT IN (4, 5)
UNION ALL SELECT 'same/all', min(archive), 8, sha256('the same') FROM z WHERE k NOT IN (4, 5)
""")
def archive_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree that the same archives' members make, but for those that clash: one of equal paths."""
    return files.merged(files.members(_zips(spark, sf_dir), MEMBERS).where("NOT coalesce(path, '') LIKE 'clash/%'")).drop("content")


TAIL = "usr/bin/tool"


def _tars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(archive, content): a release of each source of a language, whose tool is a digest of its documents' ids. Of each
    seven sources one has a member that leads out, one a link as its tool, one two tools, one none, one is cut off."""
    docs = table(spark, sf_dir, "documents").select("lang", "source", "doc_id")

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, source = key
        k, data = int(source[3:]) % 7, io.BytesIO()
        with tarfile.open(fileobj=data, mode="w:gz") as t:
            def put(name: str, body: bytes, kind: bytes = tarfile.REGTYPE) -> None:
                info = tarfile.TarInfo(name)
                info.size, info.type, info.linkname = len(body), kind, "x"
                t.addfile(info, io.BytesIO(body))

            put("p/readme", source.encode())
            if k != 3:
                put("p/usr/bin/tool", b"" if k == 1 else ",".join(map(str, sorted(rows["doc_id"]))).encode(), tarfile.SYMTYPE if k == 1 else tarfile.REGTYPE)
            if k == 2:
                put("q/usr/bin/tool", b"other")
            if k == 0:
                put("../x", b"")
        raw = data.getvalue()
        return pd.DataFrame({"archive": [f"{lang}-{source}"], "content": [raw[: len(raw) // 2] if k == 4 else raw]})

    return docs.groupBy("lang", "source").applyInPandas(packed, "archive string, content binary")


@query("""
WITH r AS (SELECT lang || '-' || source AS archive, CAST(substr(source, 4) AS INT) % 7 AS k, string_agg(doc_id, ',' ORDER BY doc_id) AS body FROM documents GROUP BY lang, source)
SELECT archive, CASE WHEN k > 4 THEN 'p/usr/bin/tool' END AS path, CASE WHEN k > 4 THEN sha256(body) END AS sha256, CASE k WHEN 0 THEN 'path' WHEN 1 THEN 'kind' WHEN 2 THEN 'several' WHEN 3 THEN 'none' WHEN 4 THEN 'unreadable' END AS rule FROM r
""")
def release_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one tool of each release, or what keeps it from being taken."""
    tars = settled(_tars(spark, sf_dir))
    return releases.executables(tars, releases.tar_members(tars, TAIL))


@query("""
WITH d AS (SELECT doc_id, sha256(text) AS sha FROM documents)
SELECT doc_id, sha AS sha256, CASE doc_id % 6 WHEN 0 THEN 'missing' WHEN 1 THEN 'format' WHEN 2 THEN 'name' WHEN 3 THEN 'sha256' WHEN 4 THEN 'digest' END AS rule FROM d
""")
def release_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as assets, with checksums that are missing, misshapen, of another name or other bytes, or with another
    digest, and some that are right."""
    of, name, sha = F.col("doc_id") % 6, F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.sha2(F.col("text").cast("binary"), 256)
    docs = table(spark, sf_dir, "documents")
    assets = docs.select(F.col("doc_id").alias("release"), name.alias("name"), F.col("text").cast("binary").alias("content"), F.concat(F.lit("sha256:"), F.when(of == 4, "0").otherwise(sha)).alias("digest"))
    line = F.when(of == 1, F.concat(F.upper(sha), F.lit("  "), name)).when(of == 2, F.concat(sha, F.lit("  other"))).when(of == 3, F.concat(F.sha2(name.cast("binary"), 256), F.lit(" *"), name)).otherwise(F.concat(sha, F.lit("  "), name, F.lit("\n")))
    sums = docs.where(of > 0).select(F.col("doc_id").alias("release"), F.concat(name, F.lit(".sha256")).alias("name"), line.cast("binary").alias("content"))
    return releases.verified(assets, sums).select(F.col("release").alias("doc_id"), "sha256", "rule")


@query(f"""
WITH {BODIES}
SELECT lang || '/' || source || '.json' AS path, source AS name, sha1('[' || chr(34) || replace(body, chr(10), '|') || chr(34) || ']' || chr(10)) AS sha FROM b WHERE source NOT IN ('src1', 'src2')
""")
def tree_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON documents of a written tree by path, without reserved names and other files."""
    root = _root(spark)
    rows = _bodies(spark, sf_dir)
    json = rows.select(F.regexp_replace("path", "txt$", "json").alias("path"), F.to_json(F.array(F.replace("body", F.lit("\n"), F.lit("|")))).alias("body"))
    trees.write(json.union(rows.select("path", "body")), root, F.col("path"), F.col("body"))
    found = files.documents(spark, root, ["src1", "src2"])
    return found.select(F.substring_index("path", "/", -2).alias("path"), "name", F.sha1(F.col("body").cast("binary")).alias("sha")).orderBy("path")
