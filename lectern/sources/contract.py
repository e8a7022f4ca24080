"""Self-verifying event logs: one JSON record a line, a header first, a footer with a digest and counts last."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.codec import BYTES, byte_value_rule, decoded, envelope_faults, unknown_members, utf8
from lectern.operators.lookups import small
from lectern.operators.sequences import ordered_digest, scanned, streamed
from lectern.session import settled

#: Fixed values of the format: the longest line, the record types and their stages.
MAX_LINE = 32 * 1024 * 1024
STAGES = {"header": 0, "module": 1, "config_source": 2, "config_entry": 3, "entry": 4, "artifact_begin": 5, "artifact_chunk": 5, "artifact_end": 5}
KNOWN = [*STAGES, "diagnostic", "footer"]
NUMBERED = ["config_source", "config_entry", "entry"]
#: Types of which the records before are counted.
COUNTED = ["header", "module", *NUMBERED, "artifact_begin"]
#: Lines that a task checks together.
BLOCK = 65_536
SEVERITIES = ["error", "info", "warning"]

_CODED = "struct<code:int,name:string>"
_SCOPE = f"struct<type:string,testament:bigint,book:bigint,chapter:bigint,verse:bigint,intro_scope:string,book_name:{BYTES}>"
RECORD = (
    "type string, sequence bigint, contract string, contract_version bigint, command string, producer string, producer_version string, sword_version string,"
    f"classification string, name {BYTES}, description {BYTES}, language {BYTES}, driver {BYTES}, direction {_CODED}, encoding {_CODED}, markup {_CODED},"
    f"ordinal bigint, path {BYTES}, raw {BYTES}, value {BYTES}, key {BYTES}, scope {_SCOPE}, rendered_default {BYTES}, stripped {BYTES},"
    f"artifact_id bigint, file_type string, target {BYTES}, `index` bigint, data {BYTES}, size bigint, sha256 string, severity string,"
    "artifact_bytes bigint, artifacts bigint, entries bigint, counts map<string,bigint>, diagnostics map<string,bigint>, stream_sha256 string, success boolean"
)
BYTE_FIELDS = ["name", "description", "language", "driver", "path", "raw", "value", "key", "rendered_default", "stripped", "target", "data"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """(source, line_no, line, ended, valid, record): the lines of one or many files of any size, read by ranges of bytes.

    A first pass counts the lines and bytes of each range; what came before a range numbers its lines, and a file with a
    byte less than its lines and their ends has a last line without one."""
    raw = spark.read.option("lineSep", "\n").text(path)
    at = F.col("_metadata.file_block_start")
    raw = raw.select(F.col("_metadata.file_path").alias("source"), at.alias("at"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("k"), F.col("value").alias("line"))
    ranges = raw.groupBy("source", "at").agg(F.min("k").alias("first"), F.count("*").alias("n"), F.sum(F.octet_length("line") + 1).alias("bytes"))
    whole = Window.partitionBy("source")
    before = F.coalesce(F.sum("n").over(whole.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = ranges.select("source", "at", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("of"), F.sum("bytes").over(whole).alias("bytes"))
    rows = raw.join(small(settled(known)), ["source", "at"]).withColumn("line_no", F.col("k") + F.col("shift"))
    ended = (F.col("line_no") < F.col("of") - 1) | (F.col("bytes") <= F.col("size"))
    return rows.select("source", "line_no", "line", ended.alias("ended"), F.is_valid_utf8("line").alias("valid"), F.from_json("line", RECORD).alias("record"))


def lines(files: DataFrame) -> DataFrame:
    """read's rows of files (source, content binary) that are values of a table: a file is split in one task."""
    text = F.col("content").cast("string")
    split = files.select("source", F.length("content").alias("n"), F.is_valid_utf8(text).alias("valid"), F.split(text, "\n", -1).alias("parts"))
    every = split.select("source", "valid", F.size("parts").alias("of"), F.posexplode("parts").alias("line_no", "line"))
    # What follows the last line feed is a line only if it isn't empty, and then it lacks its end.
    kept = every.where("line_no < of - 1 OR length(line) > 0").withColumn("ended", F.col("line_no") < F.col("of") - 1)
    return kept.select("source", F.col("line_no").cast("bigint").alias("line_no"), "line", "ended", (F.col("valid") | ~F.contains("line", F.lit("\ufffd"))).alias("valid"), F.from_json("line", RECORD).alias("record"))


def records(rows: DataFrame) -> DataFrame:
    """read's rows of lines (source, line_no, line) that are rows already; each has its end."""
    return rows.select("source", "line_no", "line", F.lit(True).alias("ended"), F.is_valid_utf8("line").alias("valid"), F.from_json("line", RECORD).alias("record"))


def _broken(rows: DataFrame, rules: list[tuple]) -> DataFrame:
    """(source, line_no, rule, detail) of (rule, condition, detail or none) that hold, all in one pass over rows."""
    found = [F.when(when, F.struct(F.lit(rule).alias("rule"), (detail[0] if detail else F.lit(None)).cast("string").alias("detail"))) for rule, when, *detail in rules]
    return rows.select("source", "line_no", F.explode(F.array_compact(F.array(*found))).alias("x")).select("source", "line_no", "x.*")


def violations(log: DataFrame, expected: DataFrame | None = None, require_success: bool = True, block: int = BLOCK) -> DataFrame:
    """(source, line_no, rule, detail): every broken rule of every source, instead of the first. expected is
    (source, module, classification), with nulls for what isn't asked. A log's lines are checked by blocks of so many
    line numbers; only its digest takes them one after the other."""
    r = F.col("record")
    stage = F.create_map(*[F.lit(x) for kv in STAGES.items() for x in kv])[F.col("type")]
    rows = log.withColumn("type", r["type"])
    begin, chunk, end = (F.col("type") == f"artifact_{x}" for x in ("begin", "chunk", "end"))
    one = lambda when: F.coalesce(when, F.lit(False)).cast("long")
    # What a line's rules need of the lines before it, by blocks of lines, so that a log isn't one task's work.
    of_type = {f"n_{t}": one(F.col("type") == t) for t in COUNTED}
    place = F.floor(F.col("line_no") / block)
    rows = scanned(rows, ["source"], "line_no", place, {"n": F.lit(1).cast("long"), "open": one(begin) - one(end), "chunks": one(chunk), "footers": one(F.col("type") == "footer"), **of_type}, {"reached": stage})
    rows = scanned(rows, ["source"], "line_no", place, {}, {}, {"group": F.when(begin, F.struct(r["artifact_id"].alias("id"), F.col("chunks").alias("behind")))})
    turn = F.coalesce(*[F.when(F.col("type") == t, F.col(f"n_{t}")) for t in COUNTED])
    rows = rows.withColumn("stage", stage).withColumn("n_type", turn).withColumn("n_chunk", F.when(F.col("group").isNotNull(), F.col("chunks") - F.col("group.behind")).otherwise(F.col("chunks"))).withColumn("group_id", F.col("group.id"))
    extra = lambda at: F.when(F.size(F.coalesce(unknown_members(F.get_json_object("line", f"$.{at}")), F.array())) > 0, "members")
    nested = [(c, F.coalesce(byte_value_rule(r[c]), extra(c))) for c in BYTE_FIELDS]
    name = r["scope"]["book_name"]
    named = F.coalesce(byte_value_rule(name), extra("scope.book_name"))
    # Byte values elsewhere: lines that have more of them than the known fields hold are walked whole.
    typed = reduce(lambda a, b: a + b, [x.isNotNull().cast("int") for x in (*(r[c] for c in BYTE_FIELDS), name)])
    rows = rows.withColumn("more", F.size(F.regexp_extract_all("line", F.lit(r'"(base64)"\s*:'), F.lit(1))) > F.coalesce(typed, F.lit(0)))
    rules = [
        ("line end", ~F.col("ended") | F.col("line").endswith("\r")),
        ("line length", F.octet_length("line") + 1 > MAX_LINE),
        ("UTF-8", ~F.col("valid")),
        ("JSON object", r.isNull() | ~F.ltrim("line").startswith("{") | F.get_json_object("line", "$").isNull()),
        ("sequence", ~r["sequence"].eqNullSafe(F.col("n")), r["sequence"]),
        ("record type", F.coalesce(F.length("type"), F.lit(0)) == 0),
        ("after footer", F.col("footers") > 0),
        ("order", F.col("stage") < F.col("reached"), F.col("type")),
        ("header first", (F.col("n") == 0) & ~F.col("type").eqNullSafe("header")),
        ("one header", (F.col("type") == "header") & (F.col("n_type") > 0)),
        ("one module", (F.col("type") == "module") & (F.col("n_type") > 0)),
        ("header", (F.col("type") == "header") & ~(r["contract_version"].eqNullSafe(1) & (F.length(r["contract"]) > 0) & r["command"].eqNullSafe("extract"))),
        ("producer", (F.col("type") == "header") & F.array_contains(F.transform(F.array(r["producer"], r["producer_version"], r["sword_version"]), lambda x: F.coalesce(F.length(x), F.lit(0)) == 0), True)),
        ("ordinal", F.col("type").isin(NUMBERED) & ~r["ordinal"].eqNullSafe(F.col("n_type")), r["ordinal"]),
        ("artifact overlap", begin & (F.col("open") > 0)),
        ("artifact id", begin & ~r["artifact_id"].eqNullSafe(F.col("n_type")), r["artifact_id"]),
        ("artifact group", (chunk | end) & ((F.col("open") < 1) | ~r["artifact_id"].eqNullSafe(F.col("group_id")))),
        ("chunk index", chunk & ~r["index"].eqNullSafe(F.col("n_chunk")), r["index"]),
        ("symlink target", begin & (r["file_type"] == "symlink") & r["target"].isNull()),
        *[(f"byte value {c}", r[c].isNotNull() & rule.isNotNull(), rule) for c, rule in nested],
        ("byte value book_name", name.isNotNull() & named.isNotNull(), named),
    ]
    known = F.array(*[F.lit(f"$.{c}") for c in (*BYTE_FIELDS, "scope.book_name")])
    faults = rows.where("more").select("source", "line_no", F.explode(envelope_faults("line")).alias("f"))
    elsewhere = faults.where(~F.array_contains(known, F.col("f.at"))).select("source", "line_no", F.lit("byte value elsewhere").alias("rule"), F.concat("f.at", F.lit(" "), "f.rule").alias("detail"))
    found = [_broken(rows, rules), elsewhere, _artifact_violations(log), _footer_violations(log, require_success)]
    if expected is not None:
        module = log.where("record.type = 'module'").select("source", "line_no", utf8(r["name"]).alias("m"), r["classification"].alias("c")).join(expected, "source")
        found.append(_broken(module, [("module", F.col("m") != F.col("module"), F.col("m")), ("classification", F.col("c") != F.col("classification"), F.col("c"))]))
    return reduce(DataFrame.unionByName, found)


def _chunks(log: DataFrame) -> DataFrame:
    """(source, artifact_id, i, path, data) of what begins an artifact (i -1, data of a link: its target) and its chunks."""
    r = F.col("record")
    return log.where("record.type IN ('artifact_chunk', 'artifact_begin')").select(
        "source", r["artifact_id"].alias("artifact_id"), F.coalesce(r["index"], F.lit(-1)).alias("i"), utf8(r["path"]).alias("path"),
        F.when(r["type"] == "artifact_chunk", decoded(r["data"])).when(r["file_type"] == "symlink", decoded(r["target"])).alias("data"),
    )


def artifact_digests(log: DataFrame) -> DataFrame:
    """(source, artifact_id, size, sha256) of each artifact, from its chunks in order, of which one is held at a time."""
    add = lambda s, x: (s[0].update(x), s.__setitem__(1, s[1] + len(x)))
    return streamed(_chunks(log), ["source", "artifact_id"], ["i"], F.col("data"), lambda: [hashlib.sha256(), 0], add, lambda s: (s[1], s[0].hexdigest()), "size long, sha256 string")


def artifacts(log: DataFrame) -> DataFrame:
    """(source, artifact_id, path, content): chunks joined in order; a link's content is its target. A content is one
    value, so an artifact must fit in one."""
    parts = _chunks(log)
    whole = streamed(parts, ["source", "artifact_id"], ["i"], F.col("data"), list, list.append, lambda parts: (b"".join(parts),), "content binary")
    paths = parts.where("path IS NOT NULL").groupBy(F.col("source").alias("s"), F.col("artifact_id").alias("a")).agg(F.max("path").alias("path"))
    joined = whole.join(paths, F.col("source").eqNullSafe(F.col("s")) & F.col("artifact_id").eqNullSafe(F.col("a")), "left")
    return joined.select("source", "artifact_id", "path", "content")


def _artifact_violations(log: DataFrame) -> DataFrame:
    r = F.col("record")
    ends = log.where("record.type = 'artifact_end'").select("source", "line_no", r["artifact_id"].alias("artifact_id"), r["size"].alias("said"), r["sha256"].alias("sha"))
    both = ends.join(artifact_digests(log), ["source", "artifact_id"], "left")
    return _broken(both, [("artifact size", ~F.col("said").eqNullSafe(F.col("size"))), ("artifact sha256", ~F.col("sha").eqNullSafe(F.col("sha256")))])


def summary(log: DataFrame) -> DataFrame:
    """A row a source: entries, artifacts, artifact_bytes, counts by type, severities, unknown types, and the digest."""
    r = F.col("record")
    rows = log.withColumn("type", r["type"])
    own = rows.where("NOT type <=> 'footer'")
    by_type = own.groupBy("source", "type").agg(F.count("*").alias("n")).where("type IS NOT NULL")
    counts = by_type.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("counts"), F.array_sort(F.filter(F.collect_set("type"), lambda t: ~t.isin(KNOWN))).alias("unknown_types"))
    tally = [F.count_if((F.col("type") == "diagnostic") & (r["severity"] == s)).alias(s) for s in SEVERITIES]
    totals = rows.groupBy("source").agg(F.count_if(F.col("type") == "entry").alias("entries"), F.count_if(F.col("type") == "artifact_end").alias("artifacts"), F.coalesce(F.sum(F.when(F.col("type") == "artifact_end", r["size"])), F.lit(0)).alias("artifact_bytes"), *tally)
    digest = ordered_digest(own, ["source"], ["line_no"], F.col("line")).select("source", F.col("sha256").alias("stream_sha256"))
    return totals.join(counts, "source", "left").join(digest, "source", "left")


def _footer_violations(log: DataFrame, require_success: bool) -> DataFrame:
    r = F.col("record")
    first = log.groupBy("source").agg(F.max("line_no").alias("line_no"), *[F.count_if(r["type"] == t).alias(t) for t in ("header", "module", "footer", "artifact_begin", "artifact_end")])
    gone = [*[(f"missing {t}", F.col(t) == 0) for t in ("header", "module", "footer")], ("open artifact", F.col("artifact_begin") != F.col("artifact_end"))]
    foot = log.where(r["type"] == "footer").select("source", "line_no", r.alias("f")).join(summary(log), "source")
    f = F.col("f")
    entries = lambda m: F.array_sort(F.map_entries(m))
    said = F.array_sort(F.array(*[F.struct(F.lit(s).alias("key"), F.col(s).alias("value")) for s in SEVERITIES]))
    rules = {
        "stream sha256": ~f["stream_sha256"].eqNullSafe(F.col("stream_sha256")),
        "record counts": F.coalesce(entries(f["counts"]) != entries(F.col("counts")), F.lit(True)),
        "entries": ~f["entries"].eqNullSafe(F.col("entries")),
        "artifacts": ~f["artifacts"].eqNullSafe(F.col("artifacts")),
        "artifact bytes": ~f["artifact_bytes"].eqNullSafe(F.col("artifact_bytes")),
        "diagnostics": f["diagnostics"].isNotNull() & (entries(f["diagnostics"]) != said),
    }
    if require_success:
        rules["success"] = ~f["success"].eqNullSafe(True)
    return _broken(first, gone).unionByName(_broken(foot, list(rules.items())))


def unmapped(log: DataFrame) -> DataFrame:
    """(source, type) of record types that a log may have but a build doesn't know what to do with."""
    return log.select("source", F.col("record.type").alias("type")).where(F.col("type").isNotNull() & ~F.col("type").isin(KNOWN)).distinct()


def require_none(found: DataFrame) -> None:
    """Raises with the first few violations, if there are any: the edge of a build that must not go on."""
    if first := found.limit(5).collect():
        raise ValueError("; ".join(str(r.asDict()) for r in first))
