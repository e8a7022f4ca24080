"""Profiles, size reports and constraint queries over corpora."""

from __future__ import annotations

import json as jsonlib
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import normalized_name, strip

#: The size a published file must stay below, and the rows of a top report.
MAX_FILE = 95 * 1024 * 1024
TOP = 20
#: Members that no published document may have, at any depth.
FORBIDDEN = {"source", "source_contract"}
#: Members that aren't entered when structure is looked for, parts of names that tell of structure, and
#: the members of the entries of a layout.
BULKY = {"tokens", "spans", "source", "source_contract"}
STRUCTURE = {"paragraph": (["paragraph"], ["para", "pilcrow"]), "heading": (["heading", "title", "sectionhead"], [])}
SPAN_PARAGRAPHS = ["p", "para", "pilcrow"]
HEADING_MEMBERS = ["anchor", "canonical", "heading_type", "order", "text", "type"]
PARAGRAPH_MEMBERS = ["end", "order", "start", "type"]


def key_profile(rows: DataFrame, group: list[str], json: str) -> DataFrame:
    """(group..., fields, n): the distinct sorted key sets of JSON objects, with how often each occurs."""
    keys = F.array_join(F.array_sort(F.json_object_keys(json)), ",")
    return rows.withColumn("fields", keys).groupBy(*group, "fields").agg(F.count("*").alias("n"))


def size_report(files: DataFrame, root: str, path: str, size: str) -> DataFrame:
    """(root, files, bytes, largest_path, largest_bytes): by root, and over all with root null."""
    best = F.max(F.struct(F.col(size).alias("s"), F.col(path).alias("p")))
    report = files.rollup(root).agg(F.count("*").alias("files"), F.sum(size).alias("bytes"), best.alias("m"))
    return report.select(root, "files", "bytes", F.col("m.p").alias("largest_path"), F.col("m.s").alias("largest_bytes"))


def largest(files: DataFrame, path: str, size: str, n: int = TOP) -> DataFrame:
    """The n largest, of equal ones the later path first."""
    return files.orderBy(F.desc(size), F.desc(path)).limit(n)


def oversized(files: DataFrame, path: str, size: str, limit: int = MAX_FILE) -> DataFrame:
    """(path, rule, bytes) of files that are left over from an interrupted write (a hidden name that ends in .tmp),
    whatever their size, or that reach the limit, by path."""
    rule = F.when(F.col(path).rlike(r"(^|/)\.[^/]*\.tmp$"), "temporary").when(F.col(size) >= limit, "size")
    return files.select(F.col(path).alias("path"), rule.alias("rule"), F.col(size).alias("bytes")).where("rule IS NOT NULL").orderBy("path")


def coverage(verses: DataFrame, group: list[str], tokens: str, spans: str) -> DataFrame:
    """(group..., verses, with_tokens, with_spans, tokens, spans)."""
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    has = lambda c: F.count_if(F.greatest(n(c), F.lit(0)) > 0)
    total = lambda c: F.sum(F.greatest(n(c), F.lit(0)).cast("bigint"))
    return verses.groupBy(*group).agg(F.count("*").alias("verses"), has(tokens).alias("with_tokens"), has(spans).alias("with_spans"), total(tokens).alias("tokens"), total(spans).alias("spans"))


def tag_counts(verses: DataFrame, spans: str) -> DataFrame:
    """(tag, n) over all spans, by tag."""
    return verses.select(F.explode(spans).alias("s")).groupBy(F.col("s.tag").alias("tag")).agg(F.count("*").alias("n")).orderBy("tag")


def expected_numbers(rows: DataFrame, group: list[str], number: str) -> DataFrame:
    """(group..., number, expected): numbers that aren't 1, 2, ... in order."""
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(number))
    return rows.withColumn("expected", turn.cast("bigint")).where(F.col(number) != F.col("expected")).select(*group, number, "expected")


def verse_violations(verses: DataFrame, group: list[str]) -> DataFrame:
    """(group..., verse, rule) of verses (group..., verse, text, tokens, spans): numbers, empty texts, leading line
    ends, tokens without spans, and chapters in which no verse has tokens."""
    pick = lambda rule, when: verses.where(when).select(*group, "verse", F.lit(rule).alias("rule"))
    rules = [
        expected_numbers(verses, group, "verse").select(*group, "verse", F.lit("number").alias("rule")),
        pick("empty text", F.coalesce(F.length("text"), F.lit(0)) == 0),
        pick("leading line end", F.col("text").rlike(r"^[\r\n]")),
        pick("tokens without spans", F.col("tokens").isNotNull() & F.col("spans").isNull()),
    ]
    none = verses.groupBy(*group).agg(F.count_if(F.greatest(F.coalesce(F.size("tokens"), F.lit(0)), F.lit(0)) > 0).alias("n")).where("n = 0")
    rules.append(none.select(*group, F.lit(None).cast(verses.schema["verse"].dataType).alias("verse"), F.lit("no tokens").alias("rule")))
    return reduce(DataFrame.unionByName, rules)


def editorial_violations(entries: DataFrame, verses: DataFrame, group: list[str]) -> DataFrame:
    """(group..., order, rule) of layout.editorial's rows: order, known types, ranges that follow each other from the
    first verse to the last, and reading order."""
    window = Window.partitionBy(*group).orderBy("order")
    pick = lambda rows, rule, when: rows.where(when).select(*group, "order", F.lit(rule).alias("rule"))
    numbered = entries.withColumn("__n", F.row_number().over(window) - 1)
    at = F.coalesce(F.col("verse"), F.col("start"))
    reading = entries.withColumn("__at", at).withColumn("__before", F.lag("__at").over(window))
    ends = verses.groupBy(*group).agg(F.min("verse").alias("__low"), F.max("verse").alias("__high"))
    ranges = entries.where("type = 'paragraph'")
    chained = ranges.withColumn("__before", F.lag("end").over(window)).withColumn("__after", F.lead("start").over(window)).join(ends, group)
    return reduce(
        DataFrame.unionByName,
        [
            pick(numbered, "order", F.col("order") != F.col("__n")),
            pick(entries, "type", ~F.coalesce(F.col("type").isin("heading", "paragraph"), F.lit(False))),
            pick(reading, "reading order", F.col("__at") < F.col("__before")),
            pick(chained, "first verse", F.col("__before").isNull() & (F.col("start") != F.col("__low"))),
            pick(chained, "last verse", F.col("__after").isNull() & (F.col("end") != F.col("__high"))),
            pick(chained, "contiguous", F.col("start") != F.col("__before") + 1),
            pick(entries, "range", F.col("end") < F.col("start")),
        ],
    )


def forbidden_members(json: Column, names: Iterable[str] = frozenset(FORBIDDEN)) -> Column:
    """Which of the names a JSON text has as a member at any depth, in order; null for null and for what is no JSON. Only
    the members' names are looked at while the text is read, so nothing of it is kept."""
    wanted = frozenset(names)

    def members(text: str | None) -> list[str] | None:
        found: set[str] = set()
        try:
            jsonlib.loads(text, object_pairs_hook=lambda pairs: found.update(k for k, _ in pairs if k in wanted))
        except (TypeError, ValueError, RecursionError):
            return None
        return sorted(found)

    return F.arrow_udf(lambda texts: pa.array([members(x.as_py()) for x in texts], pa.list_(pa.string())), "array<string>")(json)


def tells_of(name: Column, kind: str) -> Column:
    """Whether a member's name tells of paragraphs or headings, by its letters and digits in lower case."""
    parts, whole = STRUCTURE[kind]
    low = normalized_name(name)
    found = F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(low, p))
    return found | low.isin(whole) if whole else found


def span_kind(tag: Column, type: Column) -> Column:
    """paragraph, heading or null for a span, by its tag and type."""
    low = normalized_name(F.coalesce(tag, F.lit("")))
    both = F.concat(low, normalized_name(F.coalesce(type, F.lit(""))))
    heading = F.exists(F.array(*[F.lit(p) for p in STRUCTURE["heading"][0]]), lambda p: F.contains(both, p))
    return F.when(F.contains(both, F.lit("paragraph")) | low.isin(SPAN_PARAGRAPHS), "paragraph").when(heading, "heading")


def semantic_fields(json: Column, kind: str) -> Column:
    """array of (field, value as JSON) of the members of a JSON text that tell of a kind of structure. A member that does
    is taken whole; bulky ones aren't entered. Documents have any shape, so they are walked in Python."""
    parts, whole = STRUCTURE[kind]

    def hit(name: str) -> bool:
        low = "".join(c for c in name.lower() if c.isalnum())
        return low in whole or any(p in low for p in parts)

    def found(text: str | None) -> list[dict] | None:
        if text is None:
            return None
        todo, out = [("", jsonlib.loads(text))], []
        while todo:
            at, x = todo.pop()
            if isinstance(x, list):
                todo += [(f"{at}[{n}]", v) for n, v in enumerate(x)][::-1]
            elif isinstance(x, dict):
                rows = [(f"{at}.{k}" if at else k, k, v) for k, v in x.items()]
                out += [{"field": here, "value": jsonlib.dumps(v, ensure_ascii=False, separators=(",", ":"))} for here, k, v in rows if hit(k)]
                todo += [(here, v) for here, k, v in rows if not hit(k) and k not in BULKY][::-1]
        return sorted(out, key=lambda f: f["field"])

    return F.pandas_udf(lambda texts: texts.map(found), "array<struct<field:string,value:string>>")(json)


def misnamed(wanted: DataFrame, found: DataFrame, keys: list[str], name: str, aliases: str) -> DataFrame:
    """(keys..., rule) of wanted (keys..., aliases array) that found (keys..., name) lacks, or names otherwise."""
    rows = wanted.join(found.select(*keys, F.col(name).alias("__name"), F.lit(True).alias("__there")), keys, "left")
    rule = F.when(F.col("__there").isNull(), "missing").when(~F.coalesce(F.array_contains(F.col(aliases), normalized_name(F.col("__name"))), F.lit(False)), "name")
    return rows.select(*keys, rule.alias("rule")).where("rule IS NOT NULL")


def member_violations(entries: DataFrame, group: list[str], json: str) -> DataFrame:
    """(group..., rule) of layout entries (JSON text) whose members aren't exactly those of their type, or whose
    anchor isn't (verse, edge)."""
    keys = F.array_sort(F.json_object_keys(json))
    exact = lambda names: F.array(*[F.lit(n) for n in names])
    kind = F.get_json_object(json, "$.type")
    anchor = F.array_sort(F.json_object_keys(F.get_json_object(json, "$.anchor")))
    rule = (
        F.when(~F.coalesce(kind.isin("heading", "paragraph"), F.lit(False)), "type")
        .when((kind == "heading") & (keys != exact(HEADING_MEMBERS)), "members")
        .when((kind == "paragraph") & (keys != exact(PARAGRAPH_MEMBERS)), "members")
        .when((kind == "heading") & ~F.coalesce(anchor == exact(["edge", "verse"]), F.lit(False)), "anchor")
    )
    return entries.select(*group, rule.alias("rule")).where("rule IS NOT NULL")


def document_violations(chapters: DataFrame, group: list[str], number: str, json: str) -> DataFrame:
    """(group..., rule) of chapter documents (JSON text): forbidden members, titles beside the layout, another chapter
    number than the key's, and no verses."""
    size = F.coalesce(F.json_array_length(F.get_json_object(json, "$.verses")), F.lit(0))
    titled = F.array_contains(F.json_object_keys(json), "titles") | F.get_json_object(json, "$.verses[*].titles").isNotNull()
    rules = F.array(
        F.when(F.size(forbidden_members(F.col(json))) > 0, "forbidden"), F.when(titled, "titles"),
        F.when(~F.col(number).cast("bigint").eqNullSafe(F.get_json_object(json, "$.chapter").try_cast("bigint")), "number"), F.when(size == 0, "no verses"),
    )
    return chapters.select(*group, F.explode(F.array_compact(rules)).alias("rule"))


def _of(v: Column, path: str, kind: str, *schemas: str) -> Column:
    """A member of a variant as kind, null unless it is of one of the JSON types (as schema_of_variant calls them)."""
    found = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(found).isin(*schemas), F.try_variant_get(v, path, kind))


def _whole(v: Column, path: str) -> Column:
    return _of(v, path, "bigint", "BIGINT")


def _text(v: Column, path: str) -> Column:
    return _of(v, path, "string", "STRING")


def _there(v: Column, path: str) -> Column:
    """Whether a member is there and isn't JSON's null."""
    found = F.try_variant_get(v, path, "variant")
    return found.isNotNull() & ~F.is_variant_null(found)


def _objects(v: Column, path: str) -> Column:
    """Whether a member is an array of nothing but objects."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return F.coalesce(kind.startswith("ARRAY<OBJECT") | (kind == "ARRAY<VOID>"), F.lit(False))


def _listed(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def _keys(v: Column) -> Column:
    return F.array_sort(F.json_object_keys(F.to_json(v)))


def _entry(x: Column, i: Column, numbers: Column) -> Column:
    """The first rule that a layout's entry breaks, and where it begins and ends among the verses."""
    kind, exact = _text(x, "$.type"), lambda names: F.array(*[F.lit(n) for n in names])
    place = lambda path: F.nullif(F.array_position(numbers, _whole(x, path)), F.lit(0))
    heading, start, end = kind == "heading", F.when(kind == "heading", place("$.anchor.verse")).otherwise(place("$.start")), place("$.end")
    blank = lambda path: F.coalesce(F.length(strip(_text(x, path))), F.lit(0)) == 0
    no = lambda c: ~F.coalesce(c, F.lit(False))
    rule = (
        F.when(no(_whole(x, "$.order") == i), "order")
        .when(no(kind.isin("heading", "paragraph")), "type")
        .when(no(_keys(x) == F.when(heading, exact(HEADING_MEMBERS)).otherwise(exact(PARAGRAPH_MEMBERS))), "members")
        .when(heading & no(_keys(F.try_variant_get(x, "$.anchor", "variant")) == exact(["edge", "verse"])), "anchor")
        .when(start.isNull() | ~heading & end.isNull(), "place")
        .when(heading & no(_text(x, "$.anchor.edge") == "before"), "edge")
        .when(heading & (blank("$.text") | blank("$.heading_type")), "blank heading")
        .when(heading & _of(x, "$.canonical", "boolean", "BOOLEAN").isNull(), "canonical")
        .when(~heading & (end < start), "range")
    )
    return F.struct(rule.alias("rule"), heading.alias("heading"), start.alias("start"), end.alias("end"))


def chapter_facts(chapters: DataFrame, keys: list[str], book: str, number: str, body: str) -> DataFrame:
    """(keys..., rules, verses, with_tokens, with_spans, tokens, tags, headings, paragraphs) of chapter documents
    (keys..., the numbers of book and chapter, the body as JSON): each document is read once, and all of its rules
    are of its own row. rules are the names of those it breaks, in order."""
    rows = chapters.select(*keys, F.col(book).cast("bigint").alias("__book"), F.col(number).cast("bigint").alias("__number"), forbidden_members(F.col(body)).alias("__forbidden"), F.try_parse_json(body).alias("__v"))
    v, x = F.col("__v"), lambda c: F.col(f"__{c}")
    rows = rows.withColumn("__list", _listed(v, "$.verses")).withColumn("__numbers", F.transform("__list", lambda verse: _whole(verse, "$.verse")))
    verse = lambda y: F.struct(
        _text(y, "$.text").alias("text"), F.try_variant_get(y, "$.titles", "variant").isNotNull().alias("titled"), _there(y, "$.tokens").alias("has_tokens"), _there(y, "$.spans").alias("has_spans"),
        _objects(y, "$.tokens").alias("good_tokens"), _objects(y, "$.spans").alias("good_spans"), F.size(_listed(y, "$.tokens")).alias("tokens"), F.transform(_listed(y, "$.spans"), lambda s: F.coalesce(F.try_variant_get(s, "$.tag", "string"), F.lit("<missing>"))).alias("tags"),
    )
    rows = rows.withColumn("__verses", F.transform("__list", verse)).withColumn("__entries", F.transform(_listed(v, "$.editorial"), lambda e, i: _entry(e, i, F.col("__numbers"))))
    some = lambda test: F.exists("__verses", test)
    entries, ranges = F.col("__entries"), F.filter("__entries", lambda e: ~e["heading"])
    at = F.transform(entries, lambda e: F.struct(e["start"].alias("start"), F.when(e["heading"], 0).otherwise(1).alias("kind")))
    well = ~F.exists(entries, lambda e: e["rule"].isNotNull())
    gaps = F.exists(F.transform(ranges, lambda e, i: e["start"] != F.when(i == 0, 1).otherwise(F.get(ranges, i - 1)["end"] + 1)), lambda gap: gap)
    has = F.size(ranges) > 0
    rules = [
        ("JSON", v.isNull()), ("forbidden", F.size("__forbidden") > 0), ("titles", F.try_variant_get(v, "$.titles", "variant").isNotNull() | some(lambda y: y["titled"])),
        ("book", ~_whole(v, "$.book_nr").eqNullSafe(x("book"))), ("number", ~_whole(v, "$.chapter").eqNullSafe(x("number"))),
        ("no verses", ~_objects(v, "$.verses") | (F.size("__list") == 0)), ("verse numbers", F.col("__numbers") != F.transform("__numbers", lambda _, i: (i + 1).cast("bigint"))), ("verse number", F.exists("__numbers", lambda n: n.isNull())),
        ("empty text", some(lambda y: F.coalesce(F.length(y["text"]), F.lit(0)) == 0)), ("leading line end", some(lambda y: F.coalesce(y["text"].rlike(r"^[\r\n]"), F.lit(False)))),
        ("tokens", some(lambda y: y["has_tokens"] & ~y["good_tokens"])), ("tokens without spans", some(lambda y: y["has_tokens"] & ~y["has_spans"])), ("spans", some(lambda y: y["has_spans"] & ~y["good_spans"])),
        ("no tokens", (F.size("__verses") > 0) & ~some(lambda y: y["tokens"] > 0)), ("editorial", _there(v, "$.editorial") & (F.size(entries) == 0)),
        *[(f"editorial {r}", F.array_contains(F.transform(entries, lambda e: F.coalesce(e["rule"], F.lit(""))), r)) for r in ("order", "type", "members", "anchor", "place", "edge", "blank heading", "canonical", "range")],
        ("reading order", well & (at != F.array_sort(at))), ("coverage", well & has & gaps), ("coverage end", well & has & ~gaps & (F.element_at(ranges, -1)["end"] != F.size("__list"))),
    ]
    total = lambda c: F.aggregate("__verses", F.lit(0).cast("bigint"), lambda a, y: a + c(y))
    return rows.select(
        *keys, F.array_compact(F.array(*[F.when(when, F.lit(rule)) for rule, when in rules])).alias("rules"), F.size("__list").cast("bigint").alias("verses"), total(lambda y: (y["tokens"] > 0).cast("bigint")).alias("with_tokens"),
        total(lambda y: y["has_spans"].cast("bigint")).alias("with_spans"), total(lambda y: y["tokens"].cast("bigint")).alias("tokens"), F.flatten(F.transform("__verses", lambda y: y["tags"])).alias("tags"),
        F.size(F.filter(entries, lambda e: e["heading"])).cast("bigint").alias("headings"), F.size(ranges).cast("bigint").alias("paragraphs"),
    )


def missing_targets(wanted: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted keys without a document."""
    return wanted.select(*keys).join(found.select(*keys), keys, "left_anti")


def severity_buckets(rows: DataFrame, group: list[str], severity: Column, names: list[str]) -> DataFrame:
    """(group..., a column a name): counts, 0 where none."""
    return rows.withColumn("__s", severity).groupBy(*group).agg(*[F.count_if(F.col("__s") == n).alias(n) for n in names])


def size_gate(roots: DataFrame, files: DataFrame, root: str, size: str, limit: int = MAX_FILE) -> DataFrame:
    """(root, rule) of wanted roots that have no file, only empty ones, or one that reaches the limit."""
    seen = files.groupBy(root).agg(F.count("*").alias("__n"), F.sum(size).alias("__sum"), F.max(size).alias("__max"))
    rule = F.when(F.col("__n").isNull(), "missing").when(F.col("__sum") == 0, "empty").when(F.col("__max") >= limit, "size")
    return roots.select(root).distinct().join(seen, root, "left").select(root, rule.alias("rule")).where("rule IS NOT NULL")


def broken_rules(facts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., rule) of chapter_facts' rows, a row for each rule that is broken."""
    # An inner explode would have all that rules are made of evaluated once more in a filter below it.
    return facts.select(*keys, F.explode_outer("rules").alias("rule")).where("rule IS NOT NULL")
