"""From event logs to a three-level corpus (translation, book, chapter) and its manifests."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import codec, markup
from lectern.functions import text as tx
from lectern.operators import layout, lookups, manifest, nesting
from lectern.session import settled, small_batches
from lectern.sources import contract, trees

META = ["translation", "abbreviation", "lang", "language", "direction", "encoding"]
#: The distribution fields and the settings they come from.
DISTRIBUTION = {"lcsh": "lcsh", "version": "version", "version_date": "swordversiondate", "about": "about", "license": "distributionlicense", "sourcetype": "sourcetype", "source": "textsource", "versification": "versification"}
CHAPTER = ["source", "nr", "chapter"]
#: What listings tell of a document's translation.
TOLD = ["language", "translation", "direction"]


@dataclass
class Corpus:
    """verses, editorial: flat rows. chapters, books, translations: rows with path and body, head (the body without what
    is nested in it), and what listings tell. violations: (source,
    ordinal, rule) of entries that have no place, and of unknown record types; a build is not to go on with any.
    parts: (source, turn, body), the translations' bodies in pieces, a book in each, for those who don't need them as
    values; where it is missing, a body is one piece."""

    verses: DataFrame
    editorial: DataFrame
    chapters: DataFrame
    books: DataFrame
    translations: DataFrame
    violations: DataFrame
    parts: DataFrame | None = None


def _more(json: Column, **members: Column) -> Column:
    """A JSON object with members (JSON text) behind its own; null ones are left out."""
    parts = [F.concat(F.lit(f'"{k}":'), v) for k, v in members.items()]
    added = F.array_join(F.array_compact(F.array(*parts)), ",")
    inner = F.substring(json, 2, F.length(json) - 2)
    return F.concat(F.lit("{"), F.array_join(F.filter(F.array(inner, added), lambda x: F.length(x) > 0), ","), F.lit("}"))


def _listed(items: Column) -> Column:
    """JSON texts as a JSON array, null for none."""
    return F.when(F.size(items) > 0, F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))


def _joined(one: Column, two: Column) -> Column:
    """The members of two JSON objects that aren't empty as those of one."""
    return F.concat(F.substring(one, 1, F.length(one) - 1), F.lit(","), F.substring(two, 2, 1 << 30))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join on keys of which some may be null, on both sides."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left").drop(*[f"__{k}" for k in keys])


def metadata(log: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """A row a source: META, description, markup, and entries, its settings."""
    r = F.col("record")
    config = log.where("record.type = 'config_entry'").select("source", r["ordinal"].alias("ordinal"), codec.utf8(r["name"]).alias("name"), codec.mixed_decode(codec.decoded(r["value"])).alias("v"))
    settings = nesting.as_map(nesting.last_wins(config, ["source"], F.col("name"), "v", "ordinal"), ["source"])
    text = lambda c: codec.mixed_decode(codec.decoded(r[c]))
    rows = log.where("record.type = 'module'").select(
        "source", codec.utf8(r["name"]).alias("module"), text("description").alias("own_description"), text("language").alias("own_language"),
        F.coalesce(r["direction"]["name"], F.lit("ltr")).alias("own_direction"), F.coalesce(r["encoding"]["name"], F.lit("")).alias("own_encoding"), F.coalesce(r["markup"]["name"], F.lit("")).alias("markup"),
    ).join(settings, "source", "left").withColumn("entries", F.coalesce("entries", F.create_map().cast("map<string,string>")))
    for name, own in (("lang", "own_language"), ("description", "own_description"), ("encoding", "own_encoding")):
        rows = rows.withColumn(f"__{name}", lookups.merged_config(F.col("entries"), name, F.col(own)))
    rows = rows.withColumnRenamed("__lang", "code").withColumnRenamed("__description", "description").withColumnRenamed("__encoding", "encoding")
    rows = lookups.with_default(rows, lookups.small(dims["modules"]), {"module": "module"}, "abbr", F.lower("module"), "abbreviation")
    rows = lookups.title(rows, lookups.small(dims["titles"]), "abbreviation", "description", "module").withColumnRenamed("title", "translation")
    return lookups.language(rows, lookups.small(dims["corrections"]), lookups.small(dims["languages"]), lookups.small(dims["directions"]), "code", "own_direction")


def build(log: DataFrame, dims: dict[str, DataFrame], whole: bool = False) -> Corpus:
    """The corpus of verified logs (contract.read). dims: modules (module, abbr), titles (abbr, title), corrections,
    languages, directions (code, value), numbers (source_name, nr), names (source_name, name), overrides (abbr, nr,
    name). Work is dealt out by source, book and chapter; a book's and a translation's body is joined from its
    children's, which are text already. whole: all levels will be read, so chapters and books are settled on the way."""
    meta = settled(metadata(log, dims))
    r, s = F.col("record"), F.col("record.scope")
    rows = log.where("record.type = 'entry' AND record.scope.type = 'verse_key'").select(
        "source", r["ordinal"].alias("ordinal"), s["intro_scope"].alias("domain"), s["testament"].alias("testament"), s["book"].alias("book"), s["chapter"].alias("chapter"), s["verse"].alias("verse"),
        codec.mixed_decode(codec.decoded(s["book_name"])).alias("book_name"), *[codec.decoded(r[c]).alias(c) for c in ("raw", "rendered_default", "stripped")],
    )
    rows = rows.where("domain IN ('verse', 'module', 'testament', 'book', 'chapter')").join(meta.select("source", "abbreviation", "markup"), "source")
    rows = lookups.book_number(rows, lookups.small(dims["numbers"]), "book_name", "testament", "book")
    rows = lookups.with_default(rows, lookups.small(dims["names"]), {"book_name": "source_name"}, "name", F.col("book_name"), "default_name")
    in_book, in_chapter = F.col("domain").isin("verse", "book", "chapter"), F.col("domain").isin("verse", "chapter")
    rule = F.when(in_book & F.col("nr").isNull(), "book").when(in_chapter & ~F.coalesce(F.col("chapter") > 0, F.lit(False)), "chapter").when((F.col("domain") == "verse") & ~F.coalesce(F.col("verse") > 0, F.lit(False)), "verse")
    rows = rows.withColumn("rule", rule)
    strange = contract.unmapped(log).select("source", F.lit(None).cast("bigint").alias("ordinal"), F.concat(F.lit("record type "), "type").alias("rule"))
    rows = settled(rows)
    violations = rows.where("rule IS NOT NULL").select("source", "ordinal", "rule").unionByName(strange)
    rows = rows.where("rule IS NULL").withColumn("nr", F.when(in_book, F.col("nr").cast("bigint"))).withColumn("chapter", F.when(in_chapter, F.col("chapter")))
    shown = codec.display_text(F.col("stripped"), F.col("raw"), F.col("rendered_default"), F.col("markup"), markup.plain)
    rows = rows.withColumn("shown", shown).withColumn("text", F.when(F.col("domain") == "verse", tx.strip_leading_eol(F.col("shown"))).otherwise(F.col("shown")))
    rows = rows.withColumn("m", markup.markup(codec.token_markup(F.col("raw"), F.col("rendered_default"), F.col("markup")), F.col("text")))
    rows = settled(rows.drop("raw", "rendered_default", "stripped", "shown"))  # markup is read once

    seen = rows.where(in_book).groupBy("source", "abbreviation", "nr").agg(F.min_by("default_name", "ordinal").alias("default_name"), F.min("ordinal").alias("seen"))
    books = lookups.with_default(seen, lookups.small(dims["overrides"]), {"abbreviation": "abbr", "nr": "nr"}, "name", F.col("default_name"), "book_name").select("source", "nr", "seen", "book_name")

    verses = rows.where("domain = 'verse'").where(~tx.is_blank(F.col("text"))).drop("book_name").join(books.select("source", "nr", "book_name"), ["source", "nr"])
    verses = verses.select(*CHAPTER, "ordinal", "verse", tx.verse_name(F.col("book_name"), F.col("chapter"), F.col("verse")).alias("name"), "text", F.when(F.col("m.paragraph"), True).alias("paragraph"), F.col("m.annotated.tokens").alias("tokens"), F.col("m.annotated.spans").alias("spans"), "m")

    intros = rows.where("domain <> 'verse'").withColumn("prose", F.when(~tx.is_blank(F.col("text"), "") & ~F.coalesce(F.array_contains(F.transform("m.titles", lambda t: t["text"]), tx.strip(F.col("text"))), F.lit(False)), F.col("text")))
    place = ["source", "nr", "chapter"]
    own_titles = intros.select(*place, "ordinal", F.posexplode("m.titles_json").alias("i", "json"), F.col("m.titles").alias("ts"))
    own_titles = nesting.first_wins(own_titles, place, [F.col("json")], ["ordinal", "i"])
    titles_of = own_titles.groupBy(*place).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "i", "json"))), lambda x: x["json"]).alias("titles"))
    prose_of = intros.where("prose IS NOT NULL").groupBy(*place).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "prose"))), lambda x: F.to_json(F.struct(x["prose"].alias("text")))).alias("introduction"))

    fact = lambda c: F.col(f"t.{c}").alias(c)
    of_verses = verses.select(*CHAPTER, "verse", F.lit(1).alias("level"), "ordinal", F.posexplode("m.titles").alias("i", "t")).select(*CHAPTER, "verse", "level", F.struct("ordinal", "i").alias("seq"), fact("type"), fact("text"), fact("canonical"))
    first = verses.groupBy(*CHAPTER).agg(F.min_by("verse", "ordinal").alias("verse"))
    of_chapters = own_titles.where("chapter IS NOT NULL").select(*place, F.struct("ordinal", "i").alias("seq"), F.get("ts", F.col("i")).alias("t")).join(first, CHAPTER)
    of_chapters = of_chapters.select(*CHAPTER, "verse", F.lit(0).alias("level"), "seq", fact("type"), fact("text"), fact("canonical"))
    editorial = layout.editorial(verses.select(*CHAPTER, "ordinal", "verse", "paragraph"), of_chapters.unionByName(of_verses), CHAPTER)
    anchor = F.when(F.col("type") == "heading", F.struct("verse", F.lit("before").alias("edge")))
    entry = F.to_json(F.struct("order", "type", anchor.alias("anchor"), "start", "end", "text", "heading_type", "canonical"))
    layout_of = editorial.groupBy(*CHAPTER).agg(F.transform(F.array_sort(F.collect_list(F.struct("order", entry.alias("json")))), lambda x: x["json"]).alias("editorial"))

    body = _more(F.to_json(F.struct("chapter", "verse", "name", "text", "paragraph")), tokens=F.col("m.tokens_json"), spans=F.col("m.spans_json"))
    nested = verses.groupBy(*CHAPTER).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", body.alias("json")))), lambda x: x["json"]).alias("verses"))
    every = rows.where(in_chapter).groupBy(*CHAPTER).agg(F.min("ordinal").alias("seen_chapter"))
    chapters = _same(_same(every.join(nested, CHAPTER, "left").join(layout_of, CHAPTER, "left"), titles_of, place), prose_of, place).join(books, ["source", "nr"])
    has = F.size("verses") > 0
    inner = _more(
        F.to_json(F.struct("chapter", tx.chapter_name(F.col("book_name"), F.col("chapter")).alias("name"))), titles=F.when(~F.coalesce(has, F.lit(False)), _listed(F.col("titles"))),
        introduction=_listed(F.col("introduction")), editorial=_listed(F.col("editorial")),
    )
    # A chapter of introductions alone has no document of its own, but stays in a book that has verses.
    chapters = chapters.withColumn("start", inner).withColumn("json", _more(F.col("start"), verses=F.coalesce(_listed(F.col("verses")), F.lit("[]")))).withColumn("has_verses", F.coalesce(has, F.lit(False)))
    chapters = settled(chapters.drop("verses", "editorial", "titles", "introduction")) if whole else chapters
    shared = F.to_json(F.struct(*META))
    with_meta = chapters.where("has_verses").join(meta, "source")
    fields = F.concat(F.lit("{"), F.substring(shared, 2, F.length(shared) - 2), F.lit(","), F.substring(F.to_json(F.struct(F.col("nr").alias("book_nr"), "book_name")), 2, 1 << 30))
    chapter_docs = with_meta.select("source", "abbreviation", "nr", "chapter", tx.joined_url(F.col("abbreviation"), F.col("nr").cast("string"), F.concat(F.col("chapter").cast("string"), F.lit(".json"))).alias("path"), fields.alias("shared"), "json", "start", F.col("book_name").alias("name"), *TOLD)
    chapter_docs = chapter_docs.withColumn("body", _joined(F.col("shared"), F.col("json"))).withColumn("head", _joined(F.col("shared"), F.col("start"))).drop("shared", "json", "start")

    held = chapters.groupBy("source", "nr").agg(F.bool_or("has_verses").alias("has"), F.transform(F.array_sort(F.collect_list(F.struct("seen_chapter", "json"))), lambda x: x["json"]).alias("chapters")).where("has")
    top, said = (x.where("chapter IS NULL").drop("chapter") for x in (titles_of, prose_of))
    book_rows = _same(_same(held.join(books, ["source", "nr"]), top, ["source", "nr"]), said, ["source", "nr"]).join(meta, "source")
    named = F.to_json(F.struct("nr", F.col("book_name").alias("name")))
    own = dict(titles=_listed(F.col("titles")), introduction=_listed(F.col("introduction")))
    book_rows = book_rows.withColumn("json", _more(named, **own, chapters=_listed(F.col("chapters"))))
    book_rows = settled(book_rows) if whole else book_rows
    book_docs = book_rows.select("source", "abbreviation", "nr", "seen", tx.joined_url(F.col("abbreviation"), F.concat(F.col("nr").cast("string"), F.lit(".json"))).alias("path"), _joined(shared, _more(named, chapters=_listed(F.col("chapters")), **own)).alias("body"), F.col("book_name").alias("name"), *TOLD, _joined(shared, _more(named, **own)).alias("head"))

    listed = book_rows.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seen", "json"))), lambda x: x["json"]), ",").alias("books"))
    whole = lambda df: df.where("nr IS NULL").drop("nr")
    edges = meta.join(whole(top), "source", "left").join(whole(said), "source", "left")
    releases = edges.join(listed, "source", "left")
    spread = nesting.with_defaults(F.col("entries"), "x", [*DISTRIBUTION.values()])
    facts = [c.alias(f"distribution_{name}") for c, name in zip(spread, DISTRIBUTION, strict=True)] + [F.coalesce(F.try_element_at("entries", F.lit("abbreviation")), "abbreviation").alias("distribution_abbreviation"), nesting.filtered_map(F.col("entries"), "history").alias("distribution_history")]
    start, end = F.to_json(F.struct(*META, "description")), F.to_json(F.struct(*facts))
    opened = _more(start, books=F.lit("["))
    before, behind = F.substring(opened, 1, F.length(opened) - 1), F.concat(F.lit("]"), F.substring(_joined(_more(F.lit('{"":0}'), **own), end), 6, 1 << 30))
    body = F.concat(before, F.coalesce("books", F.lit("")), behind)
    first = book_rows.groupBy("source").agg(F.min("seen").alias("first"))
    nested = book_rows.select("source", "seen", "json").join(first, "source").select("source", F.col("seen").alias("turn"), F.concat(F.when(F.col("seen") > F.col("first"), ",").otherwise(""), "json").alias("body"))
    ends = [F.struct(F.lit(turn).alias("turn"), x.alias("body")) for turn, x in ((-(1 << 63), before), ((1 << 63) - 1, behind))]
    parts = edges.select("source", F.explode(F.array(*ends)).alias("x")).select("source", "x.*").unionByName(nested)
    release_docs = releases.select("source", "abbreviation", F.concat("abbreviation", F.lit(".json")).alias("path"), body.alias("body"), *TOLD, _joined(_more(start, **own), end).alias("head"))
    return Corpus(verses.drop("m"), editorial, chapter_docs, book_docs, release_docs, violations, parts)


def manifests(corpus: Corpus, base: str) -> dict[str, DataFrame]:
    """Hashes of the final bytes at the three levels, and (group, body) of their listings and checksum maps."""
    out: dict[str, DataFrame] = {}
    for level, docs, group, key in (("translation", corpus.translations, [], "abbreviation"), ("book", corpus.books, ["abbreviation"], "nr"), ("chapter", corpus.chapters, ["abbreviation", "nr"], "chapter")):
        hashed = manifest.hashed(docs, F.concat("body", F.lit("\n")), tx.joined_url(F.lit(base), "path")).drop("body", "head", "name", *TOLD)
        out[level] = hashed
        out[f"{level}_listing"] = manifest.listing(hashed, group, [F.col(key).cast("string"), F.col("url"), F.col("sha")], [key], f"{key}\turl\tsha")
        out[f"{level}_checksums"] = manifest.checksum_map(hashed, group, key)
        out[f"{level}_details"] = manifest.detail_map(hashed, group, key, ["source"])
    return out


#: The sheets of each level, by their file's name, with the columns that their first line names.
SHEETS = {
    "translations": ["#", "language", "translation", "abbreviation", "direction", "filename", "sha"],
    "books": ["#", "language", "translation", "abbreviation", "direction", "name", "filename", "sha"],
    "chapters": ["#", "language", "translation", "abbreviation", "textdirection", "book_nr", "book_name", "filename", "sha"],
}


def pieces(corpus: Corpus, base: str) -> DataFrame:
    """(path, turn, body) of all files of a published tree, without their last line feed, in pieces by turn: the documents
    at the three levels, the hash of each beside it, and in each folder a sheet of what is there, its checksums as a sheet
    and as JSON, and its details as JSON. Translations are listed by name, books as they are first seen, chapters by
    number. A translation is a piece for each book, a sheet a piece for each document that it tells of; others are one. The
    documents of each level are settled."""
    folder = F.array_join(F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1), "/")
    text = lambda c: F.col(c).cast("string")
    turn = F.row_number().over(Window.orderBy("abbreviation")).cast("string")
    one = F.lit(0).cast("bigint").alias("turn")
    url = tx.joined_url(F.lit(base), "path")
    hashed = lambda docs: manifest.hashed(docs, F.concat("body", F.lit("\n")), url)
    parts = corpus.translations.select("source", one, "body") if corpus.parts is None else corpus.parts
    parts = settled(parts.join(corpus.translations.select("source", "path"), "source").select("path", "turn", "body"))
    with small_batches(parts.sparkSession):
        sums = settled(manifest.digests(parts, ["path"], "turn", "body"))
    translations = corpus.translations.drop("body").withColumn("url", url).join(sums, "path")
    levels = [
        ("translations", translations, F.col("abbreviation"), turn, "abbreviation", [*TOLD[:2], "abbreviation", "direction", "key"]),
        ("books", hashed(corpus.books), F.col("seen"), text("nr"), "nr", [*TOLD[:2], "abbreviation", "direction", "name", "key"]),
        ("chapters", hashed(corpus.chapters), F.col("chapter"), text("chapter"), "chapter", [*TOLD[:2], "abbreviation", "direction", "nr", "name", "key"]),
    ]
    out = [parts]
    for name, docs, order, number, key, told in levels:
        body = [c for c in ("body",) if c in docs.columns]
        rows = docs.select("path", *body, "sha", folder.alias("folder"), order.alias("order"), number.alias("number"), text(key).alias("key"), "head", "url", *[c for c in dict.fromkeys(told) if c != "key"])
        rows = settled(rows)  # three readers of a level's plan, of all levels at once, are more than a small driver holds
        out += [rows.select("path", one, "body")] if body else []
        out.append(rows.select(F.regexp_replace("path", "json$", "sha").alias("path"), one, F.col("sha").alias("body")))
        out.append(manifest.sheets(rows, name, SHEETS[name], ["number", *told, "sha"]))
    return reduce(DataFrame.unionByName, out)


def files(corpus: Corpus, base: str) -> DataFrame:
    """(path, body): pieces() as whole files."""
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "body"))), lambda x: x["body"]), "")
    return pieces(corpus, base).groupBy("path").agg(whole.alias("body"))


def publish(corpus: Corpus, root: str, base: str) -> int:
    """Writes pieces() below root; how many files there are. A build with violations isn't to be published."""
    contract.require_none(corpus.violations)
    return trees.write(pieces(corpus, base), root, F.col("path"), F.col("body"), F.col("turn"))


def publish_public(corpus: Corpus, root: str, base: str) -> DataFrame:
    """Makes the tree below root the public part of files() (hashes and sheets); what that changed."""
    rows = files(corpus, base)
    return trees.mirrored(rows.where(tx.is_public_name(F.substring_index("path", "/", -1))), root, F.col("path"), F.col("body"))
