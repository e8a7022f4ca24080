"""More named queries: a corpus build from logs of every kind of record, lookups, settings, inspection and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import codec, markup
from lectern.functions import text as tx
from lectern.operators import layout, lookups, manifest, nesting, quality
from lectern.plans import corpus
from lectern.plans.catalogue import _part_markup, query
from lectern.session import settled, table
from lectern.sources import contract, dims


def _value(c: Column) -> Column:
    raw = c.cast("binary")
    return F.struct(F.regexp_replace(F.base64(raw), "\\s", "").alias("base64"), F.lit("base64").alias("encoding"), F.sha2(raw, 256).alias("sha256"), F.length(raw).cast("bigint").alias("size"))


def _line(kind: str, **facts: Column | str | int) -> Column:
    return F.to_json(F.struct(F.lit(kind).alias("type"), *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in facts.items()]))


#: Settings of each log but the first, which has none.
CONFIG = [("LCSH", "Bible."), ("DistributionLicense", "Public Domain"), ("History_1.0", "first"), ("history_1.1", "second"), ("lcsh", "Bible"), ("Description", ""), ("Lang", "de")]


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of conversations, four of them, as contract.lines gives them, but for what only whole files have.

    A conversation is a book: an introduction to the book, one to its first chapter, its turns as verses, a chapter of
    an introduction alone, entries of other scopes and domains, and, in each tenth, two verses without a place. Each
    log has settings, artifacts (a conversation's turns as chunks, a link), diagnostics and an unknown record."""
    source, conv, n = F.concat(F.lit("s"), (F.col("conv_id") % 4).cast("string")), F.col("conv_id"), F.col("conv_id").cast("string")
    turns = table(spark, sf_dir, "conversations").withColumn("source", source)
    books = turns.select("source", "conv_id").distinct()

    def entry(at: Column | int, domain: str, chapter: int, verse: Column, raw: Column, stripped: Column, scope: str = "verse_key") -> Column:
        where = F.struct(F.lit(scope).alias("type"), F.lit(domain).alias("intro_scope"), (conv % 2 + 1).alias("testament"), (conv + 1).alias("book"), F.lit(chapter).alias("chapter"), verse.alias("verse"), _value(F.concat(F.lit("Conv "), n)).alias("book_name"))
        line = F.struct(F.lit("entry").alias("type"), where.alias("scope"), _value(raw).alias("raw"), _value(F.lit("")).alias("rendered_default"), _value(stripped).alias("stripped"))
        return F.struct(F.lit(at).alias("at") if isinstance(at, int) else at.alias("at"), line.alias("e"))

    none, nowhere = F.lit(""), F.lit(0).cast("bigint")
    title = lambda kind, text: F.concat(F.lit(f'<title type="{kind}" canonical="true">'), text, F.lit("</title>"))
    about = F.concat(F.lit(" About "), n)
    own = [
        entry(-3, "book", 0, nowhere, title("main", F.concat(F.lit("Title "), n)), F.when(conv % 2 == 0, about).otherwise(F.concat(F.lit("Title "), n, F.lit("\n")))),
        entry(-2, "chapter", 1, nowhere, title("chapter", F.lit("One")), none),
        entry(2000, "chapter", 2, nowhere, none, F.lit("Nothing follows")),
        entry(2001, "verse", 1, F.lit(1).cast("bigint"), none, F.lit("of a tree"), "tree_key"),
        entry(2002, "heading", 1, F.lit(1).cast("bigint"), none, F.lit("of no known domain")),
    ]
    bad = [entry(2003, "verse", 0, F.lit(1).cast("bigint"), none, F.lit("x")), entry(2004, "verse", 1, nowhere, none, F.lit("x"))]
    extra = books.select("source", "conv_id", F.explode(F.concat(F.array(*own), F.slice(F.array(*bad), 1, F.when(conv % 10 == 9, 2).otherwise(0)))).alias("x"))
    start = F.when(F.col("turn") % 3 == 0, '<milestone type="x-p"/>').otherwise("")
    raw = F.concat(start, F.when(F.col("turn") == 2, title("sub", F.col("role"))).otherwise(""), F.lit('<w lemma="r:'), "role", F.lit('">'), "role", F.lit("</w>"))
    verses = turns.select("source", "conv_id", entry(F.col("turn").cast("int"), "verse", 1, (F.col("turn") + 1).cast("bigint"), raw, F.concat(F.lit("\n"), "text")).alias("x"))
    placed = extra.union(verses).select("source", (F.row_number().over(Window.partitionBy("source").orderBy("conv_id", "x.at")) - 1).cast("bigint").alias("ordinal"), "x.e")
    entries = placed.select("source", (F.col("ordinal") + 100).alias("line_no"), F.to_json(F.struct("e.*", "ordinal")).alias("line"))
    sources = books.select("source").distinct()
    facts = {k: _value(F.lit(v)) for k, v in (("description", "own words"), ("language", "en"), ("driver", "r"))}
    code = lambda name: F.struct(F.lit(1).alias("code"), F.lit(name).alias("name"))
    module = sources.select("source", F.lit(1).cast("bigint"), _line("module", classification="bible", name=_value(F.upper("source")), **facts, direction=code("ltr"), encoding=code("UTF-8"), markup=code("OSIS")))
    config = sources.where("source <> 's0'").select("source", F.posexplode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in CONFIG])).alias("i", "c")).select("source", (F.col("i") + 2).cast("bigint"), _line("config_entry", ordinal=F.col("i"), name=_value(F.col("c.k")), value=_value(F.col("c.v"))))
    first = turns.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("conv_id", "turn")))
    chunks = first.select("source", (F.col("k") + 1_000_000).alias("line_no"), _line("artifact_chunk", artifact_id=conv, index=F.col("turn"), data=_value(F.col("text"))))
    ends = turns.groupBy("source", "conv_id").agg(F.sum(F.octet_length("text")).alias("size")).select("source", (conv + 2_000_000).alias("line_no"), _line("artifact_end", artifact_id=conv, size=F.col("size"), sha256="0"))
    begins = books.select("source", (conv + 900_000).alias("line_no"), _line("artifact_begin", artifact_id=conv, file_type="regular", path=_value(F.concat(F.lit("a/"), n))))
    link = sources.select("source", F.lit(3_000_000).cast("bigint"), _line("artifact_begin", artifact_id=-1, file_type="symlink", path=_value(F.lit("l")), target=_value(F.lit("a/0"))))
    others = sources.select("source", F.explode(F.array(*[F.struct(F.lit(3_000_001 + i).cast("bigint").alias("line_no"), x.alias("line")) for i, x in enumerate([_line("diagnostic", severity="warning"), _line("diagnostic", severity="info"), _line("zebra"), _line("aardvark")])])).alias("x")).select("source", "x.*")
    lines = module.union(config).union(entries).union(begins).union(chunks).union(ends).union(link).union(others).toDF("source", "line_no", "line")
    return lines.select("source", "line_no", "line", F.lit(True).alias("ended"), F.lit(True).alias("valid"), F.from_json("line", contract.RECORD).alias("record"))


def _dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    made = lambda rows, kind: spark.createDataFrame(rows, kind)
    books = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    name = F.concat(F.lit("Conv "), F.col("conv_id").cast("string"))
    return {
        "modules": made([("S0", "abb"), ("S1", "one")], "module string, abbr string"), "titles": made([("abb", "The First")], "abbr string, title string"), "corrections": made([("en", "eng")], "code string, value string"),
        "languages": made([("en", "English"), ("de", "Deutsch")], "code string, value string"), "directions": made([("de", "RTL")], "code string, value string"),
        "numbers": books.where("conv_id % 5 = 0").select(name.alias("source_name"), (F.col("conv_id") + 500).cast("int").alias("nr")), "names": books.where("conv_id % 3 = 0").select(name.alias("source_name"), F.concat(F.lit("Talk "), F.col("conv_id").cast("string")).alias("name")),
        "overrides": books.where("conv_id % 8 = 0").select(F.lit("abb").alias("abbr"), (F.when(F.col("conv_id") % 5 == 0, F.col("conv_id") + 500).otherwise(F.col("conv_id") + 1)).cast("int").alias("nr"), F.concat(F.lit("Over "), F.col("conv_id").cast("string")).alias("name")),
    }


#: A book's number and name in SQL.
BOOKS = """b AS (SELECT DISTINCT conv_id, 's' || (conv_id % 4) AS source, CASE WHEN conv_id % 5 = 0 THEN conv_id + 500 WHEN conv_id % 2 = 0 THEN conv_id + 1 ELSE conv_id + 40 END AS nr,
  CASE WHEN conv_id % 8 = 0 THEN 'Over ' WHEN conv_id % 3 = 0 THEN 'Talk ' ELSE 'Conv ' END || conv_id AS name FROM conversations)"""
ABBR = "CASE source WHEN 's0' THEN 'abb' WHEN 's1' THEN 'one' ELSE source END"


def _build(spark: SparkSession, sf_dir: str, whole: bool = False) -> corpus.Corpus:
    return corpus.build(settled(_log(spark, sf_dir)), _dims(spark, sf_dir), whole)


@query(f"""
WITH {BOOKS}
SELECT b.source, CAST(nr AS BIGINT) AS nr, CAST(turn + 1 AS BIGINT) AS verse, b.name || ' 1:' || (turn + 1) AS name, ltrim(text, chr(10) || chr(13)) AS text, CASE WHEN turn % 3 = 0 THEN true END AS paragraph, role AS token
FROM conversations JOIN b USING (conv_id)
""")
def build_verses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verses of the logs with all kinds of records: other scopes, domains and places leave none."""
    return _build(spark, sf_dir).verses.select("source", "nr", "verse", "name", "text", "paragraph", F.col("tokens")[0]["token"].alias("token"))


@query(f"""
WITH {BOOKS}, o AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id),
     r AS (SELECT source, conv_id, sum(n + 5 + CASE WHEN conv_id % 10 = 9 THEN 2 ELSE 0 END) OVER (PARTITION BY source ORDER BY conv_id) AS behind FROM b JOIN o USING (conv_id))
SELECT source, CAST(behind - 2 AS BIGINT) AS ordinal, 'chapter' AS rule FROM r WHERE conv_id % 10 = 9
UNION ALL SELECT source, CAST(behind - 1 AS BIGINT), 'verse' FROM r WHERE conv_id % 10 = 9
UNION ALL SELECT DISTINCT source, CAST(NULL AS BIGINT), unnest(['record type aardvark', 'record type zebra']) FROM b
""")
def build_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries without a place, and record types that a build refuses."""
    return _build(spark, sf_dir).violations


@query(f"""
WITH {BOOKS}
SELECT 'chapter' AS level, {ABBR} || '/' || nr || '/1.json' AS path, b.name || ' 1' AS name, CAST(count(*) AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS prose, CAST(NULL AS VARCHAR) AS title,
       'translation,abbreviation,lang,language,direction,encoding,book_nr,book_name,chapter,name,editorial,verses' AS members FROM conversations JOIN b USING (conv_id) GROUP BY ALL
UNION ALL SELECT 'book', {ABBR} || '/' || nr || '.json', b.name, 2, CASE WHEN conv_id % 2 = 0 THEN ' About ' || conv_id END, 'Title ' || conv_id,
       'translation,abbreviation,lang,language,direction,encoding,nr,name,chapters,titles' || CASE WHEN conv_id % 2 = 0 THEN ',introduction' ELSE '' END FROM b
""")
def build_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter documents (those with verses, without titles, verses last) and book documents: their paths, names,
    numbers of children, introductions that aren't a title, titles and members in order."""
    built, at = _build(spark, sf_dir), lambda p: F.get_json_object("body", p)
    shown = lambda level, name, part: [F.lit(level).alias("level"), "path", at(name).alias("name"), F.json_array_length(at(part)).cast("bigint").alias("n"), at("$.introduction[0].text").alias("prose"), at("$.titles[0].text").alias("title"), F.array_join(F.json_object_keys("body"), ",").alias("members")]
    return built.chapters.select(*shown("chapter", "$.name", "$.verses")).unionByName(built.books.select(*shown("book", "$.name", "$.chapters")))


@query(f"""
WITH {BOOKS}
SELECT source, {ABBR} || '.json' AS path, CASE source WHEN 's0' THEN 'The First' ELSE upper(source) END AS translation, CASE source WHEN 's0' THEN 'eng' ELSE 'de' END AS lang,
       CASE source WHEN 's0' THEN 'English' ELSE 'Deutsch' END AS language, CASE source WHEN 's0' THEN 'LTR' ELSE 'RTL' END AS direction, CASE source WHEN 's0' THEN 'own words' ELSE '' END AS description,
       CASE source WHEN 's0' THEN '' ELSE 'Bible' END AS lcsh, CASE source WHEN 's0' THEN '' ELSE 'Public Domain' END AS license, '' AS about, {ABBR} AS own,
       CASE source WHEN 's0' THEN '{{}}' ELSE '{{"history_1.0":"first","history_1.1":"second"}}' END AS history, CAST(count(*) AS BIGINT) AS n_books FROM b GROUP BY source
""")
def build_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translation documents: titles and languages with their defaults, settings that win even if empty, distribution
    fields, and the settings that tell of history."""
    at = lambda p: F.get_json_object("body", f"$.{p}")
    own = {"lcsh": "distribution_lcsh", "license": "distribution_license", "about": "distribution_about", "own": "distribution_abbreviation", "history": "distribution_history"}
    facts = [at(c).alias(c) for c in ("translation", "lang", "language", "direction", "description")] + [at(v).alias(k) for k, v in own.items()]
    return _build(spark, sf_dir).translations.select("source", "path", *facts, F.json_array_length(at("books")).cast("bigint").alias("n_books"))


@query(f"""
WITH {BOOKS}, t AS (SELECT conv_id, turn, role, turn % 3 = 0 AS p, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
     e AS (SELECT conv_id, 0 AS pos, 0 AS k, 'heading' AS type, 'One' AS text, 'chapter' AS heading_type, CAST(1 AS BIGINT) AS place FROM b
           UNION ALL SELECT conv_id, turn, 0, 'heading', role, 'sub', turn + 1 FROM t WHERE turn = 2
           UNION ALL SELECT conv_id, turn, 1, 'paragraph', NULL, NULL, turn + 1 FROM t WHERE p)
SELECT source, CAST(nr AS BIGINT) AS nr, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY pos, k) - 1 AS BIGINT) AS "order", type, text, heading_type, CAST(place AS BIGINT) AS place FROM e JOIN b USING (conv_id)
""")
def build_editorial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layouts of the same build: headings of chapters and verses, and ranges."""
    return _build(spark, sf_dir).editorial.select("source", "nr", "order", "type", "text", "heading_type", F.coalesce("verse", "start").cast("bigint").alias("place"))


@query("""
SELECT 's' || (conv_id % 4) AS source, conv_id AS artifact_id, 'a/' || conv_id AS path, CAST(sum(strlen(text)) AS BIGINT) AS size, sha256(string_agg(text, '' ORDER BY turn)) AS sha FROM conversations GROUP BY conv_id
UNION ALL SELECT DISTINCT 's' || (conv_id % 4), -1, 'l', 3, sha256('a/0') FROM conversations
""")
def log_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files put together from their chunks in order; a link's content is its target."""
    return contract.artifacts(_log(spark, sf_dir)).select("source", "artifact_id", "path", F.length("content").cast("bigint").alias("size"), F.sha2("content", 256).alias("sha"))


@query("""
WITH c AS (SELECT 's' || (conv_id % 4) AS source, count(*) AS turns, count(DISTINCT conv_id) AS convs, count(DISTINCT CASE WHEN conv_id % 10 = 9 THEN conv_id END) AS bad, sum(strlen(text)) AS bytes FROM conversations GROUP BY 1)
SELECT source, CAST(turns + 5 * convs + 2 * bad AS BIGINT) AS entries, CAST(convs AS BIGINT) AS artifacts, CAST(bytes AS BIGINT) AS artifact_bytes, CAST(turns AS BIGINT) AS chunks, CAST(1 AS BIGINT) AS warning, CAST(0 AS BIGINT) AS error, 'aardvark,zebra' AS unknown, CAST(CASE source WHEN 's0' THEN 0 ELSE 7 END AS BIGINT) AS config FROM c
""")
def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type, severities and unknown types of the same logs."""
    count = lambda t: F.coalesce(F.try_element_at("counts", F.lit(t)), F.lit(0))
    return contract.summary(_log(spark, sf_dir)).select("source", "entries", "artifacts", "artifact_bytes", count("artifact_chunk").alias("chunks"), "warning", "error", F.array_join("unknown_types", ",").alias("unknown"), count("config_entry").alias("config"))


@query("""
SELECT DISTINCT 's' || (conv_id % 4) AS source, 'module' AS rule FROM conversations WHERE conv_id % 4 = 1 UNION ALL SELECT DISTINCT 's' || (conv_id % 4), 'classification' FROM conversations WHERE conv_id % 4 = 2
""")
def log_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs whose module or classification isn't the expected one; what isn't asked isn't held against them."""
    expected = spark.createDataFrame([("s0", "S0", "bible"), ("s1", "other", None), ("s2", None, "lexicon"), ("s3", None, None)], "source string, module string, classification string")
    return contract.violations(settled(_log(spark, sf_dir)), expected).where("rule IN ('module', 'classification')").select("source", "rule")


@query("""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'ok ' || doc_id WHEN 1 THEN 'raw ' || doc_id WHEN 2 THEN '' WHEN 3 THEN 'caf' || chr(233) || ' ' || doc_id || chr(8364) ELSE 'two ' || doc_id END AS shown FROM documents
""")
def display_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is shown of an entry: its stripped text, else its markup's plain text (an empty one ends the search), else
    the text with odd bytes mapped one by one."""
    of, n = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    part = lambda a, b="": F.concat(F.lit(a), n, F.lit(b)).cast("binary")
    odd = F.concat(F.lit(bytearray(b"caf\xe9 ")), n.cast("binary"), F.lit(bytearray(b"\x80")))
    stripped = F.when(of == 0, part("ok ")).otherwise(odd)
    raw = F.when(of == 1, part("<w>raw ", "</w>")).when(of == 2, F.lit("").cast("binary")).otherwise(part("<w>"))
    shown = codec.display_text(stripped, raw, part("<q>two ", "</q>"), F.when(of == 3, "Plain").otherwise("OSIS"), markup.plain)
    return table(spark, sf_dir, "documents").select("doc_id", shown.alias("shown"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_nationkey % 2 = 0 THEN 'title ' || c_nationkey END, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END, c_name) AS title FROM customer")
def cust_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles by key, else the description unless it is empty, else the name."""
    titles = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("abbr"), F.concat(F.lit("title "), F.col("n_nationkey").cast("string")).alias("title"))
    rows = table(spark, sf_dir, "customer").withColumn("d", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).otherwise(""))
    return lookups.title(rows, lookups.small(titles), "c_nationkey", "d", "c_name").select("c_custkey", "title")


@query("""
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'n' || c_nationkey ELSE CAST(c_nationkey AS VARCHAR) END AS lang, CASE WHEN c_nationkey % 3 = 0 THEN n_name ELSE '' END AS language, CASE WHEN c_nationkey % 5 = 0 THEN 'up' ELSE upper(c_mktsegment) END AS direction
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def cust_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected code, name and direction, all by the code as given, each with its own default."""
    nation, code = table(spark, sf_dir, "nation"), F.col("n_nationkey").cast("string")
    dim = lambda every, value: lookups.small(nation.where(F.col("n_nationkey") % every == 0).select(code.alias("code"), value.alias("value")))
    rows = table(spark, sf_dir, "customer").withColumn("code", F.col("c_nationkey").cast("string"))
    found = lookups.language(rows, dim(2, F.concat(F.lit("n"), code)), dim(3, F.col("n_name")), dim(5, F.lit("up")), "code", "c_mktsegment")
    return found.select("c_custkey", "lang", "language", "direction")


@query("""
WITH t AS (SELECT conv_id, turn % 3 + 1 AS verse, turn % 2 AS level, turn AS seq, CASE WHEN turn % 4 = 1 THEN NULL WHEN turn % 4 = 2 THEN ' ' ELSE role END AS type, CASE WHEN turn % 7 = 6 THEN ' ' ELSE role END AS text, CASE turn % 5 WHEN 0 THEN true WHEN 1 THEN false END AS canonical FROM conversations),
     n AS (SELECT conv_id, verse, level, seq, coalesce(nullif(trim(type), ''), 'unspecified') AS type, text, coalesce(canonical, false) AS canonical FROM t WHERE trim(text) <> '')
SELECT conv_id, CAST(verse AS BIGINT) AS verse, CAST(seq AS BIGINT) AS seq, type, text, canonical FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, verse, text, type, canonical ORDER BY level, seq) AS rn FROM n) WHERE rn = 1
""")
def heading_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings once each by verse, text, type and flag, a chapter's own before a verse's."""
    turn = F.col("turn")
    kind = F.when(turn % 4 == 1, None).when(turn % 4 == 2, " ").otherwise(F.col("role"))
    titles = table(spark, sf_dir, "conversations").select("conv_id", (turn % 3 + 1).alias("verse"), (turn % 2).alias("level"), turn.alias("seq"), kind.alias("type"), F.when(turn % 7 == 6, " ").otherwise(F.col("role")).alias("text"), F.when(turn % 5 == 0, True).when(turn % 5 == 1, False).alias("canonical"))
    return layout.heading_rows(titles, ["conv_id"]).select("conv_id", F.col("verse").cast("bigint").alias("verse"), F.col("seq").cast("bigint").alias("seq"), "type", "text", "canonical")


@query("""
SELECT p_type, CAST(count(*) AS BIGINT) AS verses, CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS with_tokens, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS with_spans, CAST(sum(n) AS BIGINT) AS tokens, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS spans
FROM (SELECT p_type, len(string_split(p_name, ' ')) AS n FROM part) GROUP BY p_type
""")
def markup_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part_markup(spark, sf_dir).select("p_type", F.col("m.annotated.tokens").alias("tokens"), F.col("m.annotated.spans").alias("spans"))
    return quality.coverage(rows, ["p_type"], "tokens", "spans")


@query("SELECT 'name' AS tag, CAST(count(*) AS BIGINT) AS n FROM part WHERE len(string_split(p_name, ' ')) > 1")
def markup_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.tag_counts(_part_markup(spark, sf_dir).select(F.col("m.annotated.spans").alias("spans")), "spans")


def _files(spark: SparkSession, sf_dir: str, *lines: Column) -> DataFrame:
    """(file, value): a small file for each nation."""
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("books_"), F.lower("n_name"), F.lit(".json")).alias("file"), F.concat(*lines).alias("value"))


@query("""
SELECT lower(n_name) AS abbr, CAST(n_nationkey AS INTEGER) AS nr, n_name AS name FROM nation UNION ALL SELECT lower(n_name), 70, 'Zeta' FROM nation
""")
def override_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of books by number, of files named by abbreviation; what is no number is left out."""
    n = F.col("n_nationkey").cast("string")
    files = _files(spark, sf_dir, F.lit('{"'), n, F.lit('": "'), F.col("n_name"), F.lit('", "none": "x", "70": "Zeta"}'))
    return dims.override_rows(dims.json_entries(files)).select("abbr", "nr", "name")


@query("""
SELECT 'books_' || lower(n_name) || '.json' AS file, CAST(i AS BIGINT) AS ordinal, CASE i WHEN 0 THEN 'z' || n_nationkey ELSE 'a' || n_nationkey END AS module, CASE i WHEN 0 THEN n_name ELSE 'x' END AS abbr FROM nation, (SELECT unnest([0, 1]) AS i)
""")
def module_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a map in the order they are written, which is that of processing."""
    n = F.col("n_nationkey").cast("string")
    files = _files(spark, sf_dir, F.lit('{"z'), n, F.lit('": "'), F.col("n_name"), F.lit('", "a'), n, F.lit('": "x"}'))
    entries = dims.json_entries(files)
    return entries.select("file", F.col("ordinal").cast("bigint").alias("ordinal"), F.col("key").alias("module"), F.col("value").alias("abbr"))


@query("""
SELECT lower(n_name) AS file, unnest(['name', 'on', 'pair', 'off']) AS key, unnest([n_name, '1', 'a=b', CAST(n_regionkey + 2 AS VARCHAR)]) AS value, unnest([false, true, false, false]) AS flag FROM nation
""")
def setting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key=value lines: the first sign parts them, the last of a key wins, comments and blank values don't count."""
    text = [F.lit("# note=1\r\nname=first\n name = "), F.col("n_name"), F.lit("\non=0\non=1\npair=a=b\nname=\nno sign\n#off=1\noff="), (F.col("n_regionkey") + 2).cast("string"), F.lit("\nempty= ")]
    rows = dims.setting_rows(_files(spark, sf_dir, *text))
    return rows.select(F.regexp_extract("file", "^books_(.*)[.]json$", 1).alias("file"), "key", "value", "flag")


@query("""
SELECT lower(n_name) AS file, unnest(CASE n_nationkey % 5 WHEN 1 THEN ['version'] WHEN 2 THEN ['default', 'repeated module'] WHEN 3 THEN ['no modules'] WHEN 4 THEN ['blank module'] ELSE [] END) AS rule FROM nation
""")
def policy_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that allow-lists break."""
    of = F.col("n_nationkey") % 5
    names = F.when(of == 2, '["a", "b", "a"]').when(of == 3, "[]").when(of == 4, '["a", " "]').otherwise('["a", "b"]')
    text = [F.lit('{"schema_version": '), F.when(of == 1, "2").otherwise("1"), F.lit(', "default": "'), F.when(of == 2, "allow").otherwise("deny"), F.lit('", "approved_modules": '), names, F.lit("}")]
    return dims.policy_rows(_files(spark, sf_dir, *text))[1].select(F.regexp_extract("file", "^books_(.*)[.]json$", 1).alias("file"), "rule")


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'b' WHEN 1 THEN '' WHEN 2 THEN 'a' ELSE '' END AS missing, CASE p_partkey % 4 WHEN 3 THEN 'd' ELSE '' END AS extra FROM part
""")
def key_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that are missing, and those beyond the allowed ones."""
    of = F.col("p_partkey") % 4
    keys = F.json_object_keys(F.when(of == 0, '{"a": 1}').when(of == 1, '{"b": 1, "a": 2, "c": 3}').when(of == 2, '{"b": 1}').otherwise('{"d": 1, "a": 2, "b": 3}'))
    found = lookups.key_differences(keys, ["a", "b"], ["a", "b", "c"])
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(found["missing"], ",").alias("missing"), F.array_join(found["extra"], ",").alias("extra"))


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN 0 ELSE 0 END AS number, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS public FROM part
""")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered files by their number, others 0; manifest files that may leave the tree."""
    of = F.col("p_partkey") % 3
    name = F.when(of == 0, F.col("p_size").cast("string")).when(of == 1, F.concat("p_brand", F.lit(".sha"))).otherwise("chapters.json.old")
    shown = F.when(of == 0, "chapters.json").otherwise(name)
    return table(spark, sf_dir, "part").select("p_partkey", manifest.integer_name(name).cast("int").alias("number"), tx.is_public_name(shown).alias("public"))


@query("""
WITH f AS (SELECT source, max(strlen(text)) AS most, sum(CASE WHEN source LIKE 'c%' THEN 0 ELSE strlen(text) END) AS size FROM documents GROUP BY source)
SELECT source, CASE WHEN size = 0 THEN 'empty' WHEN most >= 100000 THEN 'size' END AS rule FROM f WHERE size = 0 OR most >= 100000 UNION ALL SELECT 'nowhere', 'missing'
""")
def size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots without a file, with empty ones alone, or with one that is too large."""
    files = table(spark, sf_dir, "documents").select("source", F.when(F.col("source").startswith("c"), 0).otherwise(F.octet_length("text")).alias("size"))
    return quality.size_gate(files.select("source").union(spark.createDataFrame([("nowhere",)], "source string")), files, "source", "size", 100_000)


@query("""
WITH v AS (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
SELECT conv_id, CAST(turn + 1 AS BIGINT) AS verse, 'empty text' AS rule FROM v WHERE (conv_id + turn) % 7 = 0
UNION ALL SELECT conv_id, turn + 1, 'leading line end' FROM v WHERE (conv_id + turn) % 7 = 1
UNION ALL SELECT conv_id, turn + 1, 'tokens without spans' FROM v WHERE (conv_id + turn) % 7 = 2 AND conv_id % 3 > 0
UNION ALL SELECT DISTINCT conv_id, CAST(NULL AS BIGINT), 'no tokens' FROM v WHERE conv_id % 3 = 0
""")
def verse_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that planted verses break."""
    of, has = (F.col("conv_id") + F.col("turn")) % 7, F.col("conv_id") % 3 > 0
    one = F.array(F.struct(F.lit(1).alias("x")))
    verses = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).cast("bigint").alias("verse"), F.when(of == 0, "").when(of == 1, "\nx").otherwise("x").alias("text"), F.when(has, one).alias("tokens"), F.when(of != 2, one).alias("spans"))
    return quality.verse_violations(verses, ["conv_id"]).select("conv_id", "verse", "rule")


@query("""
WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, 'order' AS rule FROM c WHERE conv_id % 5 = 1 UNION ALL SELECT conv_id, 'type' FROM c WHERE conv_id % 5 = 2 UNION ALL SELECT conv_id, 'first verse' FROM c WHERE conv_id % 5 = 3
UNION ALL SELECT conv_id, 'last verse' FROM c WHERE conv_id % 5 = 4
""")
def editorial_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that planted layouts break: a heading and one range each, with one thing changed."""
    verses = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).cast("bigint").alias("verse"))
    of, ends = F.col("conv_id") % 5, verses.groupBy("conv_id").agg(F.max("verse").alias("n"))
    none = F.lit(None).cast("bigint")
    head = F.struct(F.lit(0).cast("bigint").alias("order"), F.when(of == 2, "section").otherwise("heading").alias("type"), F.lit(1).cast("bigint").alias("verse"), none.alias("start"), none.alias("end"))
    body = F.struct(F.when(of == 1, 2).otherwise(1).cast("bigint").alias("order"), F.lit("paragraph").alias("type"), none.alias("verse"), F.when(of == 3, 2).otherwise(1).cast("bigint").alias("start"), F.when(of == 4, F.col("n") + 1).otherwise(F.col("n")).alias("end"))
    entries = ends.select("conv_id", F.explode(F.array(head, body)).alias("e")).select("conv_id", "e.*")
    return quality.editorial_violations(entries, verses, ["conv_id"]).select("conv_id", "rule")


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'type' WHEN 1 THEN 'members' WHEN 2 THEN 'anchor' END AS rule FROM orders WHERE o_orderkey % 4 < 3
""")
def editorial_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout entries whose members aren't exactly those of their type."""
    of = F.col("o_orderkey") % 4
    head = '{"order": 0, "type": "heading", "anchor": {"verse": 1, "edge": "before"}, "text": "t", "heading_type": "x", "canonical": true}'
    json = F.when(of == 0, '{"type": "section"}').when(of == 1, '{"order": 1, "type": "paragraph", "start": 1, "end": 2, "text": ""}').when(of == 2, head.replace('"edge"', '"side"')).otherwise(head)
    return quality.member_violations(table(spark, sf_dir, "orders").withColumn("json", json), ["o_orderkey"], "json")


@query("""
SELECT o_orderkey, unnest(CASE o_orderkey % 5 WHEN 0 THEN ['forbidden'] WHEN 1 THEN ['titles'] WHEN 2 THEN ['number'] WHEN 3 THEN ['titles', 'no verses'] ELSE [] END) AS rule FROM orders
""")
def chapter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that planted chapter documents break: members of sources at any depth, titles beside the layout, another
    number, no verses."""
    of, n = F.col("o_orderkey") % 5, F.col("o_orderkey").cast("string")
    inner = F.when(of == 0, '[{"verse": 1, "x": {"source_contract": {}}}]').when(of == 1, '[{"verse": 1, "titles": []}]').when(of == 3, "[]").otherwise('[{"verse": 1, "text": "\\"source\\": in a text"}]')
    more = F.when(of == 3, '"titles": [], ').otherwise("")
    json = F.concat(F.lit('{"chapter": '), F.when(of == 2, "0").otherwise(n), F.lit(", "), more, F.lit('"verses": '), inner, F.lit("}"))
    return quality.document_violations(table(spark, sf_dir, "orders").withColumn("json", json), ["o_orderkey"], "o_orderkey", "json")


@query("""
SELECT o_orderkey, unnest(['a.chapterTitle', 'heading_type', 'x[1].sectionHead']) AS field, unnest(['{"source":1}', '"' || o_orderkey || '"', '2']) AS value FROM orders
""")
def semantic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that tell of headings, by parts of their names, at any depth but within tokens, spans and sources."""
    json = F.concat(F.lit('{"tokens": {"title": 1}, "a": {"chapterTitle": {"source": 1}}, "heading_type": "'), F.col("o_orderkey").cast("string"), F.lit('", "x": [{"source": {"heading": 3}}, {"sectionHead": 2}], "plain": 5}'))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(quality.semantic_fields(json, "heading")).alias("f"))
    return rows.select("o_orderkey", "f.field", "f.value")


@query("""
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'paragraph' WHEN 1 THEN 'heading' WHEN 2 THEN 'paragraph' WHEN 3 THEN 'heading' END AS kind, p_partkey % 5 IN (0, 2) AS para, p_partkey % 5 IN (1, 3) AS head FROM part
""")
def span_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of spans by tag and type, and of members by name."""
    of = (F.col("p_partkey") % 5).cast("int")
    pick = lambda *x: F.get(F.array(*[F.lit(v) for v in x]), of)
    name = pick("Pil-crow", "chapterTitle", "x_paragraphs", "Section Head", "q")
    kind = quality.span_kind(pick("P", "title", "seg", "hi", "q"), pick(None, None, "x-paragraph", "sub-heading", "x"))
    return table(spark, sf_dir, "part").select("p_partkey", kind.alias("kind"), quality.tells_of(name, "paragraph").alias("para"), quality.tells_of(name, "heading").alias("head"))


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'missing' WHEN 1 THEN 'name' END AS rule FROM nation WHERE n_nationkey % 3 < 2")
def target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted rows that aren't there, or have none of their names."""
    nation, key = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    own = tx.normalized_name(F.col("n_name"))
    wanted = nation.select("n_nationkey", F.array(F.lit("other"), F.when(key % 3 == 1, "no").otherwise(own)).alias("aliases"))
    return quality.misnamed(wanted, nation.where(key % 3 > 0).select("n_nationkey", F.initcap("n_name").alias("name")), ["n_nationkey"], "name", "aliases")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)")
def listed_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a file (an order) and a folder (an order of even number)."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return nesting.with_file_and_folder(table(spark, sf_dir, "customer").select("c_custkey"), orders, orders.where("o_orderkey % 2 = 0"), ["c_custkey"])


@query("""
SELECT conv_id, CAST(turn // 3 + 1 AS BIGINT) AS chapter, CAST(turn % 3 + 1 AS BIGINT) AS verse, text FROM conversations WHERE turn // 3 < 2
""")
def grid_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts at the places of a grid of two chapters of three verses each, without those that have none."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.floor(F.col("turn") / 3).cast("int").alias("c"), (F.col("turn") % 3 + 1).cast("int").alias("verse"), "text").withColumn("chapter", F.col("c") + 1)
    grid = nesting.cells(turns.select("conv_id").distinct().select("conv_id", F.lit(2).alias("n"), F.array(F.lit(3), F.lit(3)).alias("m")), ["conv_id"], "n", "m")
    return nesting.scanned(grid, turns.drop("c"), ["conv_id"], "text").select("conv_id", F.col("chapter").cast("bigint").alias("chapter"), F.col("verse").cast("bigint").alias("verse"), "text")


@query("SELECT o_custkey, coalesce(arg_min(o_orderkey % 2 = 0, (o_orderdate, o_orderkey)), false) AS flag FROM orders GROUP BY o_custkey")
def first_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first order says for all of a customer's."""
    return nesting.first_sample(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderkey") % 2 == 0)


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'local ' WHEN c_custkey % 4 < 3 THEN 'remote ' ELSE 'default ' END || c_custkey AS name FROM customer
""")
def first_valid_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first valid of a local value, a remote one, and a default."""
    key = F.col("c_custkey")
    of = lambda rank, name, valid: F.struct(F.lit(rank).alias("rank"), F.concat(F.lit(name), key.cast("string")).alias("name"), valid.alias("ok"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(of(0, "local ", key % 4 == 0), of(1, "remote ", key % 4 < 3), of(2, "default ", F.lit(True)))).alias("x")).select("c_custkey", "x.*")
    return lookups.first_valid(rows, "c_custkey", "rank", F.col("ok")).select("c_custkey", "name")


@query("""
SELECT o_orderkey, strftime(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 25 HOUR, '%A %d-%B, %Y') AS shown, regexp_extract('v1.' || o_custkey || '.' || o_orderkey || '-rc', '(\\d+\\.\\d+\\.\\d+)', 1) AS version FROM orders
""")
def long_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as dates in a zone two hours ahead, and versions within texts."""
    late = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 23 HOURS")
    text = F.concat(F.lit("v1."), F.col("o_custkey").cast("string"), F.lit("."), F.col("o_orderkey").cast("string"), F.lit("-rc"))
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.long_date(late, "Africa/Harare").alias("shown"), tx.version_of(text).alias("version"))


@query("""
SELECT doc_id, CASE doc_id % 6 WHEN 1 THEN 'utf8' WHEN 2 THEN 'size' WHEN 3 THEN 'sha256' WHEN 4 THEN 'members' END AS rule, CASE doc_id % 6 WHEN 1 THEN 'utf8' WHEN 2 THEN 'size' WHEN 3 THEN 'sha256' WHEN 4 THEN 'members' WHEN 5 THEN 'members' END AS nested FROM documents
""")
def byte_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that byte values break, as typed values and at any depth of JSON; utf8 need not be there, and other members
    may not."""
    of = F.col("doc_id") % 6
    value = _value(F.col("text"))
    changed = F.struct(
        value["base64"].alias("base64"), value["encoding"].alias("encoding"), F.when(of == 3, "0").otherwise(value["sha256"]).alias("sha256"), F.when(of == 2, value["size"] + 1).when(of != 4, value["size"]).alias("size"), F.when(of == 1, "other").alias("utf8"), F.when(of == 5, 1).alias("more")
    )
    json = F.to_json(F.struct(F.array(F.struct(changed.alias("x"))).alias("deep")))
    rows = table(spark, sf_dir, "documents").select("doc_id", changed.alias("v"), json.alias("json")).select("doc_id", codec.byte_value_rule(F.col("v")).alias("rule"), codec.envelope_faults("json").alias("f"))
    return rows.select("doc_id", "rule", F.get("f", F.lit(0))["rule"].alias("nested"))
