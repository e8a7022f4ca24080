import hashlib
import json

import pytest
from logs import entry, log, records

from lectern.functions.codec import mixed_text
from lectern.plans import corpus
from lectern.sources import contract

DIMS = {
    "modules": ("module string, abbr string", [("Mod", "mod1")]),
    "titles": ("abbr string, title string", [("other", "Other")]),
    "corrections": ("code string, value string", [("yy", "zz")]),
    "languages": ("code string, value string", [("yy", "Ywhy")]),
    "directions": ("code string, value string", [("yy", "RTL")]),
    "numbers": ("source_name string, nr int", [("Gen", 1)]),
    "names": ("source_name string, name string", [("Gen", "Genesis")]),
    "overrides": ("abbr string, nr int, name string", [("mod1", 40, "Forty")]),
}
RAW = '<milestone type="x-p"/><title type="main">Head</title><w lemma="s:1">two</w> <name type="x"><w>words</w></name>'


@pytest.fixture(scope="module")
def made(spark):
    entries = [
        entry(0, "module", "Gen", 0, 0, "About", "About"),
        entry(1, "chapter", "Gen", 1, 0, '<title type="chapter">Start</title>', "Start"),
        entry(2, "verse", "Gen", 1, 1, "plain one", "\r\nplain one"),
        entry(3, "verse", "Gen", 1, 2, RAW, "two words"),
        entry(4, "verse", "Gen", 1, 3, "[]", "[] "),
        entry(5, "verse", "Matt", 2, 1, b"\x93caf\xe9\x94", b"\x93caf\xe9\x94", testament=2),
        entry(6, "chapter", "Gen", 9, 0, "Only prose", "Only prose"),
        entry(7, "verse", "Nope", 1, 1, "x", testament=3),
        entry(8, "book", "Empty", 1, 0, "nothing here", testament=1, nr=7),
    ]
    text = log(records(entries, config=[("Lang", "xx"), ("lang", "yy"), ("History_1", "h"), ("Version", "3")]))
    files = spark.createDataFrame([("s", bytearray(text.encode()))], "source string, content binary")
    dims = {k: spark.createDataFrame(rows, schema) for k, (schema, rows) in DIMS.items()}
    got = corpus.build(contract.lines(files), dims)
    for name in ("chapters", "books", "translations"):  # read more than once
        rows = getattr(got, name)
        setattr(got, name, spark.createDataFrame(rows.collect(), rows.schema))
    return got


def test_build(made):
    got = made
    assert [tuple(r) for r in got.violations.collect()] == [("s", 7, "book")]
    chapters = {r["path"]: json.loads(r["body"]) for r in got.chapters.collect()}
    assert sorted(chapters) == ["mod1/1/1.json", "mod1/40/2.json"]
    first = chapters["mod1/1/1.json"]
    assert (first["translation"], first["abbreviation"], first["lang"], first["language"], first["direction"], first["encoding"]) == ("A test", "mod1", "zz", "Ywhy", "RTL", "UTF-8")
    assert (first["book_nr"], first["book_name"], first["chapter"], first["name"]) == (1, "Genesis", 1, "Genesis 1")
    assert "titles" not in first and [v["text"] for v in first["verses"]] == ["plain one", "two words"]
    second = first["verses"][1]
    assert second["paragraph"] is True and second["name"] == "Genesis 1:2" and "paragraph" not in first["verses"][0]
    assert second["tokens"] == [{"token": "two", "lemma": {"s": ["1"]}, "word_start": 1, "word_end": 1}, {"token": "words", "word_start": 2, "word_end": 2}]
    assert second["spans"] == [{"tag": "name", "span": "words", "attrs": {"type": "x"}, "token_start": 1, "token_end": 1, "word_start": 2, "word_end": 2}]
    heading = lambda order, verse, text, kind: {"order": order, "type": "heading", "anchor": {"verse": verse, "edge": "before"}, "text": text, "heading_type": kind, "canonical": False}
    span = lambda order, a, b: {"order": order, "type": "paragraph", "start": a, "end": b}
    assert first["editorial"] == [heading(0, 1, "Start", "chapter"), span(1, 1, 1), heading(2, 2, "Head", "main"), span(3, 2, 2)]
    assert chapters["mod1/40/2.json"]["book_name"] == "Forty" and chapters["mod1/40/2.json"]["verses"][0]["text"] == "“caf\xe9”"

    books = {r["path"]: json.loads(r["body"]) for r in got.books.collect()}
    assert sorted(books) == ["mod1/1.json", "mod1/40.json"]
    assert [c["chapter"] for c in books["mod1/1.json"]["chapters"]] == [1, 9]
    lone = books["mod1/1.json"]["chapters"][1]
    assert lone["verses"] == [] and lone["introduction"] == [{"text": "Only prose"}]
    for path, body in chapters.items():
        book = books[path.rsplit("/", 1)[0] + ".json"]
        assert next(c for c in book["chapters"] if c["chapter"] == body["chapter"])["verses"] == body["verses"]

    whole = json.loads(got.translations.first()["body"])
    assert [b["nr"] for b in whole["books"]] == [1, 40] and whole["books"][0]["chapters"] == books["mod1/1.json"]["chapters"]
    assert whole["introduction"] == [{"text": "About"}] and whole["description"] == "A test"
    assert whole["distribution_version"] == "3" and whole["distribution_history"] == {"history_1": "h"} and whole["distribution_about"] == "" and whole["distribution_abbreviation"] == "mod1"


def test_manifests_hash_the_final_bytes(made):
    got = made
    out = corpus.manifests(got, "https://x/v3")
    bodies = {r["path"]: r["body"] for r in got.chapters.collect()}
    for r in out["chapter"].collect():
        assert r["sha"] == hashlib.sha1((bodies[r["path"]] + "\n").encode()).hexdigest() and r["url"] == "https://x/v3/" + r["path"]
    sums = {r["nr"]: json.loads(r["body"]) for r in out["chapter_checksums"].collect()}
    assert sorted(sums) == [1, 40] and list(sums[40]) == ["2"]
    assert out["book_listing"].first()["body"].startswith("nr\turl\tsha\n1\t")


def test_mixed_text():
    assert mixed_text("é".encode() + b"\x93\x81") == "é“\x81"


def test_inspection(spark, made):
    from lectern.plans import inspection

    group = ["source", "nr", "chapter"]
    wanted = spark.createDataFrame([("s", 1, 1), ("s", 1, 2)], "source string, nr long, chapter long")
    got = {tuple(r) for r in inspection.violations(made.verses, made.editorial, wanted, made.chapters, group).collect()}
    assert got == {("s", 1, 2, "missing chapter"), ("s", 40, 2, "no tokens")}
    files = made.chapters.selectExpr("source AS root", "path", "length(body) AS size")
    out = inspection.reports(made.verses, files, group)
    assert [tuple(r) for r in out["tags"].collect()] == [("name", 1)]
    assert {r["root"]: r["files"] for r in out["sizes"].collect()} == {"s": 2, None: 2}
    assert out["representative"].where("nr = 1").first()["verse"] == 2
    assert out["profiles"].where("nr = 40").first()["fields"] == "name,ordinal,text,verse"


def test_gates(spark):
    from pyspark.sql import functions as F

    from lectern.functions.text import is_permanent_failure
    from lectern.operators import quality

    files = spark.createDataFrame([("a", 5), ("b", 0), ("c", 100)], "root string, size long")
    roots = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "root string")
    assert {tuple(r) for r in quality.size_gate(roots, files, "root", "size", 100).collect()} == {("b", "empty"), ("c", "size"), ("d", "missing")}
    rows = spark.createDataFrame([("! [Remote Rejected] x",), ("timed out",)], "t string")
    assert [r[0] for r in rows.select(is_permanent_failure(F.col("t"))).collect()] == [True, False]
    assert spark.range(1).select(quality.forbidden_members(F.lit('{"a": [{"source" : 1}], "b": "\\"source\\":"}')).alias("x")).first()["x"] == ["source"]
