import json

from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import lookups, quality, sequences
from lectern.sources import dims, files, releases, trees


def test_dimensions(spark, tmp_path):
    (tmp_path / "map.json").write_text(json.dumps({"B": "b", "A": "a"}))
    assert [tuple(r) for r in dims.ordered(spark, str(tmp_path / "map.json")).orderBy("ordinal").collect()] == [(0, "B", "b"), (1, "A", "a")]
    (tmp_path / "books_x.json").write_text(json.dumps({"1": "One", "no": "N"}))
    assert [tuple(r) for r in dims.overrides(spark, str(tmp_path)).collect()] == [("x", 1, "One")]
    (tmp_path / "conf").write_text("# a=b\n a = 1 \nb=x=y\nb=\na=2\nc\nd=1\n")
    assert {r["key"]: (r["value"], r["flag"]) for r in dims.settings(spark, str(tmp_path / "conf")).collect()} == {"a": ("2", False), "b": ("x=y", False), "d": ("1", True)}


def test_policy(spark, tmp_path):
    at = tmp_path / "policy.json"
    at.write_text(json.dumps({"schema_version": 1, "default": "deny", "approved_modules": ["A", "B"]}))
    approved, broken = dims.policy(spark, str(at))
    assert [r["module"] for r in approved.orderBy("ordinal").collect()] == ["A", "B"] and broken.isEmpty()
    at.write_text(json.dumps({"schema_version": 2, "default": "allow", "approved_modules": ["A", "A", " "]}))
    assert {r["rule"] for r in dims.policy(spark, str(at))[1].collect()} == {"version", "default", "blank module", "repeated module"}


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("a/1.json", '{"x":1}'), ("a/b/2.json", "{}")], "path string, body string")
    assert trees.write(rows, str(tmp_path / "out"), F.col("path"), F.col("body")) == 2
    assert (tmp_path / "out/a/1.json").read_text() == '{"x":1}\n'
    assert sorted((r["path"], r["size"]) for r in files.listing(spark, str(tmp_path / "out")).collect()) == [("a/1.json", 8), ("a/b/2.json", 3)]
    assert sorted(r["name"] for r in files.documents(spark, str(tmp_path / "out"), ["2"]).collect()) == ["1"]


def test_archive_conflicts(spark):
    rows = [("z", "a", 1, "h", False), ("y", "a", 1, "g", False), ("z", "../b", 1, "h", False), ("z", "c", 9, "h", True)]
    got = files.archive_conflicts(spark.createDataFrame(rows, "archive string, path string, size long, sha256 string, is_link boolean"), 2, 10)
    assert {(r["archive"], r["rule"]) for r in got.collect()} == {("z", "path"), ("y", "conflict"), ("z", "link"), ("z", "members"), ("z", "size")}


def test_text_functions(spark):
    rows = spark.createDataFrame([("\x1c a b\xa0", "tag v1.2.3-x", "/a", "/ab")], "t string, v string, r string, p string")
    got = rows.select(tx.strip(F.col("t")), tx.collapse(F.col("t")), tx.version_of(F.col("v")), tx.is_within(F.col("p"), F.col("r")), tx.is_within(F.lit("/a/b"), F.col("r"))).first()
    assert tuple(got) == ("a b", "a b", "1.2.3", False, True)
    paths = ["a/b", "", "/a", "a/../b", "a//b", ".", "a\\b", "..a/b", None]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(tx.is_safe_path(F.col("p"))).collect()
    assert [r[0] for r in got] == [True, False, False, False, False, False, False, True, False]
    names = ["x.sha", "books.json", "books.txt"]
    assert [r[0] for r in spark.createDataFrame([(p,) for p in names], "p string").select(tx.is_public_name(F.col("p"))).collect()] == [True, True, False]


def test_key_sets_and_fallbacks(spark):
    got = spark.range(1).select(lookups.key_differences(F.array(F.lit("a"), F.lit("z")), ["a", "b"])).first()[0]
    assert (got["missing"], got["extra"]) == (["b"], ["z"])
    rows = spark.createDataFrame([("m", 0, False), ("m", 1, True), ("m", 2, True)], "k string, rank int, ok boolean")
    assert lookups.first_valid(rows, "k", "rank", F.col("ok")).first()["rank"] == 1


def test_quality(spark):
    verses = spark.createDataFrame([("c", 1, "x", ["t"], None), ("c", 3, "\ny", None, None), ("d", 1, "", None, None)], "chapter string, verse int, text string, tokens array<string>, spans array<string>")
    got = {(r["chapter"], r["rule"]) for r in quality.verse_violations(verses, ["chapter"]).collect()}
    assert got == {("c", "number"), ("c", "leading line end"), ("c", "tokens without spans"), ("d", "empty text"), ("d", "no tokens")}
    assert tuple(quality.coverage(verses, ["chapter"], "tokens", "spans").where("chapter = 'c'").first())[1:] == (2, 1, 0, 1, 0)
    entries = spark.createDataFrame([("c", 0, "paragraph", None, 1, 1), ("c", 2, "paragraph", None, 3, 2), ("c", 3, "odd", None, None, None)], "chapter string, order int, type string, verse int, start int, end int")
    got = {r["rule"] for r in quality.editorial_violations(entries, verses, ["chapter"]).collect()}
    assert {"order", "type", "contiguous", "last verse", "range"} <= got


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "g string, at int, start boolean, n int, t string")
    from lectern.operators.layout import covering_ranges

    assert covering_ranges(rows, ["g"], "at", F.col("start")).collect() == []
    assert sequences.numbering_gaps(rows, ["g"], ["at"], "n").collect() == []
    assert sequences.merge_runs(rows, ["g"], "at", ["n"], "t").collect() == []


def zipped(*rows):
    import io
    import zipfile

    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body, *attr in rows:
            info = zipfile.ZipInfo(name)
            info.external_attr = attr[0] if attr else 0
            z.writestr(info, body)
    return data.getvalue()


def test_archives(spark, tmp_path, monkeypatch):
    import hashlib

    monkeypatch.setattr(files, "HELD", 600)
    broken = bytearray(zipped(("mods.d/x", "abc" * 500)))
    broken[40] ^= 255
    made = {
        "a.zip": zipped(("mods.d/", ""), ("d//f", b"\xff\x00"), ("./e", "1"), ("empty", "")), "b.zip": zipped(("d/f", b"\xff\x00"), ("e", "2"), ("l", "/etc", 0o120777 << 16)), "c.zip": zipped(("/abs", "x"), ("../up", "x"), ("a\\b", "x"), (".", "x")),
        "d.zip": b"no archive", "e.zip": bytes(broken), "f.zip": zipped(*[(f"n{i}", "") for i in range(6)]), "g.zip": zipped(("big", "x" * 3000)),
    }
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    found = files.members(files.archives(spark, str(tmp_path)).withColumn("archive", F.substring_index("archive", "/", -1)), 5, 2000)
    got = {tuple(r) for r in files.refusals(found).collect()}
    assert got == {("b.zip", "l", "link"), *[("c.zip", p, "path") for p in ("/abs", "../up", "a\\b", ".")], ("d.zip", None, "unreadable"), ("e.zip", "mods.d/x", "unreadable"), ("f.zip", None, "members"), ("g.zip", None, "size"), ("a.zip", "e", "conflict"), ("b.zip", "e", "conflict")}
    tree = {r["path"]: (r["archive"], r["size"], bytes(r["content"]), r["sha256"]) for r in files.merged(found).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert tree == {"d/f": ("a.zip", 2, b"\xff\x00", sha(b"\xff\x00")), "e": ("a.zip", 1, b"1", sha(b"1")), "empty": ("a.zip", 0, b"", sha(b""))}
    assert [r["rule"] for r in files.refusals(found.where("archive = 'b.zip' AND kind = 'file'")).collect()] == ["configuration"]
    assert files.members(files.archives(spark, str(tmp_path)).limit(0)).collect() == []


def test_releases(spark):
    made = lambda kind, *rows: spark.createDataFrame(list(rows), kind)
    good = {"schema": "p/v1", "repository": "a/b", "version": "v1.2.3-rc.1"}
    cases = [(good, []), (good | {"version": "latest"}, []), (good | {"more": 1}, ["members"]), (good | {"schema": "p/v2"}, ["schema"]), (good | {"repository": "a"}, ["repository"]), (good | {"version": "1.2"}, ["version"]), (good | {"version": 5}, ["version"]), ([1], ["JSON", "schema", "repository", "version"])]
    rows = made("source string, body string", *[(str(i), json.dumps(c)) for i, (c, _) in enumerate(cases)], ("x", "{"))
    got = {r["source"]: r for r in releases.policies(rows, "p/v1").collect()}
    assert [got[str(i)]["rules"] for i in range(len(cases))] == [r for _, r in cases] and got["0"]["version"] == "1.2.3-rc.1" and got["1"]["version"] == "latest" and "JSON" in got["x"]["rules"]
    body = {"tag_name": "v1.2.3", "id": 7}
    cases = [(body, "latest", []), (body, "1.2.3", []), (body, "1.2.4", ["version"]), (body | {"tag_name": "one"}, "latest", ["tag"]), (body | {"draft": True}, "latest", ["unfinished"]), (body | {"prerelease": True}, "latest", ["unfinished"]), (body | {"id": "7"}, "latest", ["id"]), ({}, "latest", ["tag", "id"])]
    got = {r["source"]: r["rules"] for r in releases.resolved(made("source string, body string, requested string", *[(str(i), json.dumps(b), q) for i, (b, q, _) in enumerate(cases)])).collect()}
    assert [got[str(i)] for i in range(len(cases))] == [r for *_, r in cases]
    assert releases.tar_members(made("archive string, content binary"), "a/b").collect() == []
    broken = made("archive string, content binary", ("a", bytearray(b"no tar")), ("b", None))
    assert {(r["archive"], r["rule"]) for r in releases.executables(broken, releases.tar_members(broken, "a/b")).collect()} == {("a", "unreadable"), ("b", "unreadable")}
