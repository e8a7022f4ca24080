"""Files that are written in pieces and read chunk by chunk."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lectern.functions.members import Members
from lectern.plans import corpus, published
from lectern.sources import trees

TOLD = "language string, translation string, direction string, head string"


@pytest.mark.parametrize("root", ["{}", "viewfs://pieces/in"])
def test_pieces_are_joined_in_order(spark, tmp_path, root):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pieces.link./in", f"file://{tmp_path}")
    root = root.format(tmp_path) + "/t"
    rows = [("a/1", n, f"{n},") for n in (-(1 << 63), *range(300), (1 << 63) - 1)] + [("b", 5, None), ("b", 7, "é\n"), ("c", 0, None)]
    put = lambda rows: trees.write(spark.createDataFrame(rows, "path string, turn long, body string").repartition(7), root, F.col("path"), F.col("body"), F.col("turn"))
    assert put(rows[::-1]) == 3
    want = {"a/1": ("".join(x[2] for x in rows[:302]) + "\n").encode(), "b": "é\n\n".encode(), "c": b"\n"}
    assert {r["path"]: bytes(r["content"]) for r in trees.contents(spark, root).collect()} == want
    trees.CHUNK, chunk = 7, trees.CHUNK
    try:
        found = trees.folded(spark, root, lambda path: [path, b""], lambda s, x: s.__setitem__(1, s[1] + x), lambda s: (s[0], s[1]), "name string, all binary").collect()
    finally:
        trees.CHUNK = chunk
    assert {r["path"]: bytes(r["all"]) for r in found} == want and all(r["path"] == r["name"] for r in found)
    with pytest.raises(ValueError, match="repeated"):
        put([("d", 1, "x"), ("d", 1, "y")])


def test_a_translation_is_published_without_being_a_value(spark, tmp_path):
    docs = lambda kind, *rows: spark.createDataFrame(list(rows), kind)
    books = docs(f"source string, abbreviation string, nr long, seen long, path string, body string, name string, {TOLD}", *[("s", "kj", n, 100 - n, f"kj/{n}.json", f'{{"nr":{n}}}', f"B{n}", "E", "K", "LTR", f'{{"nr":{n}}}') for n in range(1, 31)])
    whole = docs(f"source string, abbreviation string, path string, {TOLD}", ("s", "kj", "kj.json", "E", "K", "LTR", '{"a":1}')).withColumn("body", F.raise_error(F.lit("the whole body is made")).cast("string"))
    parts = docs("source string, turn long, body string", ("s", -9, '{"abbreviation":"kj","books":['), *[("s", 100 - n, ("," if n < 30 else "") + f'{{"nr":{n}}}') for n in range(1, 31)], ("s", 999, '],"x":1}'))
    built = corpus.Corpus(None, None, books.withColumn("chapter", F.lit(1)).limit(0), books, whole, docs("rule string"), parts)
    assert corpus.publish(built, str(tmp_path / "t"), "https://h") == 30 * 2 + 2 + 8
    got = (tmp_path / "t" / "kj.json").read_bytes()
    assert [b["nr"] for b in json.loads(got)["books"]] == [*range(30, 0, -1)] and got.endswith(b"}\n")
    assert (tmp_path / "t" / "kj.sha").read_text() == hashlib.sha1(got).hexdigest() + "\n" == json.loads((tmp_path / "t" / "checksum.json").read_text())["kj"] + "\n"
    sheets = corpus.pieces(built, "https://h").where("path LIKE 'kj/books%' OR path LIKE 'kj/checksum%'").groupBy("path").count()
    assert {r["count"] for r in sheets.collect()} == {30}  # a folder's sheet isn't one value either
    assert list(json.loads((tmp_path / "t" / "kj" / "books.json").read_text())) == [str(n) for n in range(30, 0, -1)]


def test_pieces_of_a_build_are_its_bodies(spark):
    from lectern.plans import checks

    built = checks._build(spark, "/root/testdata/sf0.001", whole=True)
    files = {r["path"]: r["body"] for r in corpus.files(built, "https://h").collect()}
    bodies = {r["path"]: r["body"] for r in built.translations.collect()}
    assert len(bodies) == 4 and all(files[p] == body and json.loads(body)["books"] for p, body in bodies.items())


def test_members_of_an_object_in_chunks():
    cases = {
        '{"abbreviation":"x"}': True, '{"abbreviation":null}': False, "{}": False, "[1]": False, "": False, '{"a":{"abbreviation":1}}': False, '{"abbreviation":1': False, '{"abbreviation":1,}': False,
        '{"a":[1 2],"abbreviation":1}': False, '{"a":[12.5e3,-1],"abbreviation":[]}\n': True, '{"b":[{"c":[]},"é\\""],"abbreviation":0}': True, '{"a":[1,],"abbreviation":1}': False, '{"abbreviation":NaN}': False,
    }
    for text, want in cases.items():
        for step in (1, 2, 3, 100):
            m, raw = Members("abbreviation"), text.encode()
            for at in range(0, len(raw), step):
                m.add(raw[at : at + step])
            assert m.end() == want, (text, step)
    m = Members("abbreviation")
    for chunk in [b'{"abbreviation":"x","books":[', *[b'{"n":[1,2,3]},'] * 100_000, b"{}]}"]:
        m.add(chunk)
        assert len(m.held) < 100
    assert m.end()


def test_a_published_file_is_read_in_chunks():
    hashes = [hashlib.sha1(bytes([n])).hexdigest() for n in range(50)]
    for name, body, said in (("books.json", json.dumps(hashes), sorted(hashes)), ("x.sha", hashes[0] + "\n", [hashes[0] + "\n"]), ("x.sha", hashes[0] * 3, [(hashes[0] * 3)[:64]])):
        for step in (1, 39, 41, 4096):
            read = published._Read(f"a/{name}")
            for at in range(0, len(body), step):
                read.add(body.encode()[at : at + step])
            assert read.end()[1:] == (said, None, hashlib.sha1(body.encode()).hexdigest())
