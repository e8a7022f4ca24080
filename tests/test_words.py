import re
import time

import pyarrow as pa
from pyspark.sql import functions as F

from lectern.functions import places


def test_words_of_whole_texts(spark):
    long = " ".join(f"w{i}é\U0001f600" for i in range(60_000))
    texts = [None, "", " \t", "one", "  two three\n", long]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    began = time.monotonic()
    got = {r["i"]: r["w"] for r in frame.select("i", places.words(F.col("t")).alias("w")).collect()}
    assert time.monotonic() - began < 25  # what copies an array at each step takes the square of 60,000
    assert got[0] is None
    for i, t in enumerate(texts[1:], 1):
        want = [(m[0], k, m.start(), m.end()) for k, m in enumerate(re.finditer(r"[^\s]+", t), 1)]
        assert [tuple(x) for x in got[i]] == want


def brute_places(tokens, text):
    behind, out = 0, []
    for t in tokens:
        at = text.find(t, behind) if t else -1
        behind = at + len(t) if at >= 0 else behind
        out.append((t, at + 1 if at >= 0 else 0, behind if at >= 0 else 0))
    return out


def test_tokens_are_placed_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(places, "HELD", 7)
    many = [f"t{i % 50}\U0001f600" for i in range(20_000)]
    rows = [(["a", "b", "a"], "b a b a"), (["zz", "a", None, ""], "a zz"), ([], "x"), (None, "x"), (["x"], None), (["a"], ""), (many, " ".join(many))]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, tokens array<string>, t string")
    frame.select(places.aligned(F.col("tokens"), F.col("t")).alias("p")).collect()  # workers start
    began = time.monotonic()
    got = {r["i"]: r["p"] for r in frame.select("i", places.aligned(F.col("tokens"), F.col("t")).alias("p")).collect()}
    assert time.monotonic() - began < 10
    for i, (tokens, text) in enumerate(rows):
        assert got[i] is None if tokens is None or text is None else [tuple(x) for x in got[i]] == brute_places(tokens, text)
    assert frame.where("i > 99").select(places.words(F.col("t"))).collect() == []


def test_rows_of_places_are_told_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(places, "HELD", 7)
    texts = [None, "", " \t", "one", "  two three\n", " ".join(f"w{i}é\U0001f600" for i in range(50))]
    frame = spark.createDataFrame([(i, t, None if i == 3 else (t or "").split() + [None, "x"]) for i, t in enumerate(texts)], "row int, t string, tokens array<string>").coalesce(1)
    want = [(i, m[0], n, m.start(), m.end()) for i, t in enumerate(texts) if t for n, m in enumerate(re.finditer(r"\S+", t), 1)]
    words = places.word_rows(frame, "t", "row")
    assert sorted(tuple(r) for r in words.collect()) == sorted(want)
    placed = places.aligned_rows(frame, "tokens", "t", "row").collect()
    assert sorted(tuple(r) for r in placed if r["token"]) == sorted((i, k, *x) for i, t in enumerate(texts) if t is not None and i != 3 for k, x in enumerate(brute_places(t.split() + [None, "x"], t)) if x[0])
    sizes = []

    class Frame:
        """Takes the batches that go back to Spark."""

        schema, select = frame.schema, lambda self, *_: self

        def mapInArrow(self, run, _):  # noqa: N802
            sizes.extend(len(b) for b in run([pa.RecordBatch.from_pydict({"row": list(range(6)), "t": texts})]))

    places.word_rows(Frame(), "t", "row")
    assert sum(sizes) == len(want) and max(sizes) == 7
