"""Encoders, packing, search, toxicity, rollups and personal data."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lectern.llm import packing, pieces, pii, rollups, tokens, topk, toxicity

ODD = ["a", "'s", "don't", "́", "é", "É", "\x1c", "\x85", "\xa0", "ß", "Σ", "<|endoftext|>", "<|EndOfText|>", "İ", "K", "1", "23", "!?", "\n", "\t", "\x0b", " ", "  ", "    ", " " * 17, "中文", "​", "😀", ".", ",", "The", "ing", "<s>", "<0x41>", "▁", "\x00", "//", "=="]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, 14))) for _ in range(n)] + ["", "x" * 5000, " ".join(["word"] * 3000)]


def test_word_encoder_is_exact():
    encode = tokens.WordEncoder(tokens.vocabulary())
    for text in texts(3000, 1):
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(next(iter(encode.encode([text.encode()]))), "<u4").tolist() == want, text


def test_piece_codec_is_exact():
    import sentencepiece

    path = tokens.vocabulary("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceCodec(path)
    for text in texts(3000, 2):
        want = library.encode(text)
        assert own.encode(text) == want and own.decode(want) == library.decode(want), text
    rng = random.Random(3)
    for _ in range(500):
        ids = rng.choices(range(400), k=6)
        assert own.decode(ids) == library.decode(ids)


def test_piece_digests(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary("piece_bpe_32k.model"))
    docs = [(1, "Some words, twice."), (1, "Some words, twice."), (2, None), (3, ""), (None, "x")]
    frame = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, n_tokens int")
    want = []
    for i, t in docs:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, pieces.digests(frame).collect()), key=str) == sorted(want, key=str)
    assert [r["decoded"] for r in pieces.encoded(frame).where("doc_id = 1").collect()] == ["Some words, twice."] * 2
    assert pieces.digests(frame.where("doc_id > 9")).collect() == []


@pytest.mark.parametrize("text", ["ab" * 60_000, "x" * 100_000, "中" * 40_000, "".join(random.Random(5).choices("abcdefghij", k=100_000))])
def test_pieces_of_texts_without_white_space(text):
    import sentencepiece

    path = tokens.vocabulary("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceCodec(path)
    ids = own.encode(text)
    assert ids == library.encode(text) and own.decode(ids) == library.decode(ids)


def test_packing(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choices(["a", "bee", "cedar,", "Dé"], k=rng.choice([0, 3, 40, 900, 5000])))) for i in range(120)] + [(3, None), (4, "a"), (4, "a"), (None, "b")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, offset int")
    got = packing.packed(frame).toPandas()
    encode = tokens.WordEncoder(tokens.vocabulary()).tokenizer
    total = 0
    for i, text in {(i, t) for i, t in docs if i not in (None, 3, 4)}:
        ids = np.array([*encode.encode(text, add_special_tokens=False).ids, 0], "<u4")
        mine = got[got.doc_id == i].sort_values("piece")
        assert mine.length.sum() == len(ids) and mine.start.tolist() == list(range(0, len(ids), 2048))
        assert [zlib.crc32(ids[a : a + 2048].tobytes()) for a in mine.start] == mine.ids_crc32.tolist()
    total = got.length.sum()
    rows = got.sort_values(["sequence_id", "offset"])
    ends = rows.groupby("sequence_id").length.cumsum()
    assert (ends - rows.length == rows.offset).all() and ends.max() <= 2048
    left = []
    for x in sorted(got.length, reverse=True):  # plain best fit, for comparison
        fits = [k for k, gap in enumerate(left) if gap >= x]
        if fits:
            left[min(fits, key=lambda k: left[k])] -= x
        else:
            left.append(2048 - x)
    assert total / 2048 <= got.sequence_id.nunique() <= len(left) + 1
    assert len(got[(got.doc_id == 4) & (got.length == 2)]) >= 2 and packing.packed(frame.where("doc_id > 999")).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 2048): rng.randint(1, 50) for _ in range(rng.choice([1, 5, 200]))}
    planned = packing.plan(counts)
    used = {}
    for lengths, times in planned:
        assert sum(lengths) <= 2048 and times > 0
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts
    for x, (first, _, _) in packing.slots(planned).items():
        assert first[0] == 0 and (np.diff(first) > 0).all() and first[-1] < counts[x]


def test_plan_fills_exactly_where_it_can():
    assert packing.plan({2000: 3, 48: 3, 1024: 4, 700: 2, 648: 2}) and sum(t for _, t in packing.plan({2000: 3, 48: 3, 1024: 4, 700: 4, 648: 2})) == 7


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(900)]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (50, rows[0][1]), (1002, [0.0] * 8), (1050, [0.0] * 8), (1100, None), (1150, [1.0, None] * 4), (1200, [float("inf")] * 8), (1003, [1e300] + [0.0] * 7)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows if i != 1003], "vec_id long, embedding array<double>, rank int").where(topk.usable(topk.F.col("embedding")))
    got = topk.top_k(frame.select("vec_id", topk.quantized(topk.F.col("embedding")).alias("v")), topk.F.col("vec_id") % 50 == 0, least=40).collect()
    good = [(i, np.floor(256 * np.array(v)).astype("int64")) for i, v in rows if i != 1003 and v and None not in v and np.isfinite(v).all()]
    by = {}
    for q, x in good:
        if q % 50 == 0:
            by.setdefault(q, []).extend((-int(x @ v), i) for i, v in good if i != q)
    want = {q: sorted(s)[:5] for q, s in by.items()}
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert found == want
    assert topk.top_k(frame.where("vec_id < 0").select("vec_id", topk.quantized(topk.F.col("embedding")).alias("v")), topk.F.lit(True)).collect() == []
    few = topk.top_k(frame.where("vec_id in (100, 101)").select("vec_id", topk.quantized(topk.F.col("embedding")).alias("v")), topk.F.col("vec_id") == 100).collect()
    assert [(r["rank"], r["vec_id"]) for r in few] == [(1, 101)]


@pytest.mark.parametrize("scale", [1, 2**40, 2**58])
def test_bounds_end_the_reading_where_a_few_components_decide(scale):
    """Scores are clipped to 64 bits; where they are too large for doubles, bounds are widened."""
    rng = np.random.default_rng(3)
    rows = rng.integers(-9, 9, (2000, 12))
    rows[:, :2] *= rng.geometric(0.02, (2000, 2))
    rows[:40], early = rows[40:80], 0  # repeated rows
    rows = np.clip(rows.astype(object) * scale, -(2**62), 2**62).astype("int64")
    ids, edge = rng.permutation(2000), np.iinfo("int64")
    lists = topk.Lists(ids, rows)
    for n in range(30):
        found, scores, depth = topk.best(lists, rows[n], ids[n], 5)
        exact = [min(max(int(x), edge.min), edge.max) for x in rows.astype(object) @ rows[n].astype(object)]
        assert [(-s, i) for i, s in zip(found.tolist(), scores.tolist(), strict=True)] == sorted((-exact[i], int(ids[i])) for i in range(2000) if i != n)[:5]
        early += depth < 2000
    assert early >= 20 or scale > 1
    floor = 2.0 * max(abs(int(x)) for r in rows for x in r) ** 2 * 12  # no row reaches it
    assert scale > 1 or topk.best(lists, rows[0], ids[0], 5, floor)[2] == topk.DEPTH


def test_toxicity_learns_pairs():
    """A pair of words is toxic that neither word is: additive weights alone can't tell."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array([1] * int(a) + [2] * int(b) + [int(rng.integers(10, 500)) for _ in range(5)], "int64"))
        labels.append(int(a and b))
    model = toxicity.fit(rows, np.array(labels))
    hits = [(model.score(set(r.tolist())) >= 0.5) == y for r, y in zip(rows, labels, strict=True)]
    assert np.mean(hits) > 0.97
    assert toxicity.fit([], np.zeros(0, "int64")).score(set()) < 0.01 and toxicity.fit([np.zeros(0, "int64")], np.ones(1, "int64")).score({1}) > 0.99


def test_toxicity_learns_an_exclusive_pair():
    """Either of two words is toxic without the other, which weights that add up can't tell; no term is left out of
    learning for what it tells alone."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(4000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array(sorted({1} & {int(a)} | {2} & {2 * int(b)} | set((rng.zipf(1.3, 80) % 5000 + 10).tolist())), "int64"))
        labels.append(int(a != b))
    model = toxicity.fit(rows[:3000], np.array(labels[:3000]))
    assert {1, 2} <= set(model.column)
    assert np.mean([(model.score(set(r.tolist())) >= 0.5) == y for r, y in zip(rows[3000:], labels[3000:], strict=True)]) > 0.97


def test_toxicity(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(1500):
        bad = rng.random() < 0.2
        docs.append((i, " ".join(rng.choices(["one", "two", "three"], k=60) + ["idiot!"] * bad)))
        labels.append((i, int(bad)))
    docs += [(2000, None), (2001, ""), (2002, "idiot " * 50_000), (None, "x"), (3, docs[3][1])]
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double")
    marks = spark.createDataFrame([(i, y, None) for i, y in labels] + [(None, 1, None), (5, None, None), (1, labels[1][1], None), (99_999, 1, None)], "doc_id long, toxic int, lang string")
    model = toxicity.trained(frame, marks)
    got = {(r["doc_id"]): r for r in toxicity.scored(frame, model).collect()}
    assert np.mean([(got[i]["predicted"] == 1) == bool(y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]) > 0.98
    assert 0 <= got[2000]["score"] == got[2001]["score"] < 0.5 <= got[2002]["score"] <= 1
    clean = toxicity.cleaned(frame, model)
    assert clean.columns == frame.columns and {r["doc_id"] for r in clean.collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert toxicity.scored(frame.where("doc_id < 0"), toxicity.trained(frame, marks.where("doc_id < 0"))).collect() == []


def totals(rollup):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()}


@pytest.mark.parametrize(("fold", "looked_up"), [(16, 100), (2, 0)])
def test_rollups(spark, tmp_path, fold, looked_up):
    kind = "doc_id long, source string, lang string, tokenizer string, tokens long, op string"
    batch = lambda *rows: spark.createDataFrame(rows, kind)
    kept = rollups.Rollup(spark, str(tmp_path / "r"), fold, looked_up)
    first = batch((1, "a", "en", "t", 5, "insert"), (2, "a", None, "t", None, "insert"), (3, "b", "en", "t", 7, "insert"), (None, "b", "en", "t", 7, "insert"), (4, "b", "en", "t", 7, "guess"))
    assert totals(kept) == {} and kept.apply("1", first) and not kept.apply("1", first)
    assert totals(kept) == {("a", "en", "t"): (1, 5), ("a", None, "t"): (1, 0), ("b", "en", "t"): (1, 7)}
    assert kept.apply("2", batch((1, "a", "en", "t", 6, "revise"), (3, "c", "en", "t", 8, "revise"), (2, None, None, "t", 0, "delete"), (2, "a", None, "t", 9, "revise"), (9, "a", "en", "t", 0, "delete"), (1, "a", "en", "u", 2, "insert")))
    assert totals(kept) == {("a", "en", "t"): (1, 6), ("c", "en", "t"): (1, 8), ("a", "en", "u"): (1, 2)}
    assert kept.apply("3", batch()) and totals(rollups.Rollup(spark, str(tmp_path / "r"))) == totals(kept)
    assert kept.apply("4", batch((2, "d", "en", "t", 4, "insert"), (1, "a", "en", "u", 0, "delete"))) and kept.apply("5", batch((2, "d", "en", "t", 3, "revise")))
    assert totals(kept) == {("a", "en", "t"): (1, 6), ("c", "en", "t"): (1, 8), ("d", "en", "t"): (1, 3)}
    assert sorted((r["doc_id"], r["tokens"]) for r in kept.ledger().collect()) == [(1, 6), (2, 3), (3, 8)]
    assert sorted(r["batch_id"] for r in kept.applied().collect()) == ["1", "2", "3", "4", "5"]
    assert spark.read.parquet(str(tmp_path / "r" / "5" / "changes")).count() == 1, "a commit writes its batch alone"


def test_of_two_writers_of_a_commit_one_raises(spark, tmp_path):
    kind = "doc_id long, source string, lang string, tokenizer string, tokens long, op string"
    batch = lambda *rows: spark.createDataFrame(rows, kind)
    at = str(tmp_path / "r")
    other = rollups.Rollup(spark, at)
    other.apply("0", batch((1, "a", "en", "t", 1, "insert")))

    class Late(rollups.Rollup):
        def _placed(self, made, n):
            assert other.apply("faster", batch((2, "a", "en", "t", 10, "insert")))
            super()._placed(made, n)

    mine = batch((3, "a", "en", "t", 100, "insert"))
    with pytest.raises(RuntimeError):
        Late(spark, at).apply("slower", mine)
    assert totals(other) == {("a", "en", "t"): (2, 11)} and sorted(p.name for p in (tmp_path / "r").iterdir()) == ["1", "2"]
    assert rollups.Rollup(spark, at).apply("slower", mine) and totals(other) == {("a", "en", "t"): (3, 111)}
    assert sorted(r["batch_id"] for r in other.applied().collect()) == ["0", "faster", "slower"]
    (tmp_path / "r" / ".cutshort").mkdir()
    assert other.clear() == 1 and other.clear() == 0 and totals(other) == {("a", "en", "t"): (3, 111)}


def test_token_counts_equal_a_recount(spark, tmp_path):
    rows = [(1, "one two", "s", "en", 7), (2, None, "s", "en", 0), (3, "three", None, "de", 5), (4, "four four", "s", "en", 9), (4, "four", "s", "en", None), (4, "", "q", "en", 0), (None, "x y", "s", "en", 3), (None, "x y", "s", "en", 3), (5, "\t ", "blank", None, 2), (6, "word " * 60_000, "long", "en", 300_000)]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, source string, lang string, n_chars long, part string, tokens int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    encode = Tokenizer.from_file(tokens.vocabulary()).encode
    for _, text, source, lang, _ in rows:
        for name, n in (("words", len((text or "").split())), ("word_bpe_49k", len(encode(text or "", add_special_tokens=False).ids))):
            d, t = want.get((source, lang, name), (0, 0))
            want[source, lang, name] = (d + 1, t + n)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rollups.op9_token_counts(spark, str(tmp_path)).collect()} == want
    docs.where("doc_id < 0").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert rollups.op9_token_counts(spark, str(tmp_path / "none")).collect() == []


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def right(k, value):
    d = re.sub("[^0-9]", "", value)
    check = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d)))
    return [True, k == 1 and all(int(x) <= 255 for x in value.split(".")), 12 <= len(d) <= 19 and check % 10 == 0, 9 <= len(d) <= 15][k]


def brute_spans(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if right(k, m[0]))


def test_personal_data(spark):
    rng = random.Random(2)
    bits = ["a@b.co", "x.y+z@", "@", "foo", "é😀", " ", "-", ".", "1.2.3.4", "256.1.1.1", "0007.1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (504) 555-2652", "+49 30 1234567", "+", "(", "12345", "7", "_", "a@b.c_d@e.fg.", "\n", "john at foo dot com", "(504) 555-2652", "jane [at] x.org"]
    docs = [(i, "".join(rng.choices(bits, k=rng.randint(0, 14)))) for i in range(600)]
    docs += [(1000, None), (1001, ""), (1002, "1 " * 40_000), (1003, "a" * 60_000 + "@"), (1004, "a@b.co " * 2000), (None, "a@b.co"), (7, "+1" + " " * 30_000)]
    frame = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, spans string, n_chars int")
    trees = pii.trained(frame)
    assert trees.trees
    for model in (pii.Trees([], [2.0] * 4), trees):
        got = pii.digests(frame, model).collect()
        want = []
        for i, t in docs:
            spans = brute_spans(t)
            text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
            want.append(str((i, *(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(text.encode()).hexdigest())))
        assert sorted(str(tuple(r)[:6]) for r in got) == sorted(want)
        for r in got:
            every = [tuple(x.split(":")) for x in r["spans"].split(",") if x]
            assert len(every) == sum(tuple(r)[1:5]) + r["n_added"]
    clash = frame.select("*", *[pii.F.lit("mine").alias(c) for c in ("base", "added", "every", "runs", "found", "scored")])
    assert {tuple(r)[4:] for r in pii.redacted(clash, trees).collect()} == {("mine",) * 6}
    hidden = pii.redacted(frame, pii.Trees([], [2.0] * 4))
    assert hidden.columns == frame.columns
    for r in hidden.where("doc_id < 600").collect():
        assert r["n_chars"] in (3, len(r["text"]))
    assert [r["text"] for r in pii.redacted(frame.where("doc_id in (1000, 1001)")).collect()] == [None, ""]
    one = spark.createDataFrame([(1, "mail a@b.co, or +49 30 1234567!")], "doc_id long, text string")
    assert pii.redacted(one).first()["text"] == "mail [EMAIL], or [PHONE]!"
    assert pii.digests(frame.where("doc_id < 0"), pii.trained(frame.where("doc_id < 0"))).collect() == []


def test_personal_data_runs_no_python(spark):
    rows = pii.digests(spark.createDataFrame([(1, "a")], "doc_id long, text string"), pii.Trees([], [2.0] * 4))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_personal_data_is_counted_by_kind(spark):
    text = "a@b.co, 1.2.3.4, c@d.org, 4111 1111 1111 1111, e@f.net, +49 30 1234567, 8.8.8.8"
    got = pii.digests(spark.createDataFrame([(1, text)], "doc_id long, text string"), pii.Trees([], [2.0] * 4)).first()
    assert tuple(got)[1:5] == (3, 2, 1, 1)


def test_personal_data_trees_learn_from_all_documents(spark):
    from pyspark.sql import functions as F

    texts = F.when(F.col("doc_id") < 21_000, "x").when(F.col("doc_id") % 2 == 0, "mail jo at ab dot org now").otherwise("he at 1 dot 2 ok")
    docs = spark.range(21_600).withColumnRenamed("id", "doc_id").withColumn("text", texts)
    rows, _ = pii.candidates(docs)
    assert {(r["label"], r["n"]) for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()} == {(0.0, 300.0), (1.0, 300.0)}
    kept = [r["n"] for r in rows.where("kept").select("n").collect()]
    assert len(kept) == 2 and min(kept) > pii.SHOWN
    trees = pii.trained(docs)
    assert trees.least[0] < 1 and min(trees.least[1:]) == 2.0
    assert pii.digests(docs, trees).agg(F.sum("n_added")).first()[0] == 300


def test_personal_data_is_searched_whatever_else_a_text_has(spark):
    from pyspark.sql import functions as F

    base = spark.createDataFrame([(1, "+1 - 2 - 3 - 4 - 5 - 6 - 7 - 8 - 9")], "doc_id long, text string")
    assert pii.digests(base, pii.Trees([], [2.0] * 4)).first()["n_phone"] == 1
    wanted = {"john at example.com": [0], "john AT example dot com": [0], "john[at]example [dot] com": [0], "8[.]8[.]8[.]8": [1], "8 . 8 . 8 . 8": [1], "1234_5678_9012_3456": [2], "(30) 1234567": [3], "at 8": []}
    frame = spark.createDataFrame([(t,) for t in wanted], "text string")
    got = {r["text"]: r["ranks"] for r in frame.select("text", F.transform(pii.generated(F.col("text")), lambda m: m["rank"]).alias("ranks")).collect()}
    assert got == wanted
