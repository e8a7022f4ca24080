"""Divergence of sources, vector codes and quality against brute force and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lectern.llm import codes, divergence, quality


def brute_audit(rows, support, reported):
    docs = [((l or ""), (s or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for t, l, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in held.items() if n >= support}
        every = Counter(t for d in own for t in d[2] if t in kept)
        groups = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        p = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))  # noqa: E731, B023
        for s, c in groups.items():
            pair = sorted((-sum(abs(p(c, t) - p(o, t)) for t in kept), x.encode(), x) for x, o in groups.items() if x != s)
            term = sorted((p(every, t) - p(c, t), t.encode(), t) for t in c if p(c, t) > p(every, t))[:reported]
            out += [(lang, s, part, x, -v, i + 1) for part, found in (("pair", pair), ("term", term)) for i, (v, _, x) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("held", [3, 400_000])
def test_source_divergence(spark, held, monkeypatch):
    monkeypatch.setattr(divergence.counts, "__defaults__", (held,))
    rng = random.Random(1)
    words = [f"w{chr(97 + i % 26) * (i // 26 + 1)}" for i in range(80)] + ["Été", "ÉTÉ", "中文", "naïve", "x1y", "A_B", "😀"]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "de"]), "hot" if i % 2 else rng.choice(["a", "b", "é", "z", "rare"])
        rows.append((" ".join(rng.choices(words, [1 / (k + 1 + len(source)) for k in range(len(words))], k=rng.choice([0, 1, 5, 60 if source == "hot" else 9]))), lang, source))
    rows += [(None, "en", "a"), ("word", None, "a"), ("", "en", None), ("no, terms 1 2 3", "fr", "lone"), ("a", "it", "one"), ("b", "it", "two"), rows[3], rows[3], ("the " * 60_000, "en", "b"), ("y" * 100_000, "en", "b")]
    frame = spark.createDataFrame([(i, *r, 1, "c") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, value int, term string")
    for support, reported in ((5, 50), (1, 4)):
        got = divergence.audit(frame, support, reported)
        assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
        assert sorted(map(tuple, got.collect())) == brute_audit(rows, support, reported)


def test_source_divergence_of_nothing_and_of_many_groups(spark, monkeypatch):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(frame).collect() == []
    rng = random.Random(2)
    rows = [(" ".join(rng.choices("abcdef", k=5)), "en", f"s{i % 23}") for i in range(120)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(divergence, "SENT", 3)  # groups are joined by key, and meet in blocks
    monkeypatch.setattr(divergence, "BLOCK", 5)
    assert sorted(map(tuple, divergence.audit(frame, 2).collect())) == brute_audit(rows, 2, 50)


def test_shares_are_exact(spark):
    cases = [(0, 1, 1), (10**13, 3 * 10**14 + 7, 10**6), (123_456_789_012_345, 999_999_999_999_999, 17), (0, 0, 0)]
    frame = spark.createDataFrame(cases, "n long, total long, v long")
    got = [r[0] for r in frame.select(divergence.share(divergence.F.col("n"), divergence.F.col("total"), divergence.F.col("v"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (t + 5 * v) if t + v else None for n, t, v in cases]


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """By Python's integers: rows (vec_id, v, label) of vectors of one length or several."""
    rows = [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    wide = -(-max((len(v) for _, v, _ in rows), default=0) // parts)
    whole = lambda x: int(x) * 4096 if abs(x) > 2**60 else int(np.floor(4096 * x))
    cut = lambda v: [(v + [0] * (wide * parts - len(v)))[p * wide : (p + 1) * wide] for p in range(parts)]
    vectors = [cut([whole(x) for x in v]) for _, v, _ in rows]
    seeds = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[vectors[i][p] for i in seeds] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assigned = lambda: [[min((away(v[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for v in vectors]
    for _ in range(rounds if rows else 0):
        found = assigned()
        for p in range(parts):
            for k in range(len(books[p])):
                if mine := [v[p] for v, f in zip(vectors, found, strict=True) if f[p][1] == k]:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found, top = (assigned() if rows else []), 2**63 - 1
    errors = [min(sum(d for d, _ in f), top) for f in found]
    sums = Counter()
    for (_, _, label), e in zip(rows, errors, strict=True):
        sums[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, min(sums[label], top)) for (i, _, label), f, e in zip(rows, found, errors, strict=True)), key=str), digest


def test_vector_codes(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(9, 16))
    rows = [(int(i), (centres[i % 9] + rng.normal(size=16) * 0.1).tolist(), int(i % 4) if i % 7 else None) for i in rng.permutation(300)]
    rows += [(400, [0.0] * 16, 1), (401, None, 1), (402, [1.0, None] * 8, 1), (403, [float("nan")] * 16, 1), (404, [float("-inf")] * 16, None), (3, rows[0][1], 2), rows[5], rows[5], (None, [0.25] * 16, 3), (405, [-1e-9] * 16, 0)]
    kind = "vec_id long, v array<double>, label int, code int, error string"

    def made(rows):
        got, books = codes.compressed(spark.createDataFrame([(*r, 1, "e") for r in rows], kind))
        return sorted(map(tuple, got.collect()), key=str), books.digest()

    assert made(rows) == brute_codes(rows)
    few = rows[:5]
    assert made(few) == brute_codes(few)
    mixed = [(i, v[: 1 + i % 16], x) for i, (_, v, x) in enumerate(rows[:60])] + [(99, [], 1)]
    assert made(mixed) == brute_codes(mixed)
    large = [(i, [x * 10.0 ** (i % 30) for x in v], x) for i, (_, v, x) in enumerate(rows[:60])] + [(80, [1e300] * 16, 1)]
    assert made(large) == brute_codes(large)
    empty = made([])
    assert empty == ([], hashlib.sha256(b"").hexdigest()) and made([(1, None, 1)]) == empty


def test_vector_codes_without_a_broadcast_and_with_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(codes, "SENT", 1)
    monkeypatch.setattr(codes, "CHUNK", 64)
    rows = [(i, [float(i % 3)] * 8, i % 2 or None) for i in range(80)]
    got, books = codes.compressed(spark.createDataFrame(rows, "vec_id long, v array<float>, label int"))
    assert (sorted(map(tuple, got.collect()), key=str), books.digest()) == brute_codes(rows)


@pytest.mark.parametrize("scale", [1, 900, 2**20, 2**70])
def test_lower_bounds_never_lose_the_nearest_entry(scale):
    rng = np.random.default_rng(3)
    kind = object if scale > 2**30 else "int64"
    rows, entries = ((rng.normal(size=(n, 8)) * 50 + rng.normal(size=(n, 1)) * 200).astype("int64").astype(kind) * scale for n in (700, 16))
    rows[:16], entries[3] = entries, entries[9]  # exact hits and a tie
    best, far, computed = codes.nearest(rows, entries)
    exact = [[sum(int(x - y) ** 2 for x, y in zip(r, e, strict=True)) for e in entries] for r in rows]
    assert best.tolist() == [min(range(16), key=lambda k, w=w: (w[k], k)) for w in exact] and far.tolist() == [min(w) for w in exact]
    assert computed < 0.4 * len(rows) * 16  # most entries go by their bounds
    x, c = (codes.Sketch(codes._doubles(a, 0)) for a in (rows, entries))
    i, j = np.repeat(np.arange(700), 16), np.tile(np.arange(16), 700)
    bounds = [codes.below(x, c, level, i, j) for level in range(len(codes.LEVELS))]
    truth = np.array(exact, float).ravel()
    assert all((b <= truth).all() for b in bounds)
    assert np.mean(bounds[0]) <= np.mean(bounds[1]) <= np.mean(bounds[2])


def brute_features(text):
    words = re.findall(r"[^ \t\n\v\f\r]+", text)
    found = [("w", w) for w in words] + [("p",) + (("=",) if a == b else (a, b)) for a, b in zip(words, words[1:], strict=False)]
    return Counter(found + [("g", f" {w} "[i : i + n]) for w in words for n in quality.GRAMS for i in range(len(w) + 3 - n)])


def test_features_are_words_pairs_and_grams():
    rng = random.Random(1)
    names = {}
    for text in ["", " ", "a", "a a a", "Ab  cd\n\tef", "été 中文 😀😀", "x\xa0y z\x85w", *(" ".join(rng.choices(["the", "cat", "Cat", "ça", "!!", "a"], k=rng.randrange(30))) for _ in range(200))]:
        want, got = brute_features(text), Counter(quality.features(text).tolist())
        assert sum(got.values()) == sum(want.values())
        if len(want) == 1 or len(text) == 1:
            names |= dict.fromkeys(want, next(iter(got), None))
        assert sorted(got.values()) == sorted(want.values()) or len(want) > 3 * len(got) / 4  # but for chance
    one, two = (quality.features(x) for x in ("der der", "con con"))
    assert set(one.tolist()) & set(two.tolist()) == set(quality.features("q q").tolist()) & set(one.tolist())


def test_long_texts_are_hashed_in_stretches():
    text = "some words and more " * 400 + "x" * 3000 + " end"
    parts = list(quality.stretches(text, 1000))
    assert "".join(parts) == text and max(map(len, parts)) <= 1000
    assert all(p[0] in " x" for p in parts[1:])
    whole, cut = Counter(quality.features(text[:8000]).tolist()), Counter()
    for p in quality.stretches(text[:8000], 1000):
        cut.update(quality.features(p).tolist())
    assert 0 <= sum(whole.values()) - sum(cut.values()) <= len(parts)  # pairs over a cut
    ids, n = quality.counted(text)
    assert n.sum() == len(quality.features(text)) and (np.diff(ids) > 0).all()


def test_quality(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(1200):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(60)]
        bad = rng.choice(["", "", "", "", "!", "up", "twice"])
        docs.append((i, " ".join([w + "!!" for w in words] if bad == "!" else [w.upper() for w in words] if bad == "up" else [w for w in words[:12] for _ in range(6)] if bad == "twice" else words)))
        labels.append((i, int(not bad)))
    docs += [(2000, None), (2001, ""), (2002, "AB!! " * 300_000), (None, "plain words"), (3, docs[3][1])]
    frame = spark.createDataFrame([(i, t, 1.0, 3) for i, t in docs], "doc_id long, text string, score double, ids int")
    marks = spark.createDataFrame([(i, y, None) for i, y in labels] + [(None, 1, None), (5, None, None), (1, labels[1][1], None), (99_999, 1, None)], "doc_id long, quality int, text string")
    model = quality.trained(frame, marks)
    rows = quality.scored(frame, model).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i]["predicted"] == y for i, y in held]) > 0.97
    assert got[2000]["score"] == got[2001]["score"] and got[2002]["predicted"] == 0
    assert quality.scored(frame.where("doc_id < 0"), quality.trained(frame, marks.where("doc_id < 0"))).collect() == []


def test_quality_without_both_labels():
    row = (np.array([1, 2], "int32"), np.array([1, 1]))
    for labels, score in (([], 1), ([1, 1], 1), ([0, 0], 0)):
        model = quality.fit([row] * len(labels), np.array(labels, "int64"))
        assert abs(model.score("any text", model.slopes()) - score) < 0.01
    empty = (np.zeros(0, "int32"), np.zeros(0, "int64"))
    model = quality.fit([row, empty] * 20, np.array([1, 0] * 20))
    assert 0 <= model.score("", model.slopes()) <= 1
