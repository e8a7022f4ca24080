"""SimHash, embeddings and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from lectern.llm import common, simhash, vectors


def roots(n, i, j):
    r = np.arange(n)
    while True:
        q = r.copy()
        np.minimum.at(q, i, r[j])
        np.minimum.at(q, j, r[i])
        q = q[q]
        if (q == r).all():
            return r
        r = q


@pytest.mark.parametrize("local", [0, 3, 10**6])
def test_components(spark, local):
    rng = random.Random(2)
    pairs = [(a, a + 1) for a in range(1, 60)] + [(100, x) for x in range(101, 160)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(pairs, "a long, b long"), local).collect()}
    i, j = np.array(pairs).T
    want = roots(301, i, j)
    assert got == {int(x): int(want[x]) for a, b in pairs if a != b for x in (a, b)}
    assert common.components(spark.createDataFrame([], "a long, b long"), local).collect() == []


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


TEXTS = ["", " \t\n", "One", "one", "A b C", "a b c d", "a b c d e", "É b c d", "x\x0by z\x1cw q", "a " * 200_000, "the same words again and again the same words again and again"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprints(text):
    assert simhash.fingerprint(text.encode()) == brute_print(text)


def test_groups(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    docs = [(None, "lone text without an id at all"), (7, None), (8, ""), (9, "  ")]
    for i in range(150):
        base = rng.choices(words, k=300)
        for k in range(rng.choice([1, 1, 2, 3])):
            one = list(base)
            for _ in range(k):
                one[rng.randrange(300)] = "new"
            docs.append((rng.randrange(10_000), " ".join(one)))
    docs += docs[10:14]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, fp int")
    got = simhash.near_groups(frame).collect()
    fps = np.array([brute_print(t) for _, t in docs], "uint64")
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4)
    of = roots(len(docs), i, j)
    least = {}
    for (d, _), r in zip(docs, of, strict=True):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    want = sorted(((d, int(f.view("int64")), least.get(r)) for (d, _), f, r in zip(docs, fps, of, strict=True)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    stay = simhash.first_of_groups(frame)
    assert stay.columns == frame.columns
    assert stay.count() == len(set(of.tolist())) and {r["doc_id"] for r in stay.collect()} == {least.get(r) for r in of.tolist()}


def test_crowded_buckets_join_up():
    """Near copies in their hundreds, in balls that touch: the same components as from all pairs."""
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 3, dtype="uint64")
    fps = np.unique(np.concatenate([c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 40, (200, 3), dtype="uint64"), axis=1) for c in centre]))
    links = simhash._all_near(fps, 4)
    a, b = (np.concatenate(x) for x in zip(*links, strict=True))
    assert (np.bitwise_count(fps[a] ^ fps[b]) <= 4).all() and len(a) < 2 * len(fps)
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4)
    assert (roots(len(fps), a, b) == roots(len(fps), i, j)).all()


@pytest.mark.parametrize("distance", [3, 4])
def test_crowded_buckets_ask_the_ring(distance):
    """Chains from all segments together join up what lies within the distance, in crowds too; one alone links less."""
    rng, ring = np.random.default_rng(6), simhash.Ring(distance)
    centre = rng.integers(0, 1 << 63, 3, dtype="uint64")
    fps = np.unique(np.concatenate([c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (150, 2), dtype="uint64"), axis=1) for c in centre]))
    found = []
    for first in range(ring.segments):
        a, b = (np.concatenate(x) for x in zip(*simhash._all_near(fps, distance, ring, first), strict=True))
        own = a != b
        assert ring.near(fps[a[own]], fps[b[own]], np.full(own.sum(), first)).all()
        found.append((a, b))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= distance)
    assert (roots(len(fps), a, b) == roots(len(fps), i, j)).all()
    assert len(np.unique(roots(len(fps), *found[0]))) > len(np.unique(roots(len(fps), a, b)))


@pytest.mark.parametrize("distance", [2, 3, 4, 7])
def test_pigeonring_finds_every_pair(distance):
    rng = np.random.default_rng(distance)
    ring = simhash.Ring(distance)
    a = rng.integers(0, 1 << 63, 300, dtype="uint64")
    b = a.copy()
    for n in range(300):
        for bit in rng.choice(64, rng.integers(0, distance + 1), replace=False):
            b[n] ^= np.uint64(1) << np.uint64(bit)
    for n in range(300):
        own, _, asks = ring.names(a[n : n + 1])
        other = ring.names(b[n : n + 1])[0]
        shared = [i for i in range(ring.segments) if (np.intersect1d(own[~asks & (own >> np.uint64(58) == i)], other)).size]
        assert any(ring.near(a[n : n + 1], b[n : n + 1], np.array([i]))[0] for i in shared)


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        base = rng.normal(size=16)
        for _ in range(int(rng.choice([1, 1, 2, 4]))):
            rows.append((len(rows) * 3, (base + rng.normal(size=16) * rng.choice([0.01, 0.2])).tolist()))
    hub = rng.normal(size=16)
    rows += [(5_000 + i, (hub + 0.01 * rng.normal(size=16)).tolist()) for i in range(300)]
    rows += [(9_000, rows[0][1]), (9_001, rows[0][1]), (9_002, [2 * x for x in rows[0][1]]), (9_003, None), (9_004, [0.0] * 16), (9_005, [float("nan")] * 16), (9_006, [1.0, None]), (9_007, [1.0, 1.0]), (9_008, [2.0, 2.0]), (9_009, [])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, v array<double>, class string")
    got = {r["vec_id"]: tuple(r)[1:] for r in vectors.near(frame).collect()}
    ids = [i for i, _ in rows]
    good = [k for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links, i, j = collections_of(rows, good)
    of = roots(len(rows), i, j)
    right = sum(got[ids[k]] == (links[k], ids[of[k]], ids[of[k]] == ids[k]) for k in range(len(rows)))
    assert right >= 0.99 * len(rows)
    assert got[9_003] == got[9_004][:0] + (0, 9_003, True) and got[9_007] == (1, 9_007, True) and got[9_009][0] == 0
    assert vectors.near(frame.where("vec_id < 0")).collect() == []


def test_rows_repeated_whole_and_longer_vectors(spark):
    rng = np.random.default_rng(4)
    long, other = rng.normal(size=600).tolist(), rng.normal(size=600).tolist()
    rows = [(1, long), (1, long), (1, other), (2, long), (None, long), (7, other), (8, [-x for x in long])]
    got = sorted(map(tuple, vectors.near(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, v array<double>, n_links int")).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (1, 1, 1, True), (2, 3, 1, False), (None, 3, 1, False), (7, 1, 1, False), (8, 0, 8, True)], key=str)


def collections_of(rows, good):
    links, i, j = [0] * len(rows), [], []
    for size in {len(rows[k][1]) for k in good}:
        mine = np.array([k for k in good if len(rows[k][1]) == size])
        x = np.array([rows[k][1] for k in mine])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(x @ x.T >= 0.95)
        for p, q in zip(mine[a], mine[b], strict=True):
            if p != q:
                links[p] += 1
                i.append(p)
                j.append(q)
    return links, np.array(i), np.array(j)


def test_large_buckets_are_compared_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(2)
    hub = rng.normal(size=8)
    rows = [(i, (hub + 0.001 * rng.normal(size=8)).tolist()) for i in range(120)]
    got = vectors.near(spark.createDataFrame(rows, "vec_id long, v array<double>")).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(119, 0)}
