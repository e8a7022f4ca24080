import random

from lectern.llm import shingles


def test_classes_by_similarity(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(2000)]
    docs = [(None, "no id here at all, and no copy"), (None, "one two three four five six"), (901, "one two three four five six"), (902, None), (903, " \n"), (904, "a"), (905, "A")]
    for i in range(60):
        base = rng.choices(words, k=400)
        docs.append((i * 10, " ".join(base)))
        for k in (1, 5, 8, 30):
            one = list(base)
            for place in rng.sample(range(400), k):
                one[place] = "new"
            docs.append((i * 10 + k % 9 + 1, " ".join(one)))
    docs += [docs[20], docs[20]]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, name string, size int")
    sets = [set(shingles.shingle_set((t or "").encode()).tolist()) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= 0.8 * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        if d is not None or r not in least:
            least[r] = d if least.get(r) is None else min(least[r], d)
    got = shingles.first_of_groups(frame)
    assert got.columns == frame.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted(least.values(), key=str)
    assert shingles.first_of_groups(frame.where("doc_id < 0")).collect() == []


def test_all_pairs_of_a_crowded_bucket(spark):
    """Documents around one long text, below the similarity to each other but for planted pairs."""
    rng, template = random.Random(3), [f"t{i}" for i in range(300)]
    docs = []
    for i in range(60):
        own = [f"p{i}w{k}" for k in range(20)]
        for side in (0, 1):
            docs.append((2 * i + side, " ".join(template + own + [f"d{i}s{side}w{k}" for k in range(20)])))
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in shingles.first_of_groups(frame).collect()) == [2 * i for i in range(60)]


def test_blocks_meet_and_sketches_never_rule_out_a_pair(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 300)), dtype="uint64")
        sets += [np.unique(np.concatenate([base[: max(1, round(len(base) * keep))], rng.integers(0, 1 << 63, int(more), dtype="uint64")])) for keep, more in ((1, 0), (0.9, 0), (0.95, 9), (0.5, 60))]
    sizes, n = np.array([len(s) for s in sets]), len(sets)
    i, j = shingles.possible(sizes, [shingles.parities(s) for s in sets], np.arange(n), np.full(n, -1), 0.8)
    got = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    assert {(a, b) for b in range(n) for a in range(b) if shingles.similar(sets[a], sets[b], 0.8)} <= got
    assert len(got) < n * n / 20
    monkeypatch.setattr(shingles, "BLOCK", 8)
    test_all_pairs_of_a_crowded_bucket(spark)
