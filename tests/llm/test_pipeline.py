"""The pipeline, stage by stage, against plain Python on planted documents."""

import bisect
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest

from lectern.llm import packing, shingles, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, base string, name string, every int, __name string"
WORDS = [f"w{i}" for i in range(3000)]


def planted(seed=5):
    rng = random.Random(seed)
    plain = lambda n: rng.choices(WORDS, k=n)
    passage, docs = plain(57), []
    for i in range(150):
        docs.append((i, " ".join(plain(90))))
    for i in range(150, 230):
        docs.append((i, " ".join([*plain(60), "idiot", "you", *plain(20)])))
    for i in range(230, 260):
        docs.append((i, " ".join([*plain(rng.randint(40, 90)), *passage, *plain(rng.randint(40, 90))])))
    base = plain(300)
    for i in range(260, 290):
        one = list(base)
        for at in rng.sample(range(300), 3):
            one[at] = "other"
        docs.append((i, " ".join(one)))
    docs += [(290, docs[3][1]), (291, docs[3][1]), (292, f"{docs[5][1]} mail a@b.co or +49 30 1234567 now"), (293, None), (294, ""), (295, " \n"), (296, " ".join(["long"] * 30_000)), (2, docs[2][1]), (None, " ".join(plain(70)))]
    labels = [(i, int("idiot" in (t or ""))) for i, t in docs if i is not None] + [(None, 1), (999, 1), (4, None)]
    return docs, labels


def frames(spark, docs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "b", "n", 3, "k") for i, t in docs], SCHEMA)


def rows(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def gone_words(docs, window=50):
    """What is left of each text without the words in a window that starts in another doc_id's text too."""
    words = lambda t: re.findall(r"[^\x20\x09-\x0d]+", t or "")
    have = {}
    for i, t in docs:
        w = words(t)
        for s in range(len(w) - window + 1):
            if i is not None:
                have.setdefault(tuple(w[s : s + window]), set()).add(i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and len(have[tuple(w[s : s + window])]) > 1:
                gone[s : s + window] = [True] * window
        out.append((i, t if not any(gone) else [x for x, g in zip(w, gone, strict=True) if not g]))
    return out


def near_groups(docs, similarity=0.8):
    sets = [set(shingles.shingle_set((t or "").encode()).tolist()) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    return [find(i) for i in range(len(docs))]


def best_fit(lengths, size):
    """Sequences that best fit, the longest first, takes."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        bisect.insort(gaps, (gaps.pop(at) if at < len(gaps) else size) - x)
    return len(gaps)


def test_stages_against_plain_python(spark, tmp_path):
    docs, labels = planted()
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame, stages, at = frames(spark, docs), dict(corpus_pipeline.STAGES), str(tmp_path)
    assert list(stages) == ["toxicity", "near_copies", "repeats", "personal_data", "packing"]

    clean = stages["toxicity"](spark, frame, at).cache()
    model = toxicity.trained(frame, spark.read.parquet(f"{at}/labels.parquet"))
    known = toxicity.Terms()
    assert rows(clean) == sorted(((i, t) for i, t in docs if model.score(known.of((t or "").encode())) < 0.5), key=str)
    assert not [t for _, t in rows(clean) if "idiot" in (t or "")] and len(rows(clean)) == len([t for _, t in docs if "idiot" not in (t or "")])
    assert clean.columns == frame.columns

    one_each = stages["near_copies"](spark, clean, at).cache()
    left, groups = rows(clean), near_groups(rows(clean))
    first = {}
    for (i, _), g in zip(left, groups, strict=True):
        first[g] = min(first.get(g, np.inf), np.inf if i is None else i)
    assert sorted(np.inf if i is None else i for i, _ in rows(one_each)) == sorted(first.values())
    assert one_each.columns == frame.columns

    unique = stages["repeats"](spark, one_each, at).cache()
    want = {i: t for i, t in gone_words(rows(one_each))}
    for i, t in rows(unique):
        assert (t if not isinstance(want[i], list) else t.split()) == want[i]
    assert sum(isinstance(t, list) for t in want.values()) == 30  # every copy of the passage
    assert unique.columns == frame.columns and all(r["n_chars"] == len(r["text"] or "") for r in unique.collect())

    hidden = stages["personal_data"](spark, unique, at).cache()
    before = dict(rows(unique))
    for i, t in rows(hidden):
        assert t == (before[i] if i != 292 else before[i].replace("a@b.co", "[EMAIL]").replace("+49 30 1234567", "[PHONE]"))
    assert hidden.columns == frame.columns and {(r["base"], r["name"], r["every"], r["__name"]) for r in hidden.collect()} == {("b", "n", 3, "k")}

    encode = tokens.WordEncoder(tokens.vocabulary()).tokenizer
    packed, seen, ends = stages["packing"](spark, hidden, at).collect(), {}, {}
    for r in packed:
        seen.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in rows(hidden):
        ids = np.array([*encode.encode(t or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        cuts = [(n, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for n, s in enumerate(range(0, len(ids), 2048))]
        assert sorted(seen[i]) == cuts
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(ends) <= best_fit([r["length"] for r in packed], 2048)


def test_whole_run_and_no_documents(spark, tmp_path):
    docs, labels = planted(6)
    frames(spark, docs).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    frames(spark, []).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    for at in ("a", "b"):
        spark.createDataFrame(labels if at == "a" else [], "doc_id long, toxic int").write.parquet(str(tmp_path / at / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path / "a"))
    assert {r["doc_id"] for r in found.collect()} >= set(range(0, 150)) - {2, 3, 5} and found.columns[:2] == ["doc_id", "piece"]
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).collect() == []


@pytest.mark.parametrize("words", [50, 52])
def test_a_short_passage_is_seen_by_words_and_not_by_bytes(spark, words):
    """A window of 400 bytes can't see a passage of 50 words that has fewer bytes; one of 50 words can."""
    from lectern.llm import suffixes

    rng = random.Random(2)
    passage = rng.choices(WORDS, k=words)
    docs = [(i, " ".join([*rng.choices(WORDS, k=80), *passage, *rng.choices(WORDS, k=80)])) for i in range(4)]
    assert len(" ".join(passage)) < 400
    frame = frames(spark, docs)
    assert rows(suffixes.deduplicated(frame)) == sorted(docs, key=str)
    got = rows(suffixes.deduplicated(frame, suffixes.word_kind()))
    assert [len(t.split()) for _, t in got] == [160 + words, 160, 160, 160]
    assert [len(t.split()) for _, t in rows(suffixes.deduplicated(frame, suffixes.word_kind(first_stays=False)))] == [160] * 4


def passages(n=80, seed=9):
    """Documents of made-up words, n passages of 51 to 80 words among them in 2 to 10 documents each, with white space of
    any kind around: (docs, (words, documents in order) of each passage, words of passages in each document)."""
    rng = random.Random(seed)
    made = lambda k: ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(k)]
    texts = [[made(rng.randint(20, 200))] for _ in range(300)]
    owners = []
    for _ in range(n):
        passage, mine = made(rng.randint(51, 80)), sorted(rng.sample(range(300), rng.randint(2, 10)))
        owners.append((len(passage), mine))
        for i in mine:
            texts[i] += [passage, made(rng.randint(20, 200))]
    joined = lambda words: "".join(w + rng.choice([" ", " ", " ", "\n", "\t ", "  "]) for w in words)
    return [(i, "".join(joined(part) for part in t)) for i, t in enumerate(texts)], owners, [sum(len(p) for p in t[1::2]) for t in texts]


@pytest.mark.parametrize("operator", ["op8", "pipeline"])
def test_no_later_copy_of_a_planted_passage_is_missed(spark, operator):
    """Op8's contract leaves the first copy of each passage where it is, so a document that holds first copies alone
    doesn't change; all later ones go. The pipeline's stage lets the first go too."""
    from lectern.llm import substrings

    docs, owners, planted_words = passages()
    frame = frames(spark, docs)
    n = {i: len(t.split()) for i, t in docs}
    if operator == "op8":
        lost = {r["doc_id"]: r["n_removed"] for r in substrings.digests(frame).collect()}
    else:
        lost = {i: n[i] - len(t.split()) for i, t in rows(corpus_pipeline.drop_repeats(spark, frame, ""))}
    later, first = {i for _, m in owners for i in m[1:]}, {m[0] for _, m in owners}
    changed = {i for i, k in lost.items() if k}
    assert later - changed == set(), "misses"
    if operator == "op8":
        assert changed == later and len(first - later) > 0  # documents of first copies alone stay whole
        assert sum(lost.values()) == sum(k * (len(m) - 1) for k, m in owners)
    else:
        assert changed == later | first and lost == dict(enumerate(planted_words))
