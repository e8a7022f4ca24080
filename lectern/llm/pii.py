"""Personal data by generated candidates and boosted trees (operator 4), in DataFrame functions alone."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import spare, table

KINDS = ["email", "ip", "card", "phone"]
TREES, DEPTH = 10, 3
#: Share of right spans that a kind's threshold must reach on the documents kept from the fit, and how many must show it.
PRECISION, SHOWN = 0.95, 20

# The fixed patterns. A possessive quantifier or a start that must not lie within a run changes no match here, but
# keeps long runs from being tried again from each of their places. \G lets a match begin where the last ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# What may be personal data besides.
AT_DOT = r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+)++"
LOCAL_PHONE = r"(?<![0-9+])\(?[0-9]{2,4}+\)?[\x20.-][0-9][0-9\x20().-]{5,20}[0-9](?![0-9])"
SPACED_CARD = r"(?<![0-9])[0-9]{4}+(?:[._/][0-9]{4}+){2}[._/][0-9]{1,7}+(?![0-9])"
IP_PORT = r"(?<![0-9.])[0-9]{1,3}+(?:\x20?\.\x20?|\[\.\])[0-9]{1,3}+(?:\x20?\.\x20?|\[\.\])[0-9]{1,3}+(?:\x20?\.\x20?|\[\.\])[0-9]{1,3}+(?![0-9.])"

WORDS = {
    "email": r"mail|contact|write|correo|courriel|schreib",
    "ip": r"\bip\b|addr|host|server|login|from",
    "card": r"card|visa|credit|debit|pay|tarjeta|carte|karte",
    "phone": r"phone|tel|call|fax|mobile|anruf|llama",
}


def let(value: Column, body) -> Column:  # noqa: ANN001
    """body of value, which is computed once, however often body has it and within whatever loops."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def matches(text: Column, pattern: str) -> Column:
    """array of (start, end, value, before, after) of a pattern's leftmost matches that don't overlap. start and end
    count code points; before and after are up to 24 and 8 characters of the text between matches.

    What lies between the matches gives their places: sums of lengths, taken block by block so that a text with
    very many matches doesn't take the square of their number."""
    cut = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))

    def spans(x: Column) -> Column:
        sizes = F.zip_with(x["found"], x["gaps"], lambda value, gap: F.length(gap) + F.coalesce(F.length(value), F.lit(0)))
        return let(let(sizes, running), lambda ends: F.transform(x["found"], lambda value, i: span(x, ends, value, i)))

    def span(x: Column, ends: Column, value: Column, i: Column) -> Column:
        return F.struct(
            (F.get(ends, i) - F.length(value)).cast("int").alias("start"), F.get(ends, i).cast("int").alias("end"), value.alias("value"),
            F.right(F.get(x["gaps"], i), F.lit(24)).alias("before"), F.left(F.get(x["gaps"], i + 1), F.lit(8)).alias("after"),
        )

    return let(cut, spans)


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def running(sizes: Column, block: int = 64) -> Column:
    """Running sums of a lambda's array that isn't empty."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / block).cast("int"))
    part = lambda b: F.slice(sizes, b * block + 1, block)
    within = lambda p, before: F.transform(p, lambda _, i: before + total(F.slice(p, 1, i + 1)))
    return let(
        F.transform(blocks, lambda b: total(part(b))),
        lambda sums: F.flatten(F.transform(blocks, lambda b: let(F.struct(part(b).alias("p"), total(F.slice(sums, 1, b)).alias("before")), lambda x: within(x["p"], x["before"])))),
    )


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass the Luhn check."""
    weighed = F.transform(F.split(F.reverse(digits(value)), ""), lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise((c.try_cast("int") * 2) % 10 + F.floor(c.try_cast("int") * 2 / 10).cast("int")))
    return F.aggregate(F.filter(weighed, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(rank: int, value: Column) -> Column:
    """Whether a match of a kind's fixed pattern is one of that kind."""
    n = F.length(digits(value))
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return [F.lit(True), value.rlike(rf"^{part}\.{part}\.{part}\.{part}$"), F.when(n.between(12, 19), luhn(value)).otherwise(False), n.between(9, 15)][rank]


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")


def _kind(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), m["value"].alias("value"), m["before"].alias("before"), m["after"].alias("after")))


def fixed(text: Column) -> list[Column]:
    """All matches of the fixed patterns, by kind; a text without a sign that a pattern needs isn't searched."""
    number = text.rlike("[0-9][ .()-]{0,2}[0-9]")
    needs = [text.contains("@"), number & text.rlike(r"[0-9]\.[0-9]"), number, text.rlike(r"\+[0-9]")]
    return [_kind(F.when(need, matches(text, p)).otherwise(_none()), k) for k, (need, p) in enumerate(zip(needs, (EMAIL, IP, CARD, PHONE), strict=True))]


def generated(text: Column) -> Column:
    """Candidates besides the fixed patterns. Each need is a part that every match of its pattern has."""
    at = text.rlike(r"(?i)(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)")
    address, number = text.rlike(r"[0-9](?:\x20?\.\x20?|\[\.\])[0-9]"), text.rlike("[0-9]{2}[^0-9]{1,5}[0-9]")
    pairs = [(0, at, AT_DOT), (1, address, IP_PORT), (2, number, SPACED_CARD), (3, number, LOCAL_PHONE)]
    return F.concat(*[_kind(F.when(need, matches(text, p)).otherwise(_none()), k) for k, need, p in pairs])


def plainer(rank: int, value: Column) -> Column:
    """A candidate as its kind's fixed pattern would have it: signs spelled out, and what parts digits gone."""
    at = F.regexp_replace(value, r"(?i)\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?", "@")
    dot = F.regexp_replace(at, r"(?i)\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?", ".")
    return [dot, F.regexp_replace(value, r"[\x20\[\]]", ""), digits(value), digits(value)][rank]


def right(m: Column) -> Column:
    """Whether a candidate, made plainer, is what its kind's fixed pattern finds and passes its check: the label that
    the trees learn."""
    found = F.lit(False)
    for k, whole in enumerate([r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$", r"^[0-9.]+$", r"^[0-9]+$", r"^[0-9]+$"]):
        value = plainer(k, m["value"])
        found = F.when(m["rank"] == k, F.coalesce(value.rlike(whole) & valid(k, value), F.lit(False))).otherwise(found)
    return found


def features(m: Column) -> list[Column]:
    """Numbers that tell a candidate's format and context; what a kind's own check looks at isn't among them."""
    value, flag = m["value"], lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    count = lambda p: F.length(F.regexp_replace(value, p, "")).cast("double")
    before = F.lower(m["before"])
    return [
        m["rank"].cast("double"), F.length(value).cast("double"), count("[^0-9]"), count("[^A-Za-z]"), count(r"[^\x20]"), count(r"[^.]"), count("[^-]"), count("[^()]"),
        F.size(F.split(value, "[^0-9]+")).cast("double"), flag(value.rlike("^[0-9]+$")), flag(value.rlike("[0-9]{4}$")),
        *[flag(before.rlike(WORDS[k])) for k in KINDS],
        flag(before.rlike(r"(^|[\s:(])$")), flag(m["after"].rlike(r"^($|[\s.,;:!?)])")), flag(before.rlike(r"[#=/]$|\bno\.?\s?$|\bid\s?$")),
    ]


def tree(lines: list[str], at: list[Column]) -> Column:
    """A tree in the text form of the library, as a CASE expression over features."""
    line = lines.pop(0).strip()
    if found := re.match(r"Predict: (\S+)", line):
        return F.lit(float(found[1]))
    test = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
    left = tree(lines, at)
    lines.pop(0)  # Else
    return F.when(at[int(test[1])] <= float(test[2]), left).otherwise(tree(lines, at))


class Trees:
    """Boosted trees as (text form, weight) and a least probability for each kind; over 1 where none is safe."""

    def __init__(self, trees: list[tuple[str, float]], least: list[float]) -> None:
        self.trees, self.least = trees, least

    def probability(self, at: list[Column]) -> Column:
        margin = reduce(lambda a, b: a + b, [F.lit(w) * tree(text.splitlines()[1:], at) for text, w in self.trees], F.lit(0.0))
        return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2)), 6)  # as thresholds are of what is given here


def candidates(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(kept, label, rank, a column for each feature, n) and the features' names: n candidates of all documents, the
    fixed patterns' and the generators', agree in the rest. kept are those of a quarter of the documents, by their
    ids. Features are few small numbers, so there are far fewer rows than candidates."""
    text, m = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("m")
    of = docs.select("doc_id", F.explode(F.array_distinct(F.concat(*fixed(text), generated(text)))).alias("m"))
    at = {f"f{i}": x for i, x in enumerate(features(m))}
    kept = (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0).alias("kept")
    rows = of.select(kept, right(m).cast("double").alias("label"), m["rank"].alias("rank"), *[x.alias(n) for n, x in at.items()])
    return rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias("n")), list(at)


def trained(docs: DataFrame) -> Trees:
    """Trees fitted on all candidates of all documents but those kept from the fit, equal ones as one with their number
    as its weight. Labels are what right() says; the trees see format and context alone. A kind's threshold is the
    least probability from which on PRECISION of its candidates in the documents kept from the fit are right."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    none = Trees([], [2.0] * len(KINDS))
    rows, names = candidates(docs)
    rows = rows.persist()
    try:
        seen = rows.where("NOT kept").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).first()
        if seen["low"] != 0.0 or seen["high"] != 1.0:
            return none
        whole = VectorAssembler(inputCols=names, outputCol="features").transform(rows.where("NOT kept"))
        bins = max(32, math.isqrt(seen["size"]) + 1)  # the library finds splits on a sample of rows if they are more than the square of this
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=bins, seed=7, stepSize=0.3, cacheNodeIds=False, weightCol="n").fit(whole)
        fitted = Trees([(t.toDebugString, float(w)) for t, w in zip(model.trees, model.treeWeights, strict=True)], none.least)
        scores = rows.where("kept").select("rank", "label", "n", fitted.probability([F.col(n) for n in names]).alias("p"))
        levels = scores.groupBy("rank", "p").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("right"))
        above = Window.partitionBy("rank").orderBy(F.desc("p"))
        levels = levels.select("rank", "p", F.sum("n").over(above).alias("n"), F.sum("right").over(above).alias("right"))
        safe = levels.where((F.col("n") >= SHOWN) & (F.col("right") >= PRECISION * F.col("n")))
        for r in safe.groupBy("rank").agg(F.min("p").alias("p")).collect():
            fitted.least[r["rank"]] = r["p"]
    finally:
        rows.unpersist()
    return fitted


def _passed(spans: Column, rank: int) -> Column:
    return F.filter(spans, lambda m: valid(rank, m["value"]))


def _of_kind(rank: int) -> Column:
    # A lambda with a second argument, a default one too, would be given the place in the array there.
    return F.filter("base", lambda m: m["rank"] == rank)


def spotted(docs: DataFrame, trees: Trees, base: str = "base", added: str = "added") -> DataFrame:
    """docs with base and added: arrays of (start, rank, end, value, ...) by start, then kind. base are the fixed
    patterns' matches that pass. added are other candidates whose probability reaches their kind's threshold; one
    that overlaps base or a likelier one (of equals, an earlier one) isn't added. A null text counts as empty."""
    text, found, scored = F.coalesce(F.col("text").cast("string"), F.lit("")), spare(docs, "found"), spare(docs, "scored")
    passing = [_passed(spans, k) for k, spans in enumerate(fixed(text))]
    rows = docs.withColumn(base, F.array_sort(F.concat(*passing)))
    if not trees.trees or min(trees.least) > 1:
        return rows.withColumn(added, F.filter(base, lambda m: F.lit(False)))
    least = F.array(*[F.lit(float(x)) for x in trees.least])
    rows = rows.withColumn(found, F.filter(generated(text), lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))))
    of = F.transform(found, lambda m: F.struct(trees.probability(features(m)).alias("p"), m.alias("m")))
    rows = rows.withColumn(scored, F.when(F.size(found) > 0, F.filter(of, lambda s: s["p"] >= F.get(least, s["m"]["rank"]))).otherwise(F.filter(of, lambda s: F.lit(False))))
    better = lambda s, o: (o["m"]["start"] < s["m"]["end"]) & (s["m"]["start"] < o["m"]["end"]) & ((o["p"] > s["p"]) | (o["p"] == s["p"]) & ((o["m"]["start"] < s["m"]["start"]) | (o["m"]["start"] == s["m"]["start"]) & (o["m"]["rank"] < s["m"]["rank"])))
    chosen = F.filter(scored, lambda s: ~F.exists(scored, lambda o: better(s, o)))
    return rows.withColumn(added, F.array_sort(F.transform(chosen, lambda s: s["m"]))).drop(found, scored)


def shown(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat(F.get(name, m["rank"]), F.lit(":"), m["start"].cast("string"), F.lit(":"), m["end"].cast("string"))), ",")


def digests(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): counts and digest of the base spans, all
    spans, and the number that the trees added."""
    rows = spotted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), trees)
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redacted(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """docs with each run of overlapping spans replaced by its first span's kind, as in [EMAIL], and n_chars, if
    there is one, set anew where that happens. Null texts stay null, empty ones empty; texts may be of any length, rows
    repeated whole and ids with several texts are rows of their own, an empty table gives an empty one, and other columns
    pass, whatever their names."""
    trees = trees or trained(docs)
    base, added, every, runs = (spare(docs, x) for x in ("base", "added", "every", "runs"))
    rows = spotted(docs, trees, base, added).withColumn(every, F.array_sort(F.concat(base, added)))
    empty = F.array().cast("array<struct<a:int,b:int,rank:int>>")
    run = lambda a, b, rank: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), rank.cast("int").alias("rank"))
    # Runs grow at the end of the array, which is short next to its text.
    joined = F.aggregate(every, empty, lambda got, m: F.when((F.size(got) > 0) & (m["start"] < F.element_at(got, -1)["b"]), F.concat(F.slice(got, 1, F.size(got) - 1), F.array(run(F.element_at(got, -1)["a"], F.greatest(F.element_at(got, -1)["b"], m["end"]), F.element_at(got, -1)["rank"])))).otherwise(F.concat(got, F.array(run(m["start"], m["end"], m["rank"])))))
    rows = rows.withColumn(runs, F.when(F.size(every) > 0, joined).otherwise(empty))
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    piece = F.transform(runs, lambda r, i: F.concat(F.substring(F.col("text"), F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["b"]) + 1, r["a"] - F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["b"])), F.get(name, r["rank"])))
    hidden = F.concat(F.array_join(piece, ""), F.substring(F.col("text"), F.element_at(runs, -1)["b"] + 1, F.length("text")))
    rows = rows.withColumn("text", F.when(F.size(runs) > 0, hidden).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size(runs) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digests(docs, trained(docs))
