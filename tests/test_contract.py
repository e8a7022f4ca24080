import hashlib
import json
import random
import time

import pytest
from logs import entry, log, records, value

from pyspark.sql import functions as F

from lectern.operators.sequences import ordered_digest, scanned
from lectern.sources import contract

ENTRIES = [entry(0, "verse", "Gen", 1, 1, "one"), entry(1, "verse", "Gen", 1, 2, "two")]


def broken(spark, text, **more):
    files = spark.createDataFrame([("s", bytearray(text.encode() if isinstance(text, str) else text))], "source string, content binary")
    return {r["rule"] for r in contract.violations(contract.lines(files), **more).collect()}


def test_a_good_log_breaks_no_rule(spark):
    assert broken(spark, log(records(ENTRIES))) == set()


def changed(at, **new):
    rows = records(ENTRIES)
    rows[at] = {k: v for k, v in (rows[at] | new).items() if v is not None}
    return log(rows)


CASES = [
    (lambda: log(records(ENTRIES)).replace("\n", "\r\n"), "line end"),
    (lambda: log(records(ENTRIES))[:-1], "line end"),
    (lambda: log(records(ENTRIES), stream_sha256="0"), "stream sha256"),
    (lambda: log(records(ENTRIES), success=False), "success"),
    (lambda: log(records(ENTRIES), entries=7), "entries"),
    (lambda: log(records(ENTRIES), artifacts=7), "artifacts"),
    (lambda: log(records(ENTRIES), artifact_bytes=7), "artifact bytes"),
    (lambda: log(records(ENTRIES), counts={"entry": 1}), "record counts"),
    (lambda: log(records(ENTRIES), diagnostics={"error": 1, "warning": 1, "info": 0}), "diagnostics"),
    (lambda: changed(3, sequence=9), "sequence"),
    (lambda: changed(3, ordinal=9), "ordinal"),
    (lambda: changed(0, command="list"), "header"),
    (lambda: changed(0, producer=""), "producer"),
    (lambda: changed(0, type="module"), "header first"),
    (lambda: changed(2, type="module"), "one module"),
    (lambda: changed(3, type="header"), "one header"),
    (lambda: changed(3, type="module"), "order"),
    (lambda: changed(4, artifact_id=3), "artifact id"),
    (lambda: changed(5, artifact_id=3), "artifact group"),
    (lambda: changed(5, index=4), "chunk index"),
    (lambda: changed(7, size=4), "artifact size"),
    (lambda: changed(7, sha256="x"), "artifact sha256"),
    (lambda: changed(5, type="artifact_begin"), "artifact overlap"),
    (lambda: changed(2, stripped=value("two") | {"size": 9}), "byte value stripped"),
    (lambda: changed(2, stripped=value("two") | {"base64": "dHdv="}), "byte value stripped"),
    (lambda: changed(2, stripped=value("two") | {"sha256": "0"}), "byte value stripped"),
    (lambda: changed(2, stripped=value("two") | {"more": 1}), "byte value stripped"),
    (lambda: changed(2, stripped=value("two") | {"utf8": "other"}), "byte value stripped"),
    (lambda: changed(2, other={"deep": [value("two") | {"size": 9}]}), "byte value elsewhere"),
    (lambda: changed(2, type=""), "record type"),
    (lambda: log(records(ENTRIES)) + json.dumps({"sequence": 10, "type": "diagnostic"}) + "\n", "after footer"),
    (lambda: "".join(log(records(ENTRIES)).splitlines(True)[:-1]), "missing footer"),
    (lambda: log(records(ENTRIES)).replace('{"sequence": 2', '["sequence": 2'), "JSON object"),
    (lambda: log(records(ENTRIES)).encode().replace(b"xx", b"\xff\xff", 1), "UTF-8"),
]


@pytest.fixture(scope="module")
def all_broken(spark):
    """Every case is a source of one table, as logs come in bulk."""
    made = [text() for text, _ in CASES]
    files = spark.createDataFrame([(str(i), bytearray(t.encode() if isinstance(t, str) else t)) for i, t in enumerate(made)], "source string, content binary")
    out = {str(i): set() for i in range(len(CASES))}
    for r in contract.violations(contract.lines(files)).collect():
        out[r["source"]].add(r["rule"])
    return out


@pytest.mark.parametrize("i", range(len(CASES)), ids=[f"{i}-{rule}" for i, (_, rule) in enumerate(CASES)])
def test_each_broken_rule_is_a_row(all_broken, i):
    assert CASES[i][1] in all_broken[str(i)]


def test_expectations_and_unknown_types(spark):
    rows = records(ENTRIES)
    rows[8] = rows[8] | {"type": "novelty"}
    files = spark.createDataFrame([("s", bytearray(log(rows, diagnostics=None).encode()))], "source string, content binary")
    read = contract.lines(files)
    assert contract.summary(read).first()["unknown_types"] == ["novelty"]
    wanted = spark.createDataFrame([("s", "Other", "lexicon")], "source string, module string, classification string")
    assert {"module", "classification"} <= {r["rule"] for r in contract.violations(read, wanted).collect()}
    with pytest.raises(ValueError):
        contract.require_none(contract.violations(read, wanted))


def test_artifacts_are_joined_in_order(spark):
    files = spark.createDataFrame([("s", bytearray(log(records(ENTRIES)).encode()))], "source string, content binary")
    got = contract.artifacts(contract.lines(files)).first()
    assert (got["path"], bytes(got["content"])) == ("a/b.txt", b"ab\xff")


def test_no_files(spark):
    files = spark.createDataFrame([], "source string, content binary")
    assert contract.violations(contract.lines(files)).collect() == []


def test_a_file_read_by_ranges_has_the_lines_of_one_read_whole(spark, tmp_path, monkeypatch):
    texts = [log(records(ENTRIES)), log(records(ENTRIES))[:-1], log(records(ENTRIES)).replace("\n", "\r\n"), "\n\na\n\n", "é\n" * 400 + "x", ""]
    raw = [t.encode() for t in texts] + [b"\xff\xfe\nok\n"]
    for i, t in enumerate(raw):
        (tmp_path / f"{i}.ndjson").write_bytes(t)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = contract.read(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 10
        got = {(r["source"].rpartition("/")[2][0], r["line_no"], r["line"], r["ended"], r["valid"]) for r in found.where("valid").collect()}
        bad = [tuple(r) for r in found.where("NOT valid").select(F.substring_index("source", "/", -1), "line_no", F.hex("line")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = spark.createDataFrame([(str(i), bytearray(t)) for i, t in enumerate(raw)], "source string, content binary")
    assert got == {(r["source"], r["line_no"], r["line"], r["ended"], r["valid"]) for r in contract.lines(files).where("valid").collect()}
    assert bad == [("6.ndjson", 0, "FFFE")]


@pytest.mark.parametrize("block", [1, 3])
def test_blocks_of_lines_find_what_whole_logs_show(spark, all_broken, block):
    made = [text() for text, _ in CASES]
    files = spark.createDataFrame([(str(i), bytearray(t.encode() if isinstance(t, str) else t)) for i, t in enumerate(made)], "source string, content binary")
    got = {str(i): set() for i in range(len(CASES))}
    for r in contract.violations(contract.lines(files), block=block).collect():
        got[r["source"]].add(r["rule"])
    assert got == all_broken


def test_digests_of_many_chunks_take_them_one_by_one(spark):
    parts = spark.range(60_000).select(F.lit("s").alias("source"), (F.col("id") % 2).alias("artifact_id"), F.col("id").alias("i"), F.rpad(F.col("id").cast("string"), 500, "x").alias("data"))
    began = time.monotonic()
    got = {r["artifact_id"]: r["sha256"] for r in ordered_digest(parts, ["source", "artifact_id"], ["i"], F.col("data")).collect()}
    assert time.monotonic() - began < 40
    assert got == {k: hashlib.sha256("".join(f"{n}".ljust(500, "x") + "\n" for n in range(k, 60_000, 2)).encode()).hexdigest() for k in (0, 1)}
    rows = spark.createDataFrame([(None, 1, "a"), ("g", 2, None), (None, 0, "b")], "g string, o int, t string")
    assert {(r["g"], r["n_lines"], r["sha256"]) for r in ordered_digest(rows, ["g"], ["o"], F.col("t")).collect()} == {(None, 2, hashlib.sha256(b"b\na\n").hexdigest()), ("g", 1, hashlib.sha256(b"\n").hexdigest())}
    assert ordered_digest(rows.where("o > 9"), ["g"], ["o"], F.col("t")).collect() == []


def test_running_values_by_blocks(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", None, "b"]), n, rng.choice([None, 1, 2, 5]), rng.choice([None, "x", "y"])) for n in range(200)]
    frame = spark.createDataFrame(rows, "g string, n int, v int, t string")
    got = scanned(frame, ["g"], "n", F.floor(F.col("n") / 7), {"sum": F.coalesce("v", F.lit(0))}, {"most": F.col("v")}, {"last": F.col("t")}).collect()
    seen = {}
    want = []
    for g, n, v, t in rows:
        before = seen.setdefault(g, [0, None, None])
        before[2] = t or before[2]
        want.append((g, n, before[0], before[1], before[2]))
        before[0] += v or 0
        before[1] = max(filter(None, (before[1], v)), default=None)
    assert sorted(((r["g"], r["n"], r["sum"], r["most"], r["last"]) for r in got), key=lambda r: r[1]) == want
