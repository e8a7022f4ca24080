"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.plans import catalogue, checks, inspected, logs, published  # noqa: F401  they register their queries
from lectern.plans.catalogue import ORACLES, QUERIES
from lectern.sources import contract

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(DATA):
        c.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return c


def plain(rows):
    one = lambda x: None if x is None or isinstance(x, float) and math.isnan(x) or str(x) in ("<NA>", "None", "nan") else float(x) if isinstance(x, int | float) else str(x)
    return sorted((tuple(map(one, r)) for r in rows.astype(object).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert plain(got[columns]) == plain(want[columns])


def test_logs_are_made_line_by_line(spark):
    rows = catalogue._log_lines(spark, DATA)
    got = {s: [r["line"] for r in sorted(rows.where(F.col("source") == s).collect(), key=lambda r: r["line_no"])] for s in ("s0", "s1", "s2", "s3")}
    assert all("\n" not in line for lines in got.values() for line in lines)
    files = spark.createDataFrame([(s, "".join(f"{x}\n" for x in lines).encode()) for s, lines in got.items()], "source string, content binary")
    told = lambda log: sorted(tuple(r) for r in log.select("source", "line_no", "line", "ended", "valid").collect())
    assert told(contract.records(rows)) == told(contract.lines(files))
    assert contract.violations(contract.records(rows)).collect() == []


def test_archives_are_packed_without_their_documents_at_once(spark):
    zips = published._zips(spark, DATA)
    assert "FlatMapGroupsInPandas" not in zips._jdf.queryExecution().toString()
    assert zips.count() == zips.select("archive").distinct().count() == spark.read.parquet(f"{DATA}/documents.parquet").select("lang", "source").distinct().count()
