from pyspark.sql import functions as F

from lectern.streaming.ranges import ranges_of_batches, windowed_counts


def test_streams(spark, tmp_path):
    rows = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id AS int)) AS ts, cast(id % 2 AS int) AS k, id AS at, id % 3 = 1 AS start FROM range(12)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = windowed_counts(stream, "ts", "5 minutes", "1 minute", "k").writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["n"] for r in spark.table("counts").collect()) == [1, 1, 2, 2, 3, 3]
    got = []
    q = stream.writeStream.foreachBatch(ranges_of_batches(["k"], "at", F.col("start"), lambda df, n: got.extend(df.collect()))).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["k"], r["start"], r["end"]) for r in got) == [(0, 0, 2), (0, 4, 8), (0, 10, 10), (1, 1, 5), (1, 7, 11)]
