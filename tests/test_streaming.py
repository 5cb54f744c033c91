from pyspark.sql import functions as F

from stemma.streaming import ingest


def test_stream(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    rows = [(1, "a", "2024-01-01 10:00:00"), (1, "a", "2024-01-01 11:00:00"), (2, "b", "2024-01-02 10:00:00"), (3, "a", None)]
    df = spark.createDataFrame(rows, "id int, lang string, at string").withColumn("at", F.col("at").cast("timestamp"))
    df.coalesce(1).write.parquet(src)
    stream = ingest.delivered(spark, src, "id int, lang string, at timestamp")
    ingest.upsert_slices(ingest.once(stream, ["id"], "at"), out, "lang", str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.id, r.lang) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "b")]
    q = ingest.counts(stream, "at", ["lang"]).writeStream.format("memory").queryName("c").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.lang, r.n) for r in spark.table("c").where("window_start is not null").collect()} == {("a", 2), ("b", 1)}
