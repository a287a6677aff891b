from wordloom.session import scratch_path
from wordloom.streaming.word_counts import streaming_word_counts


def test_streaming_counts_match_batch(spark):
    src = scratch_path(spark, "stream-src")
    spark.createDataFrame([("a b a\nc",), ("b  a",)], "value string").write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema("value string").parquet(src)
    q = (streaming_word_counts(stream).writeStream.outputMode("complete").format("memory").queryName("wc_test")
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).start())
    q.processAllAvailable()
    try:
        got = {r["word"]: r["cnt"] for r in spark.sql("SELECT * FROM wc_test").collect()}
    finally:
        q.stop()
    assert got == {"a": 3, "b": 2, "c": 1}
