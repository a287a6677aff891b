from fixtures import TEMPLATES, corpus_df, cycled
from wordloom.plans.jobs import query_job, train_job
from wordloom.session import scratch_path


def test_train_and_query_jobs(spark):
    out = scratch_path(spark, "job")
    info = train_job(spark, corpus_df(spark, cycled(TEMPLATES, 16)), out, embedding_dim=8, epochs=1,
                     shards=1, rounds_per_epoch=1)
    assert info["vocab_size"] > 10 and len(info["history"]) == 1
    assert spark.read.parquet(f"{out}/neighbor_sample").count() == 25
    assert spark.read.parquet(f"{out}/pca").count() == info["vocab_size"]
    assert spark.read.json(f"{out}/training_history").count() == 1
    q = scratch_path(spark, "job-q")
    query_job(spark, f"{out}/model", q,
              pairs=spark.createDataFrame([("king", "queen"), ("king", "nope")], "word_a string, word_b string"),
              near=spark.createDataFrame([("paris",)], "word string"),
              analogies=spark.createDataFrame([("king", "man", "woman")], "pos_a string, neg_a string, pos_b string"))
    sims = {r["word_b"]: r for r in spark.read.parquet(f"{q}/similarity").collect()}
    assert sims["nope"]["is_oov"] and not sims["queen"]["is_oov"]
    assert spark.read.parquet(f"{q}/near").count() == 10
    assert spark.read.parquet(f"{q}/analogy").count() == 5


def test_text_file_corpus(spark, tmp_path):
    from wordloom.sources.corpus import text_file_lines
    p = tmp_path / "corpus.txt"
    p.write_text("the cat sat\r\non the mat\n\nthe end\n")
    lines = sorted(r["line"] for r in text_file_lines(spark, str(p)).collect())
    assert lines == ["", "on the mat", "the cat sat", "the end"]


def test_only_line_feeds_end_lines_and_keys_ignore_splits(spark, tmp_path):
    from wordloom.sources.corpus import text_file_lines
    (tmp_path / "a.txt").write_bytes(b"a b\rc d\r\ne f\r\r\ng h")
    (tmp_path / "b.txt").write_bytes(b"".join(b"line %d\n" % i for i in range(500)))
    seen = []
    for size in ("128m", "700b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        seen.append(sorted((r["doc_id"], r["line"]) for r in text_file_lines(spark, str(tmp_path)).collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1]
    assert [x for _, x in seen[0]][:3] == ["a b\rc d", "e f\r", "g h"]
    assert [d for d, _ in seen[0]] == list(range(503))
