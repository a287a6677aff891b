import pytest
from pyspark.sql import functions as F

from fixtures import corpus_df
from wordloom.operators import noise as N
from wordloom.operators import tokenize as T
from wordloom.operators import vocab as V


def vocab_of(spark, lines, min_count=1):
    return V.build_vocab(T.tokenize(corpus_df(spark, lines)), min_count)


def counts(vocab):
    return {r["word"]: r["cnt"] for r in vocab.collect()}


def test_word_counts(spark):
    v = vocab_of(spark, ["a a a b b c"])
    assert counts(v) == {"a": 3, "b": 2, "c": 1}
    look = V.word_count_lookup(spark.createDataFrame([("a",), ("z",)], "word string"), v)
    assert {r["word"]: r["cnt"] for r in look.collect()} == {"a": 3, "z": 0}


def test_sorted_by_frequency_then_bytes(spark):
    v = vocab_of(spark, ["a a a b b c", "d d"]).orderBy("idx").collect()
    assert [r["word"] for r in v] == ["a", "b", "d", "c"]
    assert [r["idx"] for r in v] == [0, 1, 2, 3]


def test_len(spark):
    assert vocab_of(spark, ["hello world hello"]).count() == 2


def test_min_count(spark):
    assert set(counts(vocab_of(spark, ["a a a b b c c"], 2))) == {"a", "b", "c"}
    small = vocab_of(spark, ["a a a b"], 2)
    with pytest.raises(V.CorpusTooSmallError):
        V.check_trainable(V.collect_stats(small))
    assert set(counts(vocab_of(spark, ["a a b b"], 2))) == {"a", "b"}


def test_empty_corpus_errors(spark):
    with pytest.raises(V.EmptyVocabularyError):
        V.check_trainable(V.collect_stats(vocab_of(spark, [""])))
    with pytest.raises(V.EmptyVocabularyError):
        V.check_trainable(V.collect_stats(vocab_of(spark, [])))


def test_unicode_whitespace_and_blank_lines(spark):
    lines = ["a b　c", "   ", "\t\r", "d\r"]
    toks = T.tokenize(corpus_df(spark, lines)).orderBy("doc_id", "pos").collect()
    assert [r["word"] for r in toks] == ["a", "b", "c", "d"]
    assert T.nonblank_lines(corpus_df(spark, lines)).count() == 2


def test_corpus_lines_split(spark):
    from wordloom.sources.corpus import lines_from_text
    df = spark.createDataFrame([(1, "x y\r\nz\n\nw\n")], "doc_id bigint, text string")
    got = [(r["line_no"], r["line"]) for r in lines_from_text(df).orderBy("line_no").collect()]
    assert got == [(0, "x y"), (1, "z"), (2, ""), (3, "w")]


def test_distributed_rank_is_partition_independent(spark):
    lines = [f"w{i % 37} w{i % 11} w{i % 5}" for i in range(300)]
    base = [tuple(r) for r in vocab_of(spark, lines).orderBy("idx").collect()]
    for parts in (1, 3, 7):
        df = corpus_df(spark, lines).repartition(parts)
        v = V.build_vocab(T.tokenize(df), 1)
        assert [tuple(r) for r in v.orderBy("idx").collect()] == base


def test_noise_distribution_and_table(spark):
    v = vocab_of(spark, ["a a a b b c"])
    d = N.noise_distribution(v).orderBy("idx").collect()
    ps = [3 ** 0.75, 2 ** 0.75, 1.0]
    s = sum(ps)
    for r, p in zip(d, ps):
        assert abs(r["p"] - p / s) < 1e-12
    assert d[0]["lo"] == 0.0 and d[-1]["hi"] == 1.0
    assert all(d[i]["hi"] == d[i + 1]["lo"] for i in range(len(d) - 1))
    nb = N.bucket_count(3)
    table = N.noise_table(N.noise_distribution(v), nb, 3)
    assert table.count() == 1_000_000
    shares = {r["idx"]: r["n"] / 1e6 for r in table.groupBy("idx").agg(F.count("*").alias("n")).collect()}
    for i, p in enumerate(ps):
        assert abs(shares[i] - p / s) < 1e-5
    shifted = N.noise_table(N.noise_distribution(v), nb, 3, shifted=True)
    sh = {r["idx"]: r["n"] for r in shifted.groupBy("idx").agg(F.count("*").alias("n")).collect()}
    assert 0 not in sh and abs(sh[2] / 1e6 - (ps[1] + ps[2]) / s) < 1e-5


def test_negative_draws_in_range(spark):
    v = vocab_of(spark, ["the cat sat on the mat"])
    d = N.noise_distribution(v)
    nb = N.bucket_count(5)
    draws = spark.range(1000).select((F.col("id") / 1000.0).alias("u"))
    got = N.lookup_draws(draws, N.noise_buckets(d, nb), nb, 5).collect()
    assert len(got) == 1000
    assert all(0 <= r["neg"] < 5 for r in got)
