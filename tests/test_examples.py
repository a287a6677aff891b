from pyspark.sql import functions as F

from fixtures import corpus_df, cycled, TEMPLATES
from wordloom.operators import examples as E
from wordloom.operators import noise as N
from wordloom.operators import tokenize as T
from wordloom.operators import vocab as V


def prep(spark, lines, threshold=None, parts=None):
    df = corpus_df(spark, lines)
    if parts:
        df = df.repartition(parts)
    tokens = T.tokenize(df)
    vocab = V.build_vocab(tokens, 1)
    st = V.collect_stats(vocab)
    enc = E.encode_lines(tokens, vocab, st.vocab_size, st.total_tokens, threshold)
    return vocab, st, enc


def test_windows_respect_bounds(spark):
    sents = spark.createDataFrame([(0, 0, [0, 1, 2, 3, 4])], "doc_id bigint, line_no int, t array<bigint>")
    ex = E.centre_examples(sents, 2, 42, 0).orderBy("p").collect()
    assert len(ex) == 5
    for r in ex:
        assert 1 <= r["win"] <= 2
        want = [q for q in range(5) if q != r["p"] and abs(q - r["p"]) <= r["win"]]
        assert r["context"] == want and r["center"] == r["p"]


def test_repeated_word_in_window_kept(spark):
    sents = spark.createDataFrame([(0, 0, [7, 7, 7])], "doc_id bigint, line_no int, t array<bigint>")
    ex = E.centre_examples(sents, 1, 42, 0).collect()
    assert all(set(r["context"]) == {7} for r in ex)
    assert sum(len(r["context"]) for r in ex) == 4


def test_oov_dropped_and_positions_renumbered(spark):
    vocab = spark.createDataFrame([(0, "a", 5), (1, "b", 3)], "idx bigint, word string, cnt bigint")
    toks = T.tokenize(corpus_df(spark, ["a x b y a"]))
    enc = E.encode_lines(toks, vocab, 2, 8, None)
    s = E.sample_sentences(enc, 42, 0).collect()
    assert s[0]["t"] == [0, 1, 0]


def test_subsampling_keeps_rare_words(spark):
    lines = cycled(TEMPLATES, 40)
    vocab, st, enc = prep(spark, lines, threshold=1e-3)
    kept = E.sample_sentences(enc, 42, 0, min_len=0).select(F.explode("t").alias("i"))
    counts = {r["i"]: r["n"] for r in kept.groupBy("i").agg(F.count("*").alias("n")).collect()}
    full = {r["idx"]: r["cnt"] for r in vocab.collect()}
    assert sum(counts.values()) < st.total_tokens
    assert counts.get(0, 0) < full[0]          # the most frequent word is thinned
    # A word of probability 1 keeps every token.
    keep = {r["idx"]: r["keep"] for r in V.with_keep_probability(vocab, st.total_tokens, 2e-2).collect()}
    _, _, mild = prep(spark, lines, threshold=2e-2)
    left = E.sample_sentences(mild, 42, 0, min_len=0).select(F.explode("t").alias("i")).groupBy("i").count()
    left = {r["i"]: r["count"] for r in left.collect()}
    rare = [i for i, k in keep.items() if k >= 1.0]
    assert rare and len(rare) < len(keep) and all(left[i] == full[i] for i in rare)


def test_keyed_draws_do_not_depend_on_partitioning(spark):
    lines = cycled(TEMPLATES, 64)

    def run(parts):
        vocab, st, enc = prep(spark, lines, threshold=1e-3, parts=parts)
        d = N.noise_distribution(vocab)
        nb = N.bucket_count(st.vocab_size)
        ex = E.centre_examples(E.sample_sentences(enc, 42, 1), 5, 42, 1)
        full = E.with_negatives(ex, 5, 42, 1, N.noise_buckets(d, nb), nb, st.vocab_size)
        return sorted(tuple(r) for r in full.select("doc_id", "line_no", "p", "center",
                                                     F.array_join("context", ","),
                                                     F.array_join("negatives", ",")).collect())
    a = run(1)
    assert a == run(4) == run(7)
    assert len(a) > 0


def test_negatives_have_k_per_centre(spark):
    lines = cycled(TEMPLATES, 16)
    vocab, st, enc = prep(spark, lines)
    d = N.noise_distribution(vocab)
    nb = N.bucket_count(st.vocab_size)
    ex = E.centre_examples(E.sample_sentences(enc, 42, 0), 5, 42, 0)
    full = E.with_negatives(ex, 5, 42, 0, N.noise_buckets(d, nb), nb, st.vocab_size).collect()
    assert all(len(r["negatives"]) == 5 for r in full)
    assert all(0 <= n < st.vocab_size for r in full for n in r["negatives"])


def test_estimate_pairs(spark):
    _, _, enc = prep(spark, ["a b c", "d", "e f"])
    assert E.estimate_pairs(enc, 5).first()["estimate"] == (2 + 0 + 1) * 10


def test_lr_schedule_decays_linearly(spark):
    lines = cycled(TEMPLATES, 8)
    _, _, enc = prep(spark, lines)
    ex = E.centre_examples(E.sample_sentences(enc, 42, 0), 5, 42, 0)
    n = ex.count()
    s = E.lr_schedule(ex, 42, 0, 0, n, 0.025, 0.0001).orderBy("step").collect()
    assert [r["step"] for r in s] == list(range(n))
    assert abs(s[0]["lr"] - 0.025) < 1e-12
    assert all(a["lr"] >= b["lr"] for a, b in zip(s, s[1:]))
