"""Plans above the broadcast gates, reproducible training, merge, published run."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import wordloom.session as session
from fixtures import DEMO, TEMPLATES, corpus_df, cycled
from wordloom.config import EmbeddingConfig
from wordloom.operators import examples as E
from wordloom.operators import noise as N
from wordloom.operators import rank as R
from wordloom.operators import steps as ST
from wordloom.operators import tokenize as T
from wordloom.operators import vocab as V
from wordloom.plans import trainer as TR


@pytest.fixture
def no_broadcast(monkeypatch):
    """Every size gate says no, and the vocabulary's frequent head is short."""
    for m in (E, N, R, ST, TR):
        monkeypatch.setattr(m, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(session, "DEFAULT_BROADCAST_ROWS", 10)


def step_tables(spark, model):
    tokens = T.tokenize(corpus_df(spark, cycled(TEMPLATES, 40)))
    vocab = V.build_vocab(tokens, 1)
    st = V.collect_stats(vocab)
    enc = E.encode_lines(tokens, vocab, st.vocab_size, st.total_tokens, 1e-2)
    nb = N.bucket_count(st.vocab_size)
    buckets = N.noise_buckets(N.noise_distribution(vocab), nb)
    ex = E.training_examples(E.sample_sentences(enc, 42, 0), 3, 3, 42, 0, buckets, nb, st.vocab_size)
    w = ST.init_weights(vocab, 4, 42, out_init="hash")
    step = ST.sgns_step if model == "skipgram" else ST.cbow_step
    after = step(ex, w, st.vocab_size, 4, 0.025).orderBy("idx").collect()
    rows = sorted((r.doc_id, r.line_no, r.p, r.center, *r.context, -1, *r.negatives) for r in ex.collect())
    return rows, np.array([[*r.w_in, *r.w_out] for r in after])


@pytest.mark.parametrize("model", ["skipgram", "cbow"])
def test_large_plans_give_the_same_step(spark, model, request):
    small = step_tables(spark, model)
    request.getfixturevalue("no_broadcast")
    large = step_tables(spark, model)
    assert small[0] == large[0] and len(small[0]) > 50
    assert np.allclose(small[1], large[1], atol=1e-6)


def test_no_exchange_carries_a_context(spark, no_broadcast):
    tokens = T.tokenize(corpus_df(spark, cycled(TEMPLATES, 40)))
    vocab = V.build_vocab(tokens, 1)
    st = V.collect_stats(vocab)
    enc = session.write_table(E.encode_lines(tokens, vocab, st.vocab_size, st.total_tokens, 1e-2), "encoded")
    nb = N.bucket_count(st.vocab_size)
    buckets = session.write_table(N.noise_buckets(N.noise_distribution(vocab), nb), "noise")
    sents = E.sample_sentences(enc, 42, 0)
    ex = E.training_examples(sents, 3, 3, 42, 0, buckets, nb, st.vocab_size)
    # The windows are cut above every exchange.
    plan = [x for x in ex._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x or "context" in x]
    cut = [i for i, x in enumerate(plan) if "context" in x]
    assert cut and max(cut) < min(i for i, x in enumerate(plan) if "Exchange" in x)
    old = E.with_negatives(E.centre_examples(sents, 3, 42, 0), 3, 42, 0, buckets, nb, st.vocab_size)

    def rows(df):
        return sorted((r.doc_id, r.line_no, r.p, r.center, *r.context, -1, *r.negatives) for r in df.collect())
    assert rows(ex) == rows(old)


def weights_of(spark, lines, cfg, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        m = TR.train(spark, lines.repartition(parts), cfg)
        return np.array([[*r.w_in, *r.w_out] for r in m.weights.orderBy("idx").collect()]), m.history.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("algorithm", ["local", "batch"])
def test_same_model_on_any_partitioning(spark, algorithm):
    lines = corpus_df(spark, cycled(TEMPLATES, 24))
    cfg = EmbeddingConfig(embedding_dim=6, epochs=1, rounds_per_epoch=2, shards=3, algorithm=algorithm,
                          noise="shifted", lr_schedule="linear", kernel_batch=4)
    a, ha = weights_of(spark, lines, cfg, 1)
    b, hb = weights_of(spark, lines, cfg, 4)
    assert np.allclose(a, b, atol=1e-6) and abs(a).sum() > 0
    assert ha[0].lr_last == hb[0].lr_last and abs(ha[0].avg_loss - hb[0].avg_loss) < 1e-6


def test_large_plans_give_the_same_model(spark, request):
    lines = corpus_df(spark, cycled(TEMPLATES, 16))
    cfg = EmbeddingConfig(embedding_dim=4, epochs=1, rounds_per_epoch=1, shards=2)
    a, _ = weights_of(spark, lines, cfg, 4)
    request.getfixturevalue("no_broadcast")
    b, _ = weights_of(spark, lines, cfg, 4)
    assert np.allclose(a, b, atol=1e-6)


def test_merge_of_two_shards_by_hand(spark, monkeypatch):
    """Row 0 moves in both shards, row 1's input in one; the cap is per matrix."""
    out = [("row", 0, [1.0], [2.0], 4, 1), ("row", 0, [3.0], [0.0], 4, 0), ("row", 1, [5.0], [6.0], 1, 30),
           ("row", 1, [0.0], [6.0], 0, 30)]
    rows = [(*r, 0.0, 0, 0, 0.0) for r in out]
    rows += [("stat", -1, None, None, 0, 0, 1.5, 2, 8, 0.02), ("stat", -1, None, None, 0, 0, 0.5, 1, 5, 0.03)]
    kernel = spark.createDataFrame(rows, TR.OUT_SCHEMA)
    real = TR.write_table
    monkeypatch.setattr(TR, "write_table", lambda df, name, **k: real(kernel if name == "round-out" else df, name, **k))
    ex = spark.createDataFrame([(0, 0, 0, 0, [1], [1], 0.1, 0)], "doc_id long, line_no int, p int, center long, "
                               "context array<long>, negatives array<long>, ord_u double, shard int")
    w = spark.createDataFrame([(0, [10.0], [10.0]), (1, [10.0], [10.0]), (2, [7.0], [7.0])],
                              "idx long, w_in array<float>, w_out array<float>")
    cfg = EmbeddingConfig(embedding_dim=1, merge_cap=4.0, shards=2)
    new, loss, centres, lr = TR._local_round(ex, w, cfg, 3, 0, 2, 10)
    got = {r.idx: (r.w_in[0], r.w_out[0]) for r in new.collect()}
    # Row 0 in: 8 updates, 2 shards: max(1/2, 4/8). Row 1 out: 60 updates: max(1/2, 4/60).
    assert got == {0: (12.0, 12.0), 1: (15.0, 16.0), 2: (7.0, 7.0)}
    assert (loss, centres, lr) == (2.0, 3, 0.02)


def test_scratch_tables_are_dropped(spark):
    t = session.write_table(spark.range(10).withColumn("k", F.col("id") % 3), "gone", by=["k"])
    path = t.inputFiles()[0].rsplit("/k=", 1)[0]
    assert t.where("k = 1").count() == 3
    session.drop_table(t)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)


def test_published_run(spark):
    """The published toy run: vocabulary, tokens and the loss curve within 0.4."""
    cfg = EmbeddingConfig(embedding_dim=50, epochs=15, noise="shifted", shards=1, rounds_per_epoch=1)
    m = TR.train(spark, corpus_df(spark, cycled(DEMO, 200)), cfg)
    assert (m.vocab_size, m.total_tokens) == (121, 1910)
    loss = {r.epoch: r.avg_loss for r in m.history.collect()}
    for epoch, published in {1: 11.9173, 5: 6.3613, 10: 3.8031, 15: 3.1121}.items():
        assert abs(loss[epoch] - published) < 0.6, (epoch, loss[epoch])
    assert all(700 < r.pairs_processed < 950 for r in m.history.collect())
