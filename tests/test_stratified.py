"""Stratified rounds against plain loops, other partitionings, restarts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import DEMO, TEMPLATES, corpus_df, cycled
from wordloom.config import EmbeddingConfig
from wordloom.operators import examples as E
from wordloom.operators import noise as N
from wordloom.operators import steps as ST
from wordloom.operators import strata as S
from wordloom.operators import tokenize as T
from wordloom.operators import vocab as V
from wordloom.plans import stratified as P
from wordloom.plans.trainer import train
from wordloom.session import scratch_path
from wordloom.sources.corpus import corpus_lines

F32 = np.float32


def plain(w_in, w_out, ups):
    """One update after the other; returns the loss."""
    loss = 0.0
    for c, t, label, lr in ups:
        x, y = w_in[c].copy(), w_out[t].copy()
        p = F32(1) / (F32(1) + np.exp(-np.dot(x, y)))
        move = F32(lr) * (p - F32(label))
        w_out[t] = y - move * x
        w_in[c] = x - move * y
        loss -= max(np.log(p if label else F32(1) - p), -30.0)
    return loss


def prepared(spark, lines, cfg):
    tokens = T.tokenize(lines)
    vocab = V.build_vocab(tokens, cfg.min_count).cache()
    st = V.collect_stats(vocab)
    enc = E.encode_lines(tokens, vocab, st.vocab_size, st.total_tokens, cfg.subsample_threshold).cache()
    nb = N.bucket_count(st.vocab_size)
    buckets = N.noise_buckets(N.noise_distribution(vocab), nb).cache()
    total = int(E.estimate_pairs(enc, cfg.window_size).first()["estimate"]) * cfg.epochs
    w = ST.init_weights(vocab, cfg.embedding_dim, cfg.seed).orderBy("idx").collect()
    return enc, buckets, nb, st, total, np.array([r.w_in for r in w], F32), np.array([r.w_out for r in w], F32)


def expected(spark, lines, cfg):
    """Weights and loss per epoch, by plain loops over the schedule."""
    enc, buckets, nb, st, total, w_in, w_out = prepared(spark, lines, cfg)
    step0, losses = 0, []
    for epoch in range(cfg.epochs):
        ex = P._examples(enc, buckets, nb, st.vocab_size, cfg, epoch)
        n = ex.count()
        ups = P.epoch_updates(ex, n, cfg, epoch, step0, total).orderBy("ord", "step", "j").collect()
        loss = 0.0
        for r in range(cfg.rounds_per_epoch):
            for s in range(cfg.shards):
                loss += plain(w_in, w_out, [(u.center, u.target, u.label, u.lr) for u in ups
                                            if (u.round, u.sub) == (r, s)])
        losses.append(loss / n)
        step0 += n
    return w_in, w_out, losses


def trained(spark, lines, cfg, parts=4, **kw):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        m = P.train_stratified(spark, lines.repartition(parts), cfg, **kw)
        rows = m.weights.orderBy("idx").collect()
        return (np.array([r.w_in for r in rows], F32), np.array([r.w_out for r in rows], F32),
                [(r.epoch, r.avg_loss, r.learning_rate, r.pairs_processed, r.lr_last, r.rounds)
                 for r in m.history.orderBy("epoch").collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_waves_keep_the_order():
    rng = np.random.default_rng(0)
    w = [rng.normal(size=(9, 4)).astype(F32) for _ in range(2)]
    ups = [(int(a), int(b), int(rng.integers(2)), 0.1) for a, b in rng.integers(0, 9, (500, 2))]
    own = S.Stratum()
    for m in (0, 1):
        own.add(np.arange(9), np.full(9, m), w[m].copy())
    cols = [np.array(x) for x in zip(*ups)]
    for a in range(0, 500, 7):                                    # any batches, the same result
        own.update(*[c[a:a + 7] for c in cols])
    loss = plain(w[0], w[1], ups)
    assert np.allclose(own.w[0], w[0], atol=1e-5) and np.allclose(own.w[1], w[1], atol=1e-5)
    assert own.n == 500 and abs(own.loss - loss) < 1e-3
    ones = S.waves(np.array([1, 2, 1, 3]), np.array([5, 6, 7, 7]))
    assert ones.tolist() == [0, 0, 1, 2]


def test_equals_plain_loops_on_any_partitioning(spark):
    lines = corpus_df(spark, cycled(TEMPLATES, 24))
    cfg = EmbeddingConfig(embedding_dim=6, epochs=2, rounds_per_epoch=2, shards=3, algorithm="stratified")
    w_in, w_out, losses = expected(spark, lines, cfg)
    a, b = trained(spark, lines, cfg, 1), trained(spark, lines, cfg, 4)
    for got in (a, b):
        assert np.allclose(got[0], w_in, atol=1e-5) and np.allclose(got[1], w_out, atol=1e-5) and abs(w_out).sum() > 0
        assert np.allclose([h[1] for h in got[2]], losses, atol=1e-4)
    assert np.array_equal(a[0], b[0]) and a[2] == b[2]


def test_equals_plain_loops_on_the_documents(spark):
    """A whole given table, recomputed."""
    lines = corpus_lines(spark, "/root/testdata/sf0.001").where("doc_id < 60")
    cfg = EmbeddingConfig(embedding_dim=4, epochs=1, rounds_per_epoch=1, shards=2, min_count=20, window_size=2,
                          negative_samples=2, algorithm="stratified")
    w_in, w_out, losses = expected(spark, lines, cfg)
    got = trained(spark, lines, cfg)
    assert np.allclose(got[0], w_in, atol=1e-4) and np.allclose(got[1], w_out, atol=1e-4)
    assert abs(got[2][0][1] - losses[0]) < 1e-3


def test_a_run_is_taken_up_after_its_last_round(spark):
    lines = corpus_df(spark, cycled(TEMPLATES, 16))
    cfg = EmbeddingConfig(embedding_dim=4, epochs=2, rounds_per_epoch=2, shards=2, algorithm="stratified")
    whole = trained(spark, lines, cfg)
    path = scratch_path(spark, "test-run")

    class Ended(Exception):
        pass

    def end(epoch, r):
        if (epoch, r) == (1, 1):
            raise Ended
    with pytest.raises(Ended):
        trained(spark, lines, cfg, run_dir=path, after_round=end)
    rounds = []
    again = trained(spark, lines, cfg, run_dir=path, after_round=lambda *x: rounds.append(x))
    assert rounds == [(1, 0)]                                     # only the last round was left
    assert np.array_equal(whole[0], again[0]) and np.array_equal(whole[1], again[1]) and whole[2] == again[2]
    with pytest.raises(ValueError, match="another configuration"):
        P.train_stratified(spark, lines, cfg.with_(seed=1), run_dir=path)


def test_rates_are_the_schedule(spark):
    """Every update carries the rate of its example's true step."""
    cfg = EmbeddingConfig(embedding_dim=4, epochs=2, shards=3, algorithm="stratified")
    enc, buckets, nb, st, total, _, _ = prepared(spark, corpus_df(spark, cycled(TEMPLATES, 16)), cfg)
    ex = P._examples(enc, buckets, nb, st.vocab_size, cfg, 1).cache()
    n = ex.count()
    want = {r.step: (F32(r.lr), r.center) for r in E.lr_schedule(ex, cfg.seed, 1, 50, total, cfg.learning_rate,
            cfg.min_learning_rate).join(ex, [*E.SENT_KEY, "p"]).collect()}
    got = P.epoch_updates(ex, n, cfg, 1, 50, total).collect()
    assert sorted(want) == list(range(50, 50 + n)) == sorted({u.step for u in got})
    assert all((F32(u.lr), u.center) == want[u.step] for u in got)
    assert all(u.owner == u.center % 3 and u.sub == (u.target - u.center) % 3 for u in got)


def test_published_run_at_4_and_16_shards(spark):
    """The loss stays within 3 % of one sequence of updates, and near the published curve."""
    cfg = EmbeddingConfig(embedding_dim=50, epochs=15, noise="shifted", algorithm="stratified", rounds_per_epoch=1, shards=1)
    enc, buckets, nb, st, total, w_in, w_out = prepared(spark, corpus_df(spark, cycled(DEMO, 200)), cfg)
    assert (st.vocab_size, st.total_tokens) == (121, 1910)
    epochs, step0 = [], 0
    for e in range(cfg.epochs):
        ex = P._examples(enc, buckets, nb, st.vocab_size, cfg, e)
        pdf = P.epoch_updates(ex, 1, cfg, e, step0, total).toPandas()
        n = pdf["step"].nunique()
        epochs.append((n, [[d[c].to_numpy() for c in ("center", "target", "label", "lr")] for d in (
            pdf.sort_values(["step", "j"]), pdf.sort_values(["ord", "step", "j"]))]))
        step0 += n
    curves = {}
    for shards in (1, 4, 16):
        own = S.Stratum()
        for m, w in enumerate((w_in, w_out)):
            own.add(np.arange(len(w)), np.full(len(w), m), w.copy())
        curve = []
        for n, orders in epochs:
            own.loss, cols = 0.0, orders[shards > 1]              # one shard: the corpus's own sequence
            sub = (cols[1] - cols[0]) % shards
            for s in range(shards):
                for block in range(shards):
                    at = (sub == s) & (cols[0] % shards == block)
                    own.update(*[c[at] for c in cols])
            curve.append(own.loss / n)
        curves[shards] = np.array(curve)
    print({k: [round(float(x), 3) for x in v[[0, 4, 9, 14]]] for k, v in curves.items()})
    for shards in (4, 16):
        assert np.all(np.abs(curves[shards] / curves[1] - 1)[-5:] < 0.03), curves
    assert abs(curves[1][-1] - 3.1121) < 0.4


def test_cbow_is_refused_and_train_dispatches(spark):
    lines = corpus_df(spark, cycled(TEMPLATES, 8))
    cfg = EmbeddingConfig(embedding_dim=4, epochs=1, rounds_per_epoch=1, shards=2, algorithm="stratified")
    with pytest.raises(ValueError, match="CBOW"):
        train(spark, lines, cfg.with_(model="cbow"))
    assert train(spark, lines, cfg).weights.count() == V.build_vocab(T.tokenize(lines), 1).count()
