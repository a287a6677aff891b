"""Encoding, draws and steps that stay in their task: same rows as the shuffled forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import wordloom.session as session
from fixtures import DEMO, corpus_df, cycled
from wordloom.functions.rng import keyed_uniform
from wordloom.operators import examples as E
from wordloom.operators import noise as N
from wordloom.operators import rank as R
from wordloom.operators import steps as ST
from wordloom.operators import tokenize as T
from wordloom.operators import vocab as V


def parts(spark, extra=()):
    lines = corpus_df(spark, cycled(DEMO, 40))
    if extra:
        lines = lines.unionByName(spark.createDataFrame(list(extra), lines.schema))
    vocab = session.write_table(V.build_vocab(T.tokenize(lines), 1), "vocab")
    return lines, vocab, V.collect_stats(vocab)


def rows(df):
    return sorted(map(str, df.collect()))


def exchanges(df):
    return str(df._jdf.queryExecution().executedPlan().toString()).count("Exchange hashpartitioning")


@pytest.mark.parametrize("extra", [(), [(0, 0, "paris is a city"), (None, 0, "the king rules"), (None, 0, "a cat")]])
def test_encode_corpus_gives_the_rows_of_encode_lines(spark, extra, monkeypatch):
    lines, vocab, st = parts(spark, extra)
    want = rows(E.encode_lines(T.tokenize(lines), vocab, st.vocab_size, st.total_tokens, 1e-2))
    got = E.encode_corpus(lines, vocab, st.vocab_size, st.total_tokens, 1e-2)
    assert rows(got) == want
    if not extra:
        assert exchanges(got) == 0
    for m in (E, R):
        monkeypatch.setattr(m, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(session, "DEFAULT_BROADCAST_ROWS", 10)
    assert rows(E.encode_corpus(lines, vocab, st.vocab_size, st.total_tokens, 1e-2)) == want


def test_a_line_over_many_arrow_batches_stays_one_row(spark):
    lines = spark.createDataFrame([(1, 0, " ".join(["x", "y"] * 12000)), (2, 0, "x"), (3, 0, "none")],
                                  "doc_id bigint, line_no int, line string").coalesce(1)
    vocab = V.build_vocab(T.tokenize(lines), 2)
    got = {r.doc_id: [t.pos for t in r.toks] for r in E.encode_corpus(lines, vocab, 2, 24001, None).collect()}
    assert got == {1: list(range(24000)), 2: [0]}


def test_noise_runs_are_the_ranges_bit_for_bit(spark, monkeypatch):
    _, vocab, st = parts(spark)
    monkeypatch.setattr(N, "DEFAULT_BLOCK", 7)
    monkeypatch.setattr(N, "prefix_sum", lambda *a: R.prefix_sum(*a, block=7))
    want = [r.hi for r in N.noise_distribution(vocab).orderBy("idx").collect()]
    assert N.draw_table(vocab, 1024, st.vocab_size).upper().tolist() == want
    odd = vocab.withColumn("idx", F.lit(st.vocab_size - 1) - F.col("idx")).where("idx <> 3")
    assert not isinstance(N.draw_table(odd, 1024, st.vocab_size), N.NoiseRuns)


@pytest.mark.parametrize("shifted", [False, True])
def test_draws_in_place_equal_the_bucket_join(spark, shifted):
    lines, vocab, st = parts(spark, [(None, 0, "the king rules over the kingdom")])
    enc = E.encode_corpus(lines, vocab, st.vocab_size, st.total_tokens, 1e-2)
    s = session.write_table(E.sample_sentences(enc, 42, 1), "sents")
    nb = N.bucket_count(st.vocab_size)
    runs, buckets = N.draw_table(vocab, nb, st.vocab_size), N.noise_buckets(N.noise_distribution(vocab), nb)
    got = E.training_examples(s, 3, 4, 42, 1, runs, nb, st.vocab_size, shifted)
    assert exchanges(got) == 0
    assert rows(got) == rows(E.training_examples(s, 3, 4, 42, 1, buckets, nb, st.vocab_size, shifted))
    ex = E.centre_examples(s, 3, 42, 1)
    assert rows(E.negative_samples(ex, 4, 42, 1, runs, nb, st.vocab_size, shifted)) \
        == rows(E.negative_samples(ex, 4, 42, 1, buckets, nb, st.vocab_size, shifted))


def test_dice_and_windows_are_the_keyed_uniforms(spark):
    lines, vocab, st = parts(spark, [(None, 5, "the king rules over the kingdom")])
    enc = session.write_table(E.encode_corpus(lines, vocab, st.vocab_size, st.total_tokens, 1e-2), "encoded")
    kept = F.filter("toks", lambda x: keyed_uniform("sub", 42, 2, F.col("doc_id"), F.col("line_no"), x["pos"]) < x["keep"])
    want = enc.select("doc_id", "line_no", F.transform(kept, lambda x: x["idx"]).alias("t")).where("size(t) >= 2")
    s = E.sample_sentences(enc, 42, 2)
    assert rows(s) == rows(want)
    ex = E.centre_examples(s, 3, 42, 2)
    width = ex.select(*ex.columns, E.window_width(42, 2, 3, F.col("p")).alias("w")).collect()
    t = {(r.doc_id, r.line_no): r.t for r in want.collect()}
    assert sum(map(len, t.values())) == len(width)
    for r in width:
        full = t[r.doc_id, r.line_no]
        assert r.win == r.w and r.center == full[r.p]
        assert r.context == full[max(r.p - r.w, 0):r.p] + full[r.p + 1:r.p + 1 + r.w]


@pytest.mark.parametrize("model", ["skipgram", "cbow"])
def test_steps_in_tasks_equal_the_joined_forms(spark, model, monkeypatch):
    lines, vocab, st = parts(spark, [(None, 0, "the king rules over the kingdom")])
    enc = E.encode_corpus(lines, vocab, st.vocab_size, st.total_tokens, 1e-2)
    nb = N.bucket_count(st.vocab_size)
    ex = session.write_table(E.training_examples(E.sample_sentences(enc, 42, 0), 3, 3, 42, 0,
                                                 N.draw_table(vocab, nb, st.vocab_size), nb, st.vocab_size), "ex")
    w = session.write_table(ST.init_weights(vocab, 4, 42, out_init="hash"), "w")
    loss = ST.sgns_example_loss if model == "skipgram" else ST.cbow_example_loss
    grads = ST.sgns_gradients if model == "skipgram" else ST.cbow_batch_gradients

    def all_of():
        a = {(str(r.doc_id), r.line_no, r.p): (r.loss, r.n_targets) for r in loss(ex, w, st.vocab_size, 4).collect()}
        b = {(r.matrix, r.idx): [*r.grad, r.n] for r in grads(ex, w, st.vocab_size, 4).collect()}
        c = {(str(r.doc_id), r.line_no, r.p): [*r.h, r.n_ctx] for r in ST.cbow_context_mean(ex, w, st.vocab_size, 4).collect()}
        t = ST.epoch_loss(ST.totals(ex, w, st.vocab_size, 4)).first()
        return a, b, c, {"total": list(t)}
    small = all_of()
    assert ST.step_sums(ex, w, st.vocab_size, 4, model).where("matrix = 'stat'").first()["n"] == ex.count()
    monkeypatch.setattr(ST, "fits_broadcast", lambda *a, **k: False)
    for s, l in zip(small, all_of()):
        assert s.keys() == l.keys() and len(s)
        assert all(np.allclose(s[k], l[k], atol=1e-9) for k in s)


def test_lr_schedule_from_sentences(spark):
    lines, vocab, st = parts(spark, [(None, 0, "the king rules over the kingdom")])
    enc = E.encode_corpus(lines, vocab, st.vocab_size, st.total_tokens, 1e-2)
    s = session.write_table(E.sample_sentences(enc, 42, 0), "sents")
    ex = E.centre_examples(s, 3, 42, 0)
    want = E.lr_schedule(ex, 42, 0, 7, 5000, 0.025, 0.0001)
    got = E.lr_schedule(ex, 42, 0, 7, 5000, 0.025, 0.0001, sents=s)
    assert rows(got) == rows(want)
