"""Updates are made from sentences that carry their first step, and are put in order and
cut into waves before a stratum's owner gets them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import TEMPLATES, corpus_df, cycled
from wordloom.config import EmbeddingConfig
from wordloom.operators import examples as E
from wordloom.operators import noise as N
from wordloom.operators import strata as S
from wordloom.operators import vocab as V
from wordloom.operators import tokenize as T
from wordloom.plans import stratified as P


@pytest.mark.parametrize("noise", ["documented", "shifted"])
def test_blocks_from_sentences_are_those_of_the_examples(spark, noise):
    lines = corpus_df(spark, cycled(TEMPLATES, 24))
    odd = lines.withColumn("line_no", F.when(F.col("doc_id") % 7 != 3, F.col("line_no")))       # no place in the order
    cfg = EmbeddingConfig(embedding_dim=4, epochs=2, rounds_per_epoch=2, shards=3, algorithm="stratified", noise=noise)
    vocab = V.build_vocab(T.tokenize(lines)).cache()
    st = V.collect_stats(vocab)
    enc = E.encode_corpus(odd, vocab, st.vocab_size, st.total_tokens, cfg.subsample_threshold).cache()
    nb = N.bucket_count(st.vocab_size)
    runs = N.draw_table(vocab, nb, st.vocab_size)
    ex = P._examples(enc, N.noise_buckets(N.noise_distribution(vocab), nb), nb, st.vocab_size, cfg, 1)
    n, total = ex.count(), 5000
    lengths = E.sentence_lengths(enc, cfg.seed, 1).cache()
    assert lengths.where("n_kept >= 2").agg(F.sum("n_kept")).first()[0] == n

    def held(blocks):
        return sorted((r["round"], r["sub"], r["owner"], u.tobytes()) for r in blocks.collect()
                      for u in np.frombuffer(bytes(r["block"]), dtype=S.UPDATE))
    got = held(P.sentence_blocks(enc, lengths, runs, st.vocab_size, n, cfg, 1, 50, total))
    assert got and got == held(P.epoch_blocks(ex, n, cfg, 1, 50, total))


def test_chunks_come_by_waves(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 100)
    rng = np.random.default_rng(3)
    c, t = rng.zipf(1.5, 250) % 30 * 4 + 1, rng.integers(0, 30, 250) * 4 + 2
    label, lr = rng.integers(0, 2, 250), rng.random(250).astype(np.float32)
    parts = list(S.in_waves(c, t, label, lr, 4))
    assert [len(up) for up, _ in parts] == [100, 100, 50]
    for k, (up, ends) in enumerate(parts):
        z = slice(100 * k, 100 * k + 100)
        assert sorted(zip(c[z].tolist(), t[z].tolist(), label[z].tolist(), lr[z].tolist())) == sorted(
            zip(up["center"].tolist(), up["target"].tolist(), up["label"].tolist(), up["lr"].tolist()))
        for a, e in zip([0, *ends[:-1]], ends):                    # a wave's updates share no row
            assert len(set(up["center"][a:e])) == len(set(up["target"][a:e])) == e - a
        for x in (1, 5, 9):                                         # a row's updates keep their order
            assert lr[z][c[z] == x].tolist() == up["lr"][up["center"] == x].tolist()


def test_order_by_the_leading_digits():
    rng = np.random.default_rng(5)
    for key in (rng.integers(-2**63, 2**63 - 1, 5000), rng.integers(0, 9, 500), np.full(4, -7), np.arange(70000) // 2 + 2**40):
        assert (S._sorted_by(key) == np.argsort(key, kind="stable")).all()
    ids = np.array([1, 5, 9, 13])
    assert S._places(ids)(np.array([13, 1])).tolist() == S._places(np.array([1, 5, 6, 13]))(np.array([13, 1])).tolist() == [3, 0]
