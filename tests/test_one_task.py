"""Draws hashed side by side, and examples made from the encoded line in one task."""

import numpy as np

import wordloom.session as session
from fixtures import DEMO, corpus_df, cycled
from wordloom.functions.draws import uniforms, uniforms_at
from wordloom.operators import example_kernel as K
from wordloom.operators import examples as E
from wordloom.operators import noise as N
from wordloom.operators import step_kernel as SK
from wordloom.operators import steps as ST
from wordloom.operators import tokenize as T
from wordloom.operators import vocab as V
from wordloom.sources import corpus as C


def parts(spark):
    lines = corpus_df(spark, cycled(DEMO, 40))
    lines = lines.unionByName(spark.createDataFrame([(None, 0, "the king rules over the kingdom")], lines.schema))
    vocab = session.write_table(V.build_vocab(T.tokenize(lines), 1), "vocab")
    st = V.collect_stats(vocab)
    enc = session.write_table(E.encode_corpus(lines, vocab, st.vocab_size, st.total_tokens, 1e-2), "encoded")
    nb = N.bucket_count(st.vocab_size)
    return vocab, st, enc, N.draw_table(vocab, nb, st.vocab_size), nb


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_uniforms_side_by_side_are_those_of_hashlib():
    rng = np.random.default_rng(1)
    heads = [b"neg|42|0|%d|%d|" % (d, n) for d, n in zip(rng.integers(-9, 10 ** 9, 70), rng.integers(0, 99, 70))]
    heads[3] = b"neg|42|0|"
    row = rng.integers(0, 70, 9000)
    p = rng.integers(0, 10, 9000) ** rng.integers(0, 5, 9000)
    tails = [b"|0", b"|9", b"|10", b""]
    for h in (heads, [*heads[:-1], b"x" * 54]):
        got = uniforms_at(h, row, p, tails)
        for k, t in enumerate(tails):
            assert np.array_equal(got[:, k], uniforms(h[r] + b"%d" % x + t for r, x in zip(row, p)))
    assert uniforms_at(heads, row[:0], p[:0], tails).shape == (0, 4)


def test_bucketed_lookup_is_the_binary_search():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 1000):
        upper = np.cumsum(rng.random(n) ** 9 + 1e-9)
        upper /= upper[-1]
        u = np.append(rng.random(5000), [0.0, *upper[:-1]])
        assert np.array_equal(K._lookup(upper)(u), np.searchsorted(upper, u, side="right"))


def test_examples_are_made_in_one_task(spark):
    _, st, enc, runs, nb = parts(spark)
    want = E.training_examples(E.sample_sentences(enc, 42, 0), 3, 4, 42, 0, runs, nb, st.vocab_size)
    got = E.made_examples(enc, 3, 4, 42, 0, runs, nb, st.vocab_size)
    assert isinstance(got, E.Made) and plan(got.table()).count("MapInArrow") == 1
    assert rows(got.table()) == rows(want)
    few = ["doc_id", "line_no", "p", "win"]
    got = E.made_windows(enc, 3, 42, 0, few)
    assert plan(got).count("MapInArrow") == 1
    assert rows(got) == rows(E.centre_examples(E.sample_sentences(enc, 42, 0), 3, 42, 0).select(few))


def test_a_step_sums_its_examples_once(spark):
    vocab, st, enc, runs, nb = parts(spark)
    w = session.write_table(ST.init_weights(vocab, 4, 42, out_init="hash"), "w")
    made = E.made_examples(enc, 3, 4, 42, 0, runs, nb, st.vocab_size)
    table = session.write_table(made.table(), "ex")
    for step, loss in ((ST.sgns_step, ST.sgns_example_loss), (ST.cbow_step, ST.cbow_example_loss)):
        got = step(made, w, st.vocab_size, 4, 0.1)
        assert "MapInArrow" not in plan(got)
        a, b = ({r.idx: [*r.w_in, *r.w_out] for r in x.collect()} for x in (got, step(table, w, st.vocab_size, 4, 0.1)))
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], atol=1e-6) for i in a)
        assert rows(loss(made, w, st.vocab_size, 4)) == rows(loss(table, w, st.vocab_size, 4))


def test_slices_of_a_batch_give_its_sums(spark, monkeypatch):
    vocab, st, enc, runs, nb = parts(spark)
    held = SK.held_weights(ST.init_weights(vocab, 4, 42, out_init="hash"), 4)
    batches = E.made_examples(enc, 3, 4, 42, 0, runs, nb, st.vocab_size).table().toArrow().to_batches()

    class Held:
        value = held
    for model in ("skipgram", "cbow"):
        whole = [b.to_pydict() for b in SK.sums(Held, model, 4)(iter(batches))]
        monkeypatch.setattr(SK, "SLICE", 3)
        for a, b in zip(whole, [b.to_pydict() for b in SK.sums(Held, model, 4)(iter(batches))]):
            assert a.keys() == b.keys() and all(np.allclose(a[c], b[c], atol=1e-9) for c in a)
        monkeypatch.undo()


def test_lr_schedule_from_lengths(spark):
    _, _, enc, _, _ = parts(spark)
    s = E.sample_sentences(enc, 42, 0)
    n = session.write_table(E.sentence_lengths(enc, 42, 0), "lengths")
    assert E.estimate_pairs(n, 3).first() == E.estimate_pairs(enc, 3).first()
    want = E.lr_schedule(E.centre_examples(s, 3, 42, 0), 42, 0, 7, 5000, 0.025, 0.0001)
    assert rows(E.lr_schedule(None, 42, 0, 7, 5000, 0.025, 0.0001, sents=n)) == rows(want)


def test_a_text_is_split_once(spark):
    texts = ["a b\nc", "a\r\n", "\n", "", None, "a\n\n", "x y  z \n", "  "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = C.lines_from_text(df)
    assert plan(got).count("split(") == 1
    want = [(i, n, x) for i, t in enumerate(texts) if t
            for n, x in enumerate((t[:-1] if t.endswith("\n") else t).replace("\r", "").split("\n"))]
    assert sorted(map(tuple, got.collect())) == want
    words = [r.word for r in T.tokenize(got.where("doc_id = 6")).orderBy("pos").collect()]
    assert words == ["x", "y", "z"]
