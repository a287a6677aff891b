"""A vocabulary beyond the broadcast gates: words and weights that tasks hold, in fewer
bytes and in pieces, give the rows of the plans that move them; nothing is left behind."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import TEMPLATES, corpus_df, cycled
from wordloom import session
from wordloom.operators import examples as E
from wordloom.operators import step_kernel as SK
from wordloom.operators import steps as ST
from wordloom.operators import tokenize as T
from wordloom.operators import vocab as V


def parts(spark, extra=()):
    lines = corpus_df(spark, cycled(TEMPLATES, 24))
    if extra:
        lines = lines.unionByName(spark.createDataFrame(list(extra), lines.schema))
    vocab = V.build_vocab(T.tokenize(lines), 3)
    return lines, vocab, V.collect_stats(vocab)


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("extra", [(), [(0, 0, "paris is a city"), (None, 0, "the king rules"), (None, 0, "a cat zzz")]])
def test_words_that_a_task_holds(spark, monkeypatch, extra):
    lines, vocab, st = parts(spark, extra)
    want = rows(E.encode_lines(T.tokenize(lines), vocab, st.vocab_size, st.total_tokens, 1e-2))
    monkeypatch.setattr(E, "_words_fit", lambda *a: False)
    monkeypatch.setattr(E, "PIECE", 7)
    got = E.encode_corpus(lines, vocab, st.vocab_size, st.total_tokens, 1e-2)
    plan = str(got._jdf.queryExecution().executedPlan().toString())
    assert rows(got) == want and len(want) > 10
    assert extra or "Exchange hashpartitioning" not in plan.split("MapInArrow", 1)[0]
    # Other words of the same hash are not words of the vocabulary; two of one hash are not looked up.
    monkeypatch.setattr(E.F, "xxhash64", lambda *c: F.length(c[0]).cast("bigint"))
    assert E._held_words(vocab.select("word", "idx", F.lit(1.0).alias("keep")), st.vocab_size) is None
    one = vocab.where("idx = 0").select("word", F.lit(0).cast("bigint").alias("idx"), F.lit(1.0).alias("keep"))
    held = E._held_words(one, 1)

    class Held:
        value = held
    word = held[1][0].as_py()
    toks = spark.createDataFrame([(0, 0, 0, 0, word, len(word)), (0, 0, 0, 1, "?" * len(word), len(word))],
                                 "rid bigint, doc_id bigint, line_no int, pos int, word string, h bigint").toArrow()
    assert [b.column("pos").to_pylist() for b in E._known(Held)(toks.combine_chunks().to_batches())] == [[0]]


def test_weights_in_pieces(spark, monkeypatch):
    _, vocab, st = parts(spark)
    w = ST.init_weights(vocab, 4, 42, out_init="hash").cache()
    want = SK.held_weights(w, 4)
    monkeypatch.setattr(SK, "PIECE", 5)
    assert st.vocab_size > 5 and np.array_equal(SK.held_weights(w, 4), want)
    assert SK.held_weights(w.where("idx <> 3"), 4) is None
    assert SK.held_weights(w.where("idx <> 3").unionByName(w.where("idx = 4")), 4) is None
    assert SK.held_weights(w.where("idx < 0"), 4).shape == (2, 0, 4)


def test_a_task_holds_the_weights_of_five_million_words():
    assert ST.in_tasks(5_000_000, 8) and not ST.in_tasks(7_000_000, 8)
    assert ST.in_tasks(4_500_000, 16, "local") and not ST.in_tasks(4_500_000, 16)
    assert not ST.in_tasks(5_000_000, 100)


def test_a_written_table_leaves_no_shuffle_files(spark):
    def held():
        root = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
        return sum(f.startswith("shuffle_") for d in root for _, _, fs in os.walk(d) for f in fs)
    before = held()
    t = session.write_table(spark.range(5000).repartition(4, "id"), "shuffled")
    until = time.time() + 20                                        # files are deleted in the background
    while held() > before and time.time() < until:
        time.sleep(0.2)
    assert held() <= before and t.count() == 5000
    assert spark.conf.get(session._CLEANUP) == "false"
