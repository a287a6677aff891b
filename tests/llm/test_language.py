import zlib

import numpy as np

from wordloom.llm import lang_id as L

WORDS = {"en": "the and of that with this from which", "fr": "les une des que pour dans avec être",
         "de": "der und nicht für ein über schön ist"}


def corpus(spark, n=240):
    rng, rows = np.random.default_rng(0), []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        rows.append((i, " ".join(rng.choice(WORDS[lang].split(), 12)), lang, "extra"))
    rows += [(n, None, "en", None), (n + 1, "", None, None), (n + 2, "123 !!", "fr", None),
             (0, rows[0][1], "en", None), (None, "der und nicht", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")


def test_predicts_held_out_rows_and_edges(spark):
    docs = corpus(spark)
    model = L.train(docs)
    got = L.predict(docs, model).withColumn("h", L.held_out()).collect()
    held = [r for r in got if r.h and r.lang and r.doc_id < 240]
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(held) > 30 and np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    by = {r.doc_id: r for r in got}
    for i in (240, 241, 242):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[None].lang_pred == "de" and 0 <= by[None].score <= 1
    assert len(got) == docs.count()


def test_prediction_never_reads_the_language(spark):
    docs = corpus(spark)
    model = L.train(docs)
    a = L.predict(docs.select("doc_id", "text"), model).collect()
    assert sorted(map(str, a)) == sorted(map(str, L.predict(
        docs.selectExpr("doc_id", "text"), model).collect()))
    # Held-out rows do not move the model.
    from pyspark.sql import functions as F
    other = docs.withColumn("lang", F.when(L.held_out(), F.lit("fr")).otherwise(F.col("lang")))
    again = L.train(other)
    assert np.array_equal(model.weights, again.weights) and model.temperature == again.temperature


def test_empty_tables_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = L.train(none)
    assert model.langs == [] and L.predict(none, model).count() == 0
    one = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert L.predict(one, L.train(one)).first()["lang_pred"] == "und"


def test_ngrams_of_chunks_equal_the_whole(monkeypatch):
    text = "Ab cd, éf  gh!" * 50
    whole = np.bincount(L.ngram_buckets(text), minlength=L.BUCKETS)
    monkeypatch.setattr(L, "CHUNK", 17)
    assert np.array_equal(whole, np.bincount(L.ngram_buckets(text), minlength=L.BUCKETS))


def test_sparse_weights_and_temperature():
    rng = np.random.default_rng(1)
    y = np.arange(200) % 2
    X = [(np.array([int(c), 7 + int(rng.integers(50))]), np.array([0.7, 0.7])) for c in y]
    w, _ = L.train_ftrl(X, y, 2)
    assert np.count_nonzero(w[0]) and np.count_nonzero(w) < 150
    logits = np.array([[4.0, 0.0]] * 60 + [[0.0, 4.0]] * 40)
    right = np.array(([0] * 45 + [1] * 15) + ([1] * 30 + [0] * 10))
    t = L.fit_temperature(logits, right)
    assert abs(1 / (1 + np.exp(-4 / t)) - 0.75) < 0.01
