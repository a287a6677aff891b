"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver's tables (or tables Spark derives from them) in
full.  Float outputs are rounded to 6 decimals and vectors are emitted in long
form (one row per dimension) so the DuckDB oracles can be compared by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import noise as N
from ..operators import tokenize as T
from ..operators import vocab as V
from ..session import write_table
from ..sources import corpus as C

# Parameters of the checked queries (fixed; the SQL oracles use the same).
CHECK_MIN_COUNT = 5
CHECK_SUBSAMPLE = 1e-3
CHECK_WINDOW = 5
CHECK_NEGATIVES = 5
CHECK_SEED = 42
CHECK_EPOCH = 0
CHECK_DIM = 8
CHECK_LR = 0.025
CHECK_TOP_K = 10


def r6(c) -> F.Column:
    """Round half up to 6 decimals on the binary value (same in DuckDB)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c.cast("double") * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)


# ---------------------------------------------------------------- slice 1-2

def q_corpus_lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.corpus_lines(spark, sf)


def q_tokenize(spark, sf):
    return T.tokenize(C.corpus_lines(spark, sf))


def q_nonblank_lines(spark, sf):
    return T.nonblank_lines(C.corpus_lines(spark, sf))


def q_word_count(spark, sf):
    return V.word_counts(T.tokenize(C.corpus_lines(spark, sf)))


def _vocab(spark, sf, min_count):
    return V.build_vocab(T.tokenize(C.corpus_lines(spark, sf)), min_count)


def q_vocab(spark, sf):
    return _vocab(spark, sf, 1)


def q_vocab_min_count(spark, sf):
    return _vocab(spark, sf, CHECK_MIN_COUNT)


def q_vocab_stats(spark, sf):
    return V.vocab_stats_df(_vocab(spark, sf, CHECK_MIN_COUNT))


def q_word_count_lookup(spark, sf):
    """Counts in the documents vocabulary of every distinct word used in
    `conversations` (absent words count 0)."""
    vocab = _vocab(spark, sf, 1)
    asked = T.tokenize(C.conversation_lines(spark, sf)).select("word").distinct()
    return V.word_count_lookup(asked, vocab)


def q_words(spark, sf):
    return V.words_sorted(_vocab(spark, sf, CHECK_MIN_COUNT))


def q_top_frequent_words(spark, sf):
    return V.top_frequent(_vocab(spark, sf, 1), 50)


def q_keep_probability(spark, sf):
    vocab = _vocab(spark, sf, CHECK_MIN_COUNT)
    stats = V.collect_stats(vocab)
    kp = V.with_keep_probability(vocab, stats.total_tokens, CHECK_SUBSAMPLE)
    return kp.select("idx", "word", r6("keep").alias("keep"))


def _dist(spark, sf):
    return N.noise_distribution(_vocab(spark, sf, CHECK_MIN_COUNT))


def q_noise_distribution(spark, sf):
    d = _dist(spark, sf)
    return d.select("idx", r6("p").alias("p"), r6("lo").alias("lo"), r6("hi").alias("hi"))


def _noise_table(spark, sf, shifted):
    vocab = _vocab(spark, sf, CHECK_MIN_COUNT)
    stats = V.collect_stats(vocab)
    d = N.noise_distribution(vocab)
    nb = N.bucket_count(stats.vocab_size)
    return N.noise_table(d, nb, stats.vocab_size, shifted=shifted)


def q_noise_table(spark, sf):
    """Slots per word of the 1,000,000-slot table (documented form)."""
    t = _noise_table(spark, sf, False)
    return t.groupBy("idx").agg(F.count(F.lit(1)).alias("slots"), F.min("slot").alias("first_slot"))


def q_noise_table_shifted(spark, sf):
    """Same for the reference's shifted table loop."""
    t = _noise_table(spark, sf, True)
    return t.groupBy("idx").agg(F.count(F.lit(1)).alias("slots"), F.min("slot").alias("first_slot"))


QUERIES = {
    "corpus_lines": q_corpus_lines,
    "tokenize": q_tokenize,
    "nonblank_lines": q_nonblank_lines,
    "word_count": q_word_count,
    "vocab": q_vocab,
    "vocab_min_count": q_vocab_min_count,
    "vocab_stats": q_vocab_stats,
    "word_count_lookup": q_word_count_lookup,
    "words": q_words,
    "top_frequent_words": q_top_frequent_words,
    "keep_probability": q_keep_probability,
    "noise_distribution": q_noise_distribution,
    "noise_table": q_noise_table,
    "noise_table_shifted": q_noise_table_shifted,
}


# ---------------------------------------------------------------- slice 3

from ..operators import examples as E  # noqa: E402


def _prep(spark, sf, threshold=CHECK_SUBSAMPLE):
    lines = C.corpus_lines(spark, sf)
    tokens = T.tokenize(lines)
    vocab = V.build_vocab(tokens, CHECK_MIN_COUNT)
    stats = V.collect_stats(vocab)
    encoded = E.encode_corpus(lines, vocab, stats.vocab_size, stats.total_tokens, threshold)
    return tokens, vocab, stats, encoded


def _arr_str(c) -> F.Column:
    return F.array_join(F.col(c).cast("array<string>"), " ")


def q_encode_tokens(spark, sf):
    tokens, vocab, stats, _ = _prep(spark, sf)
    return E.encode_tokens(tokens, vocab, stats.vocab_size)


def q_subsample(spark, sf):
    """Tokens that survive subsampling in epoch 0 (before renumbering)."""
    _, _, _, enc = _prep(spark, sf)
    # The dice of a token that is kept for certain are not thrown.
    kept = F.filter("toks", lambda x: (x["keep"] >= 1.0) | (E.keyed_uniform(
        "sub", CHECK_SEED, CHECK_EPOCH, F.col("doc_id"), F.col("line_no"), x["pos"]) < x["keep"]))
    return enc.select("doc_id", "line_no", F.explode(kept).alias("x")).select(
        "doc_id", "line_no", F.col("x.pos").alias("pos"), F.col("x.idx").alias("idx"))


def _sents(spark, sf):
    tokens, vocab, stats, enc = _prep(spark, sf)
    return stats, E.sample_sentences(enc, CHECK_SEED, CHECK_EPOCH)


def q_encoded_sentences(spark, sf):
    _, s = _sents(spark, sf)
    return s.select("doc_id", "line_no", F.size("t").cast("bigint").alias("n"), _arr_str("t").alias("t"))


def q_dynamic_windows(spark, sf):
    _, _, _, enc = _prep(spark, sf)
    return E.made_windows(enc, CHECK_WINDOW, CHECK_SEED, CHECK_EPOCH, ["doc_id", "line_no", "p", "center", "win"])


def q_context_pairs(spark, sf):
    _, _, _, enc = _prep(spark, sf)
    return E.context_pairs(E.made_windows(enc, CHECK_WINDOW, CHECK_SEED, CHECK_EPOCH,
                                          ["doc_id", "line_no", "p", "center", "context"]))


def _noise_parts(spark, sf):
    tokens, vocab, stats, enc = _prep(spark, sf)
    nb = N.bucket_count(stats.vocab_size)
    return tokens, vocab, stats, enc, N.draw_table(vocab, nb, stats.vocab_size), nb


def q_negative_samples(spark, sf):
    _, vocab, stats, enc, buckets, nb = _noise_parts(spark, sf)
    ex = E.made_windows(enc, CHECK_WINDOW, CHECK_SEED, CHECK_EPOCH, ["doc_id", "line_no", "p"])
    return E.negative_samples(ex, CHECK_NEGATIVES, CHECK_SEED, CHECK_EPOCH, buckets, nb, stats.vocab_size)


def q_training_examples(spark, sf):
    _, vocab, stats, enc, buckets, nb = _noise_parts(spark, sf)
    full = E.table_of(E.made_examples(enc, CHECK_WINDOW, CHECK_NEGATIVES, CHECK_SEED, CHECK_EPOCH, buckets, nb,
                                      stats.vocab_size))
    return full.select("doc_id", "line_no", "p", "center", _arr_str("context").alias("context"),
                       _arr_str("negatives").alias("negatives"))


def q_estimate_pairs(spark, sf):
    _, _, _, enc = _prep(spark, sf)
    return E.estimate_pairs(enc, CHECK_WINDOW)


CHECK_EPOCHS = 5


def q_lr_schedule(spark, sf):
    """Step and learning rate of every centre of epoch 0 in sequential order
    (total steps = pair estimate x 5 epochs)."""
    _, _, _, enc = _prep(spark, sf)
    # The corpus is read once: the estimate, the sort's sample and the sort take the lengths.
    n = write_table(E.sentence_lengths(enc, CHECK_SEED, CHECK_EPOCH), "lengths")
    est = E.estimate_pairs(n, CHECK_WINDOW).first()["estimate"]
    sched = E.lr_schedule(None, CHECK_SEED, CHECK_EPOCH, 0, est * CHECK_EPOCHS, CHECK_LR, 0.0001, sents=n)
    return sched.select("doc_id", "line_no", "p", "step", r6("lr").alias("lr"))


def q_epoch_shuffle(spark, sf):
    sents = T.tokenized_lines(C.corpus_lines(spark, sf))
    return E.epoch_order(sents, CHECK_SEED, CHECK_EPOCH)


QUERIES.update({
    "encode_tokens": q_encode_tokens,
    "subsample": q_subsample,
    "encoded_sentences": q_encoded_sentences,
    "dynamic_windows": q_dynamic_windows,
    "context_pairs": q_context_pairs,
    "negative_samples": q_negative_samples,
    "training_examples": q_training_examples,
    "estimate_pairs": q_estimate_pairs,
    "lr_schedule": q_lr_schedule,
    "epoch_shuffle": q_epoch_shuffle,
})


# ---------------------------------------------------------------- slice 4

from ..operators import serving as S  # noqa: E402
from ..sources.vectors import embedding_table  # noqa: E402

EMB_DIM = 64


def _emb(spark, sf):
    return embedding_table(spark, sf)


def _next_pairs(emb):
    """Every word with the word of the next id (missing for the last one)."""
    a = emb.select(F.col("word").alias("word_a"), F.col("idx").alias("_ia"))
    return a.select("word_a", (F.col("_ia") + 1).cast("string").alias("word_b"))


def q_embedding_stats(spark, sf):
    return S.embedding_stats(_emb(spark, sf))


def q_get_vectors(spark, sf):
    """Vectors of the words (ids + 1) of every row; the last one is unknown."""
    emb = _emb(spark, sf)
    asked = _next_pairs(emb).select(F.col("word_b").alias("word"))
    got = S.get_vectors(asked, emb)
    return got.select("word", "found", F.posexplode_outer("vec").alias("j", "val")).select(
        "word", "found", F.col("j").cast("int").alias("j"), r6("val").alias("val"))


def q_vector_norms(spark, sf):
    return S.vector_norms(_emb(spark, sf)).select("idx", "word", r6("norm").alias("norm"))


def q_normalize_vectors(spark, sf):
    n = S.normalize_vectors(_emb(spark, sf))
    return S.long_form(n, ["idx"]).select("idx", "j", r6("val").alias("val"))


def q_pair_similarity(spark, sf):
    emb = _emb(spark, sf)
    res = S.pair_similarity(_next_pairs(emb), emb)
    return res.select("word_a", "word_b", r6("similarity").alias("similarity"), "is_oov")


def q_most_similar(spark, sf):
    """Top-10 neighbours of every word of the table."""
    emb = _emb(spark, sf)
    res = S.most_similar(emb.select("word"), emb, CHECK_TOP_K)
    return res.select("query", "word", r6("similarity").alias("similarity"), "rank")


def q_analogy(spark, sf):
    """Top-5 answers of id - (id+1) + (id+2) for every id of the table."""
    emb = _emb(spark, sf)
    ids = emb.select("idx")
    triples = ids.select(F.col("idx").cast("string").alias("pos_a"),
                         (F.col("idx") + 1).cast("string").alias("neg_a"),
                         (F.col("idx") + 2).cast("string").alias("pos_b"))
    res = S.analogy(triples, emb, 5)
    return res.select("pos_a", "neg_a", "pos_b", "word", r6("similarity").alias("similarity"), "rank", "is_oov")


def q_neighbor_sample(spark, sf):
    """The first 5 words in byte order, each with its top-5 neighbours."""
    emb = _emb(spark, sf)
    first5 = emb.select("word").orderBy("word").limit(5)
    res = S.most_similar(first5, emb, 5)
    return res.select("query", "word", r6("similarity").alias("similarity"), "rank")


def q_vector_means(spark, sf):
    m = S.vector_means(_emb(spark, sf), EMB_DIM)
    return m.select(F.posexplode("mean").alias("j", "mean")).select(
        F.col("j").cast("int").alias("j"), r6("mean").alias("mean"))


def q_centered_vectors(spark, sf):
    c = S.centered_vectors(_emb(spark, sf), EMB_DIM)
    return S.long_form(c, ["idx"]).select("idx", "j", r6("val").alias("val"))


def q_text_vectors(spark, sf):
    return S.text_vectors(_emb(spark, sf), EMB_DIM)


QUERIES.update({
    "embedding_stats": q_embedding_stats,
    "get_vectors": q_get_vectors,
    "vector_norms": q_vector_norms,
    "normalize_vectors": q_normalize_vectors,
    "pair_similarity": q_pair_similarity,
    "most_similar": q_most_similar,
    "analogy": q_analogy,
    "neighbor_sample": q_neighbor_sample,
    "vector_means": q_vector_means,
    "centered_vectors": q_centered_vectors,
    "text_vectors": q_text_vectors,
})


# ---------------------------------------------------------------- slice 5

from ..operators import steps as ST  # noqa: E402


def r5(c) -> F.Column:
    """Half-up to 5 decimals, for sums over very many terms."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c.cast("double") * F.lit(1e5) + F.lit(0.5)).cast("double") / F.lit(1e5)


def _step_inputs(spark, sf):
    """Epoch-0 examples with negatives, and hash-initialised weights (dim 8,
    non-zero W_out) over the min_count-5 vocabulary of `documents`."""
    _, vocab, stats, enc, buckets, nb = _noise_parts(spark, sf)
    full = E.made_examples(enc, CHECK_WINDOW, CHECK_NEGATIVES, CHECK_SEED, CHECK_EPOCH, buckets, nb, stats.vocab_size)
    # A step beyond the gate reads its examples several times: materialise once.
    if not ST.in_tasks(stats.vocab_size, CHECK_DIM):
        full = write_table(E.table_of(full), "examples")
    w = write_table(ST.init_weights(vocab, CHECK_DIM, CHECK_SEED, out_init="hash"), "weights")
    return stats, full, w


def _weights_long(w, digits=r6):
    lf = w.select("idx", F.posexplode(F.arrays_zip("w_in", "w_out")).alias("j", "z"))
    return lf.select("idx", F.col("j").cast("int").alias("j"), digits(F.col("z.w_in")).alias("w_in"),
                     digits(F.col("z.w_out")).alias("w_out"))


def _grads_long(g):
    return g.select("matrix", "idx", F.posexplode("grad").alias("j", "grad")).select(
        "matrix", "idx", F.col("j").cast("int").alias("j"), r5("grad").alias("grad"))


def q_init_weights(spark, sf):
    """Reference init: W_in ~ U(-r, r), W_out = 0 (dim 8, min_count 5)."""
    vocab = _vocab(spark, sf, CHECK_MIN_COUNT)
    return _weights_long(ST.init_weights(vocab, CHECK_DIM, CHECK_SEED))


def q_sgns_pair_loss(spark, sf):
    stats, ex, w = _step_inputs(spark, sf)
    el = ST.sgns_example_loss(ex, w, stats.vocab_size, CHECK_DIM)
    return el.select("doc_id", "line_no", "p", r6("loss").alias("loss"), "n_targets")


def q_sgns_gradient(spark, sf):
    stats, ex, w = _step_inputs(spark, sf)
    return _grads_long(ST.sgns_gradients(ex, w, stats.vocab_size, CHECK_DIM))


def q_sgns_step(spark, sf):
    stats, ex, w = _step_inputs(spark, sf)
    return _weights_long(ST.sgns_step(ex, w, stats.vocab_size, CHECK_DIM, CHECK_LR), r5)


def q_epoch_loss(spark, sf):
    """Average skip-gram loss per centre over the epoch-0 examples."""
    stats, ex, w = _step_inputs(spark, sf)
    return ST.epoch_loss(ST.totals(ex, w, stats.vocab_size, CHECK_DIM)).select("centers", r5("avg_loss").alias("avg_loss"))


def q_cbow_context_mean(spark, sf):
    stats, ex, w = _step_inputs(spark, sf)
    h = ST.cbow_context_mean(ex, w, stats.vocab_size, CHECK_DIM)
    return h.select("doc_id", "line_no", "p", "n_ctx", F.posexplode("h").alias("j", "h")).select(
        "doc_id", "line_no", "p", "n_ctx", F.col("j").cast("int").alias("j"), r6("h").alias("h"))


def q_cbow_loss(spark, sf):
    stats, ex, w = _step_inputs(spark, sf)
    el = ST.cbow_example_loss(ex, w, stats.vocab_size, CHECK_DIM)
    return el.select("doc_id", "line_no", "p", r6("loss").alias("loss"), "n_targets")


def q_cbow_gradient(spark, sf):
    stats, ex, w = _step_inputs(spark, sf)
    return _grads_long(ST.cbow_batch_gradients(ex, w, stats.vocab_size, CHECK_DIM))


def q_cbow_step(spark, sf):
    stats, ex, w = _step_inputs(spark, sf)
    return _weights_long(ST.cbow_step(ex, w, stats.vocab_size, CHECK_DIM, CHECK_LR), r5)


QUERIES.update({
    "init_weights": q_init_weights,
    "sgns_pair_loss": q_sgns_pair_loss,
    "sgns_gradient": q_sgns_gradient,
    "sgns_step": q_sgns_step,
    "epoch_loss": q_epoch_loss,
    "cbow_context_mean": q_cbow_context_mean,
    "cbow_loss": q_cbow_loss,
    "cbow_gradient": q_cbow_gradient,
    "cbow_step": q_cbow_step,
})


# ---------------------------------------------------------------- slice 6-7

from ..config import EmbeddingConfig  # noqa: E402
from ..operators import pca as PC  # noqa: E402
from ..plans import trainer as TR  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import model_store as MS  # noqa: E402

# Training parameters of the registered training queries (whole `documents`):
# batch steps over all examples, which SQL can follow round by round.
TRAIN_EPOCHS = 2
TRAIN_CFG = EmbeddingConfig(embedding_dim=CHECK_DIM, window_size=CHECK_WINDOW, negative_samples=CHECK_NEGATIVES,
                            epochs=TRAIN_EPOCHS, min_count=CHECK_MIN_COUNT, seed=CHECK_SEED,
                            learning_rate=CHECK_LR, algorithm="batch", rounds_per_epoch=1)


def r3(c) -> F.Column:
    """Half-up to 3 decimals, for values that went through several float steps."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c.cast("double") * F.lit(1e3) + F.lit(0.5)).cast("double") / F.lit(1e3)


def _train(spark, sf, model="skipgram"):
    return TR.train(spark, C.corpus_lines(spark, sf), TRAIN_CFG.with_(model=model))


def _vectors_long(emb):
    return emb.select("idx", "word", "cnt", F.posexplode("vec").alias("j", "val")).select(
        "idx", "word", "cnt", F.col("j").cast("int").alias("j"), r3("val").alias("val"))


def q_train_skipgram(spark, sf):
    """Input vectors after two epochs of batch steps."""
    return _vectors_long(_train(spark, sf).embeddings())


def q_train_cbow(spark, sf):
    return _vectors_long(_train(spark, sf, "cbow").embeddings())


def q_train_local(spark, sf):
    """Epoch history of local-SGD rounds (no SQL form: row check and pytest)."""
    cfg = TRAIN_CFG.with_(algorithm="local", embedding_dim=16, rounds_per_epoch=2, kernel_batch=16)
    return TR.train(spark, C.corpus_lines(spark, sf), cfg).history


def q_train_stratified(spark, sf):
    """Epoch history of stratified rounds over the whole corpus: sequential SGD, nothing
    merged or capped (no SQL form: pytest recomputes it update by update)."""
    cfg = TRAIN_CFG.with_(algorithm="stratified", embedding_dim=16, shards=4)
    return TR.train(spark, C.corpus_lines(spark, sf), cfg).history.drop("elapsed_secs")


def q_training_history(spark, sf):
    """Everything but the wall time."""
    return _train(spark, sf).history.select(
        "epoch", r3("avg_loss").alias("avg_loss"), r6("learning_rate").alias("learning_rate"),
        "pairs_processed", r6("lr_last").alias("lr_last"), "rounds")


def q_model_roundtrip(spark, sf):
    m = _train(spark, sf)
    path = scratch_path(spark, "model")
    MS.save_model(m, path)
    return _vectors_long(MS.load_model(spark, path).embeddings())


def q_loss_curve_points(spark, sf):
    return PC.loss_curve_points(_train(spark, sf).history).select(
        "epoch", *[r3(c).alias(c) for c in ("avg_loss", "y_min", "y_max")])


def q_pca_2d(spark, sf):
    """PCA coordinates of every word of the `embeddings` table."""
    return PC.pca_2d(_emb(spark, sf)).select("idx", "word", r5("pc1").alias("pc1"), r5("pc2").alias("pc2"))


def q_pca_top50(spark, sf):
    """The scatter data of the 50 most frequent words (lowest ids)."""
    return PC.pca_2d(_emb(spark, sf), 50).select("idx", "word", r5("pc1").alias("pc1"), r5("pc2").alias("pc2"))


def q_pca_ranges(spark, sf):
    return PC.pca_ranges(PC.pca_2d(_emb(spark, sf))).select(
        *[r5(c).alias(c) for c in ("x_min", "x_max", "y_min", "y_max")])


QUERIES.update({
    "train_skipgram": q_train_skipgram,
    "train_cbow": q_train_cbow,
    "training_history": q_training_history,
    "model_roundtrip": q_model_roundtrip,
    "loss_curve_points": q_loss_curve_points,
    "train_local": q_train_local,
    "train_stratified": q_train_stratified,
    "pca_2d": q_pca_2d,
    "pca_top50": q_pca_top50,
    "pca_ranges": q_pca_ranges,
})


def q_noise_distribution_shifted(spark, sf):
    """The probability law of the reference's table loop (mass moved one id up)."""
    vocab = _vocab(spark, sf, CHECK_MIN_COUNT)
    n = V.collect_stats(vocab).vocab_size
    return N.noise_shifted(N.noise_distribution(vocab), n).select("idx", r6("p").alias("p"))


QUERIES["noise_distribution_shifted"] = q_noise_distribution_shifted


def q_conversation_lines(spark, sf):
    """The `conversations` table as a corpus (one sentence per line of a turn)."""
    return C.conversation_lines(spark, sf)


QUERIES["conversation_lines"] = q_conversation_lines
