"""Training examples: token ids per sentence, subsampling, dynamic windows,
negative draws, the pair estimate and the learning-rate schedule.

Plan shape.  Tokens are joined to the vocabulary once and regrouped per line
into ``encoded`` (one row per sentence) without leaving their task.
Everything that happens per epoch (subsampling dice, renumbering,
windows, negative draws) is row-local on that table (``example_kernel``), with
the noise ranges that a task rebuilds from the runs of equal counts.  So an epoch adds no shuffle of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rng import keyed_uniform
from ..functions.training import keep_probability, linear_decay
from ..session import fits_broadcast
from . import example_kernel as K
from . import noise as N
from .rank import dense_index, prefix_sum
from .tokenize import token_array

@dataclass(frozen=True)
class Made:
    """Examples that are made in the task that uses them: the batches of ``source``
    through ``kernel`` have the columns of ``schema``."""
    source: DataFrame
    kernel: Callable
    schema: T.StructType

    def table(self) -> DataFrame:
        return self.source.mapInArrow(self.kernel, self.schema)


def table_of(examples: DataFrame | Made) -> DataFrame:
    return examples.table() if isinstance(examples, Made) else examples


_VOCAB_ROW_BYTES = 48         # besides the word itself
SENT_KEY = ["doc_id", "line_no"]


def _words_fit(vocab: DataFrame, vocab_size: int) -> bool:
    # A token has no length limit: the words' bytes are measured, not assumed.
    held = vocab.agg(F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("b")).first()["b"]
    return fits_broadcast(vocab_size, _VOCAB_ROW_BYTES + held // max(vocab_size, 1))


def join_vocab(tokens: DataFrame, vocab: DataFrame, vocab_size: int) -> DataFrame:
    """Inner join tokens to (word -> idx, cnt); OOV tokens drop out.

    Small vocabularies are broadcast.  Otherwise the frequent head (ids below
    the broadcast gate: the words that make most tokens and the skew) is
    broadcast and only the long tail goes through a shuffle join.
    """
    v = vocab.select("word", "idx", "cnt")
    if _words_fit(vocab, vocab_size):
        return tokens.join(F.broadcast(v), "word")
    from ..session import DEFAULT_BROADCAST_ROWS
    head_n = DEFAULT_BROADCAST_ROWS // 2
    head = v.where(F.col("idx") < head_n)
    tail = v.where(F.col("idx") >= head_n)
    first = tokens.join(F.broadcast(head), "word", "left")
    hit = first.where(F.col("idx").isNotNull())
    miss = first.where(F.col("idx").isNull()).drop("idx", "cnt").join(tail, "word")
    return hit.unionByName(miss)


def encode_tokens(tokens: DataFrame, vocab: DataFrame, vocab_size: int) -> DataFrame:
    """(doc_id, line_no, pos, idx): in-vocabulary tokens with their ids."""
    return join_vocab(tokens, vocab, vocab_size).select("doc_id", "line_no", "pos", "idx")


def encode_lines(tokens: DataFrame, vocab: DataFrame, vocab_size: int, total_tokens: int,
                 threshold: float | None) -> DataFrame:
    """One row per sentence: toks = [(pos, idx, keep)] sorted by pos.

    ``keep`` is the word's subsampling keep probability (1.0 when
    ``threshold`` is None).  The regroup is the only corpus shuffle of
    training; its key is the sentence, which is never hot.
    """
    j = join_vocab(tokens, vocab, vocab_size)
    keep = (F.lit(1.0) if threshold is None
            else keep_probability(F.col("cnt"), F.lit(int(total_tokens)), threshold))
    j = j.select(*SENT_KEY, "pos", "idx", keep.alias("keep"))
    return j.groupBy(*SENT_KEY).agg(
        F.array_sort(F.collect_list(F.struct("pos", "idx", "keep"))).alias("toks"))


def _by_line(batches):
    """Rows of one line follow each other: one row per line with its tokens."""
    held = []

    def lines():
        t = pa.Table.from_batches(held).combine_chunks()
        at = np.flatnonzero(np.diff(t.column("rid").to_numpy(), prepend=-1))
        toks = pa.StructArray.from_arrays([t.column(c).combine_chunks() for c in ("pos", "idx", "keep")],
                                          ["pos", "idx", "keep"])
        cuts = pa.array(np.append(at, len(t)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [*[t.column(c).combine_chunks().take(pa.array(at)) for c in SENT_KEY], pa.ListArray.from_arrays(cuts, toks)],
            [*SENT_KEY, "toks"])

    for b in batches:
        if not b.num_rows:
            continue
        rid = b.column("rid").to_numpy()
        if held and held[-1].column("rid")[-1].as_py() != rid[0]:
            yield lines()
            held = []
        cuts = np.flatnonzero(np.diff(rid))
        if len(cuts):
            held.append(b.slice(0, cuts[-1] + 1))
            yield lines()
            held, b = [], b.slice(cuts[-1] + 1)
        held.append(b)
    if held:
        yield lines()


HELD_WORDS = 3 << 27          # bytes of words with their hashes, ids and keep probabilities
_HELD_ROW_BYTES = 32          # besides the word itself
PIECE = 1 << 20               # words that come to the driver at once


def _held_words(words: DataFrame, vocab_size: int):
    """(hashes in order, words, ids, keep) of a vocabulary, or None if a task cannot hold it
    or two words have one hash."""
    size = words.agg(F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("b")).first()["b"]
    if not fits_broadcast(vocab_size, _HELD_ROW_BYTES + size // max(vocab_size, 1), vocab_size, HELD_WORDS):
        return None
    rows = words.select(F.xxhash64("word").alias("h"), "word", "idx", "keep")
    t = pa.concat_tables([rows.where(F.col("idx").between(a, a + PIECE - 1)).toArrow()
                          for a in range(0, max(vocab_size, 1), PIECE)])
    h = t.column("h").to_numpy()
    order = np.argsort(h, kind="stable")
    h = h[order]
    if len(h) != vocab_size or (np.diff(h) == 0).any():
        return None
    return h, t.column("word").combine_chunks().take(pa.array(order)), t.column("idx").to_numpy()[order], \
        t.column("keep").to_numpy()[order]


def _known(held):
    """Tokens ``(rid, key, pos, word, h)`` that are words of the vocabulary, with their ids: found by the
    hash, then compared."""
    def run(batches):
        h, words, idx, keep = held.value
        for b in batches:
            own = b.column("h").to_numpy()
            at = np.minimum(np.searchsorted(h, own), len(h) - 1)
            same = np.flatnonzero(h[at] == own)
            word = b.column("word").take(pa.array(same)).cast(words.type)
            same = same[pc.equal(words.take(pa.array(at[same])), word).to_numpy(zero_copy_only=False)]
            b, at = b.take(pa.array(same)), at[same]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("rid", *SENT_KEY, "pos")], pa.array(idx[at]),
                                              pa.array(keep[at])], ["rid", *SENT_KEY, "pos", "idx", "keep"])
    return run


def encode_corpus(lines: DataFrame, vocab: DataFrame, vocab_size: int, total_tokens: int,
                  threshold: float | None) -> DataFrame:
    """``encode_lines`` of a corpus: the same rows, from the lines themselves.

    A line's tokens are exploded, meet the vocabulary (by a broadcast join, or beyond its
    gate in Python, where a word takes fewer bytes) and are put together again inside
    their task, so the corpus is not shuffled.  Only words beyond the broadcast head of a
    vocabulary that a task cannot hold, and lines whose key occurs more than once, are
    brought together by a shuffle, as one array per line.
    """
    fits = _words_fit(vocab, vocab_size)
    keep = (F.lit(1.0) if threshold is None
            else keep_probability(F.col("cnt"), F.lit(int(total_tokens)), threshold))
    words = vocab.select("word", "idx", keep.alias("keep"))
    tokens = lines.select("*", F.monotonically_increasing_id().alias("rid")) \
        .select("rid", *SENT_KEY, F.posexplode(token_array("line")).alias("pos", "word"))

    schema = "doc_id bigint, line_no int, toks array<struct<pos:int,idx:bigint,keep:double>>"

    def by_line(v):
        return tokens.join(F.broadcast(v), "word").select("rid", *SENT_KEY, "pos", "idx", "keep").mapInArrow(_by_line, schema)

    held = None if fits else _held_words(words, vocab_size)
    if held is not None:
        held = lines.sparkSession.sparkContext.broadcast(held)
        out = tokens.select("rid", *SENT_KEY, "pos", "word", F.xxhash64("word").alias("h")).mapInArrow(
            K.chain(_known(held), _by_line), schema)
    if fits or held is not None:
        out = by_line(words) if fits else out
        twice = lines.groupBy(*SENT_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if twice.isEmpty():
            return out
    else:
        from ..session import DEFAULT_BROADCAST_ROWS
        head_n = DEFAULT_BROADCAST_ROWS // 2
        head, tail = words.where(F.col("idx") < head_n), words.where(F.col("idx") >= head_n)
        rare = tokens.join(F.broadcast(head.select("word")), "word", "left_anti").join(tail, "word")
        out = by_line(head).unionByName(rare.select(*SENT_KEY, F.array(F.struct("pos", "idx", "keep")).alias("toks")))
    return out.groupBy(*SENT_KEY).agg(F.array_sort(F.flatten(F.collect_list("toks"))).alias("toks"))


def sample_sentences(encoded: DataFrame, seed: int, epoch: int, min_len: int = 2) -> DataFrame:
    """Subsample (dice keyed by the original position) and renumber.

    Returns (doc_id, line_no, t ARRAY<BIGINT>) for sentences that keep at
    least ``min_len`` tokens.
    """
    return encoded.select(*SENT_KEY, "toks").mapInArrow(K.sample(seed, epoch, min_len),
                                                        "doc_id bigint, line_no int, t array<bigint>")


def sentence_ids(encoded: DataFrame, min_len: int = 0) -> DataFrame:
    """Ids without subsampling (all in-vocabulary tokens)."""
    out = encoded.select(*SENT_KEY, F.transform("toks", lambda x: x["idx"]).alias("t"))
    return out.where(F.size("t") >= F.lit(min_len))


def window_width(seed: int, epoch: int, window: int, p) -> F.Column:
    """Dynamic window width in 1..window, keyed by (sentence, position)."""
    u = keyed_uniform("win", seed, epoch, F.col("doc_id"), F.col("line_no"), p)
    return (F.lit(1) + F.floor(u * F.lit(window))).cast("int")


def centre_examples(sents: DataFrame, window: int, seed: int, epoch: int, k: int = 0) -> DataFrame:
    """(doc_id, line_no, p, center, win, context ARRAY<BIGINT>), one row per
    centre; context = ids at positions p-win..p+win except p, in order.
    With ``k`` the sentences hold ``negs`` (k ids per position, in order) and a
    centre also gets its own as ``negatives``.

    The widths are drawn once per position into an array first (a lambda
    body has no common-subexpression elimination, so referring to the draw
    three times would hash three times).  Each centre row carries only its
    own <= 2 * window context ids, never the whole sentence.
    """
    if not k:
        return sents.select(*SENT_KEY, "t").mapInArrow(
            K.windows(window, seed, epoch),
            "doc_id bigint, line_no int, p int, center bigint, win int, context array<bigint>")
    n = F.size("t")
    positions = F.sequence(F.lit(0), n - 1)
    with_w = sents.select(*SENT_KEY, "t", *(["negs"] if k else []), F.transform(
        positions, lambda p: window_width(seed, epoch, window, p)).alias("_w"))

    def one(p):
        w = F.element_at("_w", p + 1)
        start = F.greatest(p - w, F.lit(0))
        left = F.slice("t", start + 1, p - start)
        right = F.slice("t", p + 2, w)
        own = [F.slice("negs", p * k + 1, F.lit(k)).alias("negatives")] if k else []
        return F.struct(p.alias("p"), F.element_at("t", p + 1).alias("center"),
                        w.alias("win"), F.concat(left, right).alias("context"), *own)

    ex = with_w.select(*SENT_KEY, F.explode(F.transform(positions, one)).alias("e"))
    ex = ex.select(*SENT_KEY, F.col("e.p").cast("int").alias("p"), F.col("e.center").alias("center"),
                   F.col("e.win").alias("win"), F.col("e.context").alias("context"),
                   *([F.col("e.negatives").alias("negatives")] if k else []))
    return ex.where(F.size("context") > 0)


_IDS = T.ArrayType(T.LongType())
_FIELDS = {"doc_id": T.LongType(), "line_no": T.IntegerType(), "p": T.IntegerType(), "center": T.LongType(),
           "win": T.IntegerType(), "context": _IDS, "negatives": _IDS}


def made_windows(encoded: DataFrame, window: int, seed: int, epoch: int, columns: list[str]) -> DataFrame:
    """``centre_examples`` of the epoch's ``sample_sentences`` in one task, its ``columns`` only."""
    kernel = K.chain(K.sample(seed, epoch, 2), K.windows(window, seed, epoch), K.columns(columns))
    return Made(encoded.select(*SENT_KEY, "toks"), kernel,
                T.StructType([T.StructField(c, _FIELDS[c]) for c in columns])).table()


def made_examples(encoded: DataFrame, window: int, k: int, seed: int, epoch: int, buckets: N.NoiseRuns | DataFrame,
                  n_buckets: int, vocab_size: int, shifted: bool = False) -> DataFrame | Made:
    """``training_examples`` of the epoch's ``sample_sentences``: with runs they are made
    where they are used, from the encoded line to the last negative in one task."""
    if not isinstance(buckets, N.NoiseRuns):
        return training_examples(sample_sentences(encoded, seed, epoch), window, k, seed, epoch, buckets, n_buckets,
                                 vocab_size, shifted)
    columns = [*SENT_KEY, "p", "center", "context", "negatives"]
    kernel = K.chain(K.sample(seed, epoch, 2), K.windows(window, seed, epoch),
                     K.draws(buckets, k, seed, epoch, vocab_size, shifted), K.columns(columns))
    return Made(encoded.select(*SENT_KEY, "toks"), kernel,
                T.StructType([T.StructField(c, _FIELDS[c]) for c in columns]))


def made_steps(encoded: DataFrame, lengths: DataFrame, window: int, k: int, seed: int, epoch: int, runs: N.NoiseRuns,
               vocab_size: int, shifted: bool, step0: int) -> tuple[DataFrame, Callable]:
    """(sentences, kernel) of an epoch's examples ``(first, p, center, context, negatives)``,
    ``first`` being the step of the sentence's first centre: only sentences meet the
    schedule, by their ``lengths``; one without a key has no place in it."""
    first = ranked_sentences(lengths.select(*SENT_KEY, F.col("n_kept").alias("_n")).where("_n >= 2"), seed, epoch)
    first = first.select(*SENT_KEY, (F.col("_ce").cast("bigint") + F.lit(int(step0))).alias("first"))
    own = ("first",)
    kernel = K.chain(K.sample(seed, epoch, 2, own), K.windows(window, seed, epoch, own),
                     K.draws(runs, k, seed, epoch, vocab_size, shifted),
                     K.columns(["first", "p", "center", "context", "negatives"]))
    return encoded.join(first, SENT_KEY).select(*SENT_KEY, "toks", "first"), kernel


def context_pairs(examples: DataFrame) -> DataFrame:
    """Long form (doc_id, line_no, p, center, ci, context): one row per
    (centre, context slot)."""
    return examples.select(*SENT_KEY, "p", "center",
                           F.posexplode("context").alias("ci", "context")) \
        .select(*SENT_KEY, "p", "center", F.col("ci").cast("int").alias("ci"), "context")


def negative_draws(examples: DataFrame, k: int, seed: int, epoch: int) -> DataFrame:
    """k keyed uniforms per centre: (doc_id, line_no, p, slot, u)."""
    d = examples.select(*SENT_KEY, "p", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("slot"))
    return d.withColumn("u", keyed_uniform("neg", seed, epoch, F.col("doc_id"), F.col("line_no"),
                                           F.col("p"), F.col("slot")))


def _drawn(examples: DataFrame, k: int, seed: int, epoch: int, runs: N.NoiseRuns, vocab_size: int,
           shifted: bool) -> DataFrame:
    schema = T.StructType([*examples.schema.fields, T.StructField("negatives", T.ArrayType(T.LongType()))])
    return examples.mapInArrow(K.draws(runs, k, seed, epoch, vocab_size, shifted), schema)


def negative_samples(examples: DataFrame, k: int, seed: int, epoch: int, buckets: DataFrame,
                     n_buckets: int, vocab_size: int, shifted: bool = False) -> DataFrame:
    """(doc_id, line_no, p, slot, neg): the k negatives of every centre.  ``buckets``
    is the bucket table, or the runs of :func:`noise.draw_table`."""
    if isinstance(buckets, N.NoiseRuns):
        got = _drawn(examples.select(*SENT_KEY, "p"), k, seed, epoch, buckets, vocab_size, shifted)
        return got.select(*SENT_KEY, "p", F.posexplode("negatives").alias("slot", "neg"))
    draws = negative_draws(examples, k, seed, epoch)
    got = N.lookup_draws(draws, buckets, n_buckets, vocab_size, "u", "neg", shifted)
    return got.select(*SENT_KEY, "p", F.col("slot").cast("int").alias("slot"), "neg")


def with_negatives(examples: DataFrame, k: int, seed: int, epoch: int, buckets: DataFrame,
                   n_buckets: int, vocab_size: int, shifted: bool = False) -> DataFrame:
    """Examples with ``negatives ARRAY<BIGINT>`` (slot order).

    With runs every example gets its own in place.  With a bucket table, draws carry the example through explode + lookup; the regroup keys on
    the example itself (context array included) with one fixed-width
    ``max(when(slot = s))`` per slot, so it stays a codegen'd hash
    aggregate.  The input keeps its sentence partitioning through the
    explode and the broadcast lookup, so the regroup needs no shuffle then.
    """
    if isinstance(buckets, N.NoiseRuns):
        return _drawn(examples.select(*SENT_KEY, "p", "center", "context"), k, seed, epoch, buckets, vocab_size, shifted)
    draws = examples.select(*SENT_KEY, "p", "center", "context",
                            F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("slot"))
    draws = draws.withColumn("u", keyed_uniform("neg", seed, epoch, F.col("doc_id"),
                                                F.col("line_no"), F.col("p"), F.col("slot")))
    got = N.lookup_draws(draws, buckets, n_buckets, vocab_size, "u", "neg", shifted)
    g = got.groupBy(*SENT_KEY, "p", "center", "context").agg(
        *[F.max(F.when(F.col("slot") == s, F.col("neg"))).alias(f"_n{s}") for s in range(k)])
    return g.select(*SENT_KEY, "p", "center", "context",
                    F.array(*[F.col(f"_n{s}") for s in range(k)]).alias("negatives"))


def sentence_negatives(sents: DataFrame, k: int, seed: int, epoch: int, buckets: DataFrame,
                       n_buckets: int, vocab_size: int, shifted: bool = False) -> DataFrame:
    """Sentences with ``negs``: the k negatives of every position, in order.  Only
    (sentence, position, slot, draw) goes through the lookup; sentences meet
    their draws again as one row each."""
    spots = sents.select(*SENT_KEY, F.explode(F.sequence(F.lit(0), F.size("t") - 1)).alias("p"))
    drawn = negative_samples(spots, k, seed, epoch, buckets, n_buckets, vocab_size, shifted)
    per = drawn.groupBy(*SENT_KEY).agg(F.array_sort(F.collect_list(F.struct("p", "slot", "neg"))).alias("d"))
    return sents.join(per.select(*SENT_KEY, F.transform("d", lambda x: x["neg"]).alias("negs")), SENT_KEY)


def training_examples(sents: DataFrame, window: int, k: int, seed: int, epoch: int, buckets: DataFrame,
                      n_buckets: int, vocab_size: int, shifted: bool = False) -> DataFrame:
    """(doc_id, line_no, p, center, context, negatives) of an epoch's sentences.

    With runs, or a bucket table under the size gate, draws are looked up in place.
    Beyond it the lookup shuffles, so it runs before the windows are cut: no
    exchange then carries a context."""
    if k == 0 or isinstance(buckets, N.NoiseRuns) or N.in_place(n_buckets, vocab_size):
        return with_negatives(centre_examples(sents, window, seed, epoch), k, seed, epoch, buckets, n_buckets,
                              vocab_size, shifted)
    full = sentence_negatives(sents, k, seed, epoch, buckets, n_buckets, vocab_size, shifted)
    return centre_examples(full, window, seed, epoch, k).drop("win")


def sentence_lengths(encoded: DataFrame, seed: int, epoch: int) -> DataFrame:
    """(doc_id, line_no, n_all, n_kept): tokens of every sentence, and those that the
    epoch's subsampling keeps."""
    return encoded.select(*SENT_KEY, "toks").mapInArrow(
        K.lengths(seed, epoch), "doc_id bigint, line_no int, n_all bigint, n_kept bigint")


def estimate_pairs(encoded: DataFrame, window: int) -> DataFrame:
    """sum over sentences of max(in-vocab length - 1, 0) * window * 2; ``encoded`` may
    be the :func:`sentence_lengths`."""
    n = F.size("toks") if "toks" in encoded.columns else F.col("n_all")
    per = F.greatest(n - F.lit(1), F.lit(0)).cast("bigint") * F.lit(window * 2)
    return encoded.agg(F.coalesce(F.sum(per), F.lit(0)).cast("bigint").alias("estimate"))


def shuffle_key(seed: int, epoch: int) -> F.Column:
    return keyed_uniform("shuf", seed, epoch, F.col("doc_id"), F.col("line_no"))


def epoch_order(sents: DataFrame, seed: int, epoch: int) -> DataFrame:
    """(doc_id, line_no, ord): the epoch's sentence order as a dense rank."""
    keyed = sents.select(*SENT_KEY, shuffle_key(seed, epoch).alias("_u"))
    ranked = dense_index(keyed, ["_u", "doc_id", "line_no"], "ord")
    return ranked.select(*SENT_KEY, "ord")


def ranked_sentences(per: DataFrame, seed: int, epoch: int) -> DataFrame:
    """Sentences with ``_n`` centres in the epoch's order, with the centres before them (``_ce``)."""
    per = per.withColumn("_u", shuffle_key(seed, epoch))
    return prefix_sum(dense_index(per, ["_u", "doc_id", "line_no"], "_ord"), "_ord", "_n", "_ci", "_ce")


def lr_schedule(examples: DataFrame | None, seed: int, epoch: int, step0: int, total_steps: int,
                lr0: float, lr_min: float, sents: DataFrame | None = None) -> DataFrame:
    """(doc_id, line_no, p, step, lr) in the sequential order of the epoch:
    sentences by shuffle key, centres by position.  ``sents``: the sentences (of two
    words or more, so every position is a centre) that the examples are cut from, or
    their :func:`sentence_lengths`; with them only sentences are moved."""
    # Only sentences are ranked; a centre adds its place inside its sentence.
    if sents is None:
        per = examples.groupBy(*SENT_KEY).agg(F.count(F.lit(1)).alias("_n"))
    else:
        n = F.size("t").cast("bigint") if "t" in sents.columns else F.col("n_kept")
        per = sents.select(*SENT_KEY, n.alias("_n")).where("_n >= 2")
    ranked = ranked_sentences(per, seed, epoch)
    if sents is not None:
        # As in the join below, a sentence without a key has no place.
        ranked = ranked.where(F.col("doc_id").isNotNull() & F.col("line_no").isNotNull()) \
            .select(*SENT_KEY, F.col("_ce").cast("bigint").alias("_ce"),
                    F.explode(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int"))).alias("p"))
        return _rates(ranked.withColumn("_in", F.col("p")), step0, total_steps, lr0, lr_min)
    inside = F.row_number().over(Window.partitionBy(*SENT_KEY).orderBy("p")) - 1
    ranked = examples.select(*SENT_KEY, "p", inside.alias("_in")).join(
        ranked.select(*SENT_KEY, F.col("_ce").cast("bigint").alias("_ce")), SENT_KEY)
    return _rates(ranked, step0, total_steps, lr0, lr_min)


def _rates(ranked: DataFrame, step0: int, total_steps: int, lr0: float, lr_min: float) -> DataFrame:
    step = (F.col("_ce") + F.col("_in") + F.lit(int(step0))).cast("bigint")
    progress = step.cast("double") / F.lit(float(max(total_steps, 1)))
    return ranked.select(*SENT_KEY, "p", step.alias("step"),
                         linear_decay(lr0, lr_min, progress).alias("lr"))

