"""Batch gradient steps on DataFrames (skip-gram and CBOW with negatives).

The model is a table ``weights(idx, w_in ARRAY<FLOAT>, w_out ARRAY<FLOAT>)``.
Every target sees the model as it was at the start of the batch; with small
batches this approaches the reference's sequential updates.

Skip-gram.  Equal (centre, target, label) have the same score and gradient, so they
are counted first (combined map-side) and each distinct pair is scored once; only
scalars are kept.  Each gradient side then joins the *other* side's vectors and
sums on its own key: the join and the sum never share a key, so AQE can split a
hot join key, and hot sums are combined before their shuffle.

CBOW.  Context means and scored targets are written once and feed both sides in
the same way.

While a task may hold the weights and their sums (5 million words of 8 dimensions) nothing per
pair is made: ``step_kernel`` scores a task's examples in place and gives back one
summed row per touched weight row.  The plans above are those beyond the gate, where
the joins shuffle on the word id.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as VX
from ..functions.rng import keyed_uniform
from ..functions.training import negative_loss, positive_loss, sigmoid
from ..session import fits_broadcast, write_table
from . import example_kernel as KE
from . import step_kernel as K
from .examples import Made, table_of
from .step_kernel import EX_KEY


def init_range(dim: int) -> float:
    """sqrt(6 / dim): the reference's uniform init half-width."""
    return math.sqrt(6.0 / dim)


def init_weights(vocab: DataFrame, dim: int, seed: int, out_init: str = "zero") -> DataFrame:
    """(idx, w_in, w_out): w_in ~ U(-r, r) keyed by (seed, idx, j); w_out = 0.

    ``out_init="hash"`` draws w_out the same way under its own key (used by
    the checked queries so gradients are not trivially zero).
    """
    r = F.lit(init_range(dim))
    j = F.sequence(F.lit(0), F.lit(dim - 1))

    def draw(purpose):
        return F.transform(j, lambda jj: ((F.lit(2.0) * keyed_uniform(purpose, seed, F.col("idx"), jj)
                                           - F.lit(1.0)) * r).cast("float"))

    w_out = draw("init_out") if out_init == "hash" else F.array_repeat(F.lit(0.0).cast("float"), dim)
    return vocab.select("idx", draw("init").alias("w_in"), w_out.alias("w_out"))


def _maybe_broadcast(df: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(vocab_size, dim * 8 + 32) else df


TASK_BYTES = 5 << 28          # what a task may hold: its weights, and their sums or the ones it moves


def in_tasks(vocab_size: int, dim: int, algorithm: str = "batch") -> bool:
    """Whether every task may hold the weights (V rows of known size) and what it adds up:
    sums in double precision and counts, or a copy of the weights (local rounds)."""
    held = dim * 16 + 16 if algorithm == "local" else dim * 24 + 16
    return fits_broadcast(vocab_size, held, max(vocab_size, 1), TASK_BYTES)


def broadcast_weights(weights: DataFrame, vocab_size: int, dim: int, algorithm: str = "batch"):
    """The weights for :mod:`.step_kernel`, or None beyond the gate."""
    w = K.held_weights(weights, dim) if in_tasks(vocab_size, dim, algorithm) else None
    return None if w is None else K.Held([weights.sparkSession.sparkContext.broadcast(x) for x in w])


def _through(examples: DataFrame | Made, kernel, schema: str, *columns: str, tasks: int | None = None) -> DataFrame:
    """The kernel on the examples' batches; examples not yet made are made in its task."""
    rows = examples.source if isinstance(examples, Made) else examples.select(*columns)
    kernel = KE.chain(examples.kernel, kernel) if isinstance(examples, Made) else kernel
    return (rows.coalesce(tasks) if tasks else rows).mapInArrow(kernel, schema)


def _key_fields(examples: DataFrame | Made) -> str:
    types = {f.name: f.dataType.simpleString() for f in examples.schema.fields}
    return ", ".join(f"{c} {types[c]}" for c in EX_KEY)


def _losses(examples: DataFrame | Made, held, model: str) -> DataFrame:
    return _through(examples, K.losses(held, model), f"{_key_fields(examples)}, loss double, n_targets bigint",
                    *EX_KEY, "center", "context", "negatives")


def step_sums(examples: DataFrame | Made, weights: DataFrame, vocab_size: int, dim: int,
              model: str) -> DataFrame | None:
    """(matrix, idx, grad, n) of a batch in one pass: rows "in" and "out" as the
    gradients give them, and a row "stat" with the summed loss as its first number and
    the examples as ``n``.  None beyond the gate."""
    held = broadcast_weights(weights, vocab_size, dim)
    if held is None:
        return None
    fields = ", ".join(f"_g{j} double" for j in range(dim))
    # A task gives back up to 2 * V rows: as many tasks as run at once, no more.
    parts = _through(examples, K.sums(held, model, dim), f"matrix int, idx bigint, {fields}, n bigint",
                     *EX_KEY, "center", "context", "negatives",
                     tasks=weights.sparkSession.sparkContext.defaultParallelism)
    agg = parts.repartition("idx").groupBy("matrix", "idx").agg(
        *[F.sum(f"_g{j}").alias(f"_g{j}") for j in range(dim)], F.sum("n").alias("n"))
    name = F.element_at(F.array(F.lit("in"), F.lit("out"), F.lit("stat")), F.col("matrix") + 1)
    return agg.select(name.alias("matrix"), "idx", VX.assemble("_g", dim).alias("grad"), "n")


def totals(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    """(loss, centers): summed skip-gram loss and number of the examples, in one pass
    if the tasks may hold the weights."""
    held = broadcast_weights(weights, vocab_size, dim)
    if held is None:
        examples = table_of(examples)
        loss = pair_loss(sgns_pairs(examples, weights, vocab_size, dim))
        return loss.crossJoin(examples.agg(F.count(F.lit(1)).alias("centers")))
    return _losses(examples, held, "skipgram").agg(F.coalesce(F.sum("loss"), F.lit(0.0)).alias("loss"),
                                                   F.count(F.lit(1)).alias("centers"))


def _with_targets(df: DataFrame, positive: str) -> DataFrame:
    """Explode [positive] ++ negatives; keep the positive (label 1) and every
    negative that differs from it (label 0).  Plain explode + filter: no
    higher-order function, so the stage stays in generated code."""
    t = df.select("*", F.posexplode(F.concat(F.array(F.col(positive)), F.col("negatives")))
                  .alias("_k", "target"))
    t = t.where((F.col("_k") == 0) | (F.col("target") != F.col(positive)))
    return t.withColumn("label", (F.col("_k") == 0).cast("int")).drop("_k")


def sgns_targets(examples: DataFrame) -> DataFrame:
    """One row per (centre, context slot, target): the context word with
    label 1, then each negative that differs from that context word with
    label 0 (negatives are shared by all contexts of the centre)."""
    pc = examples.select(*EX_KEY, "center", "negatives", F.posexplode("context").alias("ci", "ctx"))
    pc = pc.select(*EX_KEY, "center", F.col("ci").cast("int").alias("ci"), "ctx", "negatives")
    return _with_targets(pc, "ctx").select(*EX_KEY, "center", "ci", "target", "label")


def _score(df: DataFrame, in_vec: str, out_vec: str, dim: int) -> DataFrame:
    s = VX.dot_fixed(in_vec, out_vec, dim)
    return (df.withColumn("score", s)
            .withColumn("g", sigmoid(F.col("score")) - F.col("label").cast("double"))
            .withColumn("loss", F.when(F.col("label") == 1, positive_loss(F.col("score")))
                        .otherwise(negative_loss(F.col("score")))))


def _side(weights: DataFrame, key: str, matrix: str, vec: str, vocab_size: int, dim: int) -> DataFrame:
    return _maybe_broadcast(weights.select(F.col("idx").alias(key), F.col(matrix).alias(vec)), vocab_size, dim)


def sgns_scored(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    """Targets of every example with score, g = sigmoid(score) - label and
    capped log loss."""
    t = sgns_targets(examples).join(_side(weights, "center", "w_in", "v_c", vocab_size, dim), "center") \
        .join(_side(weights, "target", "w_out", "v_t", vocab_size, dim), "target")
    return _score(t, "v_c", "v_t", dim).drop("v_c", "v_t")


def sgns_pairs(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    """(center, target, label, n, score, g, loss): each distinct pair once, with
    the number of times the batch holds it."""
    t = sgns_targets(examples).groupBy("center", "target", "label").agg(F.count(F.lit(1)).alias("n"))
    t = t.join(_side(weights, "center", "w_in", "v_c", vocab_size, dim), "center") \
        .join(_side(weights, "target", "w_out", "v_t", vocab_size, dim), "target")
    return _score(t, "v_c", "v_t", dim).drop("v_c", "v_t")


def pair_loss(pairs: DataFrame) -> DataFrame:
    """(loss): the batch's summed loss from counted pairs."""
    return pairs.agg(F.coalesce(F.sum(F.col("n") * F.col("loss")), F.lit(0.0)).alias("loss"))


def example_loss(scored: DataFrame) -> DataFrame:
    """(doc_id, line_no, p, loss, n_targets): loss summed over a centre."""
    return scored.groupBy(*EX_KEY).agg(F.sum("loss").alias("loss"),
                                       F.count(F.lit(1)).alias("n_targets"))


def epoch_loss(total: DataFrame, examples: DataFrame | None = None) -> DataFrame:
    """(loss_sum, centers, avg_loss); avg is 0 when there are no centres.  ``total``
    holds the centres too if no examples are given (:func:`totals`)."""
    if examples is None:
        a = total.select(F.col("loss").alias("loss_sum"), "centers")
    else:
        parts = total.select(F.col("loss"), F.lit(0).cast("long").alias("n")).union(
            examples.agg(F.lit(0.0), F.count(F.lit(1))))
        a = parts.agg(F.sum("loss").alias("loss_sum"), F.sum("n").alias("centers"))
    return a.select("loss_sum", "centers",
                    F.when(F.col("centers") == 0, F.lit(0.0))
                    .otherwise(F.col("loss_sum") / F.col("centers")).alias("avg_loss"))


def _grad_sum(df: DataFrame, key: str, coef: F.Column, vec: str, dim: int, matrix: str,
              updates: F.Column) -> DataFrame:
    agg = df.groupBy(F.col(key).alias("idx")).agg(
        *[F.sum(coef * F.col(vec)[j].cast("double")).alias(f"_g{j}") for j in range(dim)],
        F.sum(updates).alias("n"))
    return agg.select(F.lit(matrix).alias("matrix"), "idx", VX.assemble("_g", dim).alias("grad"), "n")


def sgns_pair_gradients(pairs: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    """(matrix, idx, grad, n): d loss / d w_in[center] = sum g * w_out[target],
    d loss / d w_out[target] = sum g * w_in[center]; n counts the updates."""
    coef = F.col("n") * F.col("g")
    g_in = _grad_sum(pairs.join(_side(weights, "target", "w_out", "v_t", vocab_size, dim), "target"),
                     "center", coef, "v_t", dim, "in", F.when(F.col("label") == 1, F.col("n")).otherwise(0))
    g_out = _grad_sum(pairs.join(_side(weights, "center", "w_in", "v_c", vocab_size, dim), "center"),
                      "target", coef, "v_c", dim, "out", F.col("n"))
    return g_in.unionByName(g_out)


def sgns_example_loss(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    """``example_loss`` of a batch."""
    held = broadcast_weights(weights, vocab_size, dim)
    return example_loss(sgns_scored(table_of(examples), weights, vocab_size, dim)) if held is None \
        else _losses(examples, held, "skipgram")


def sgns_gradients(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    got = step_sums(examples, weights, vocab_size, dim, "skipgram")
    if got is not None:
        return got.where("matrix <> 'stat'")
    pairs = write_table(sgns_pairs(table_of(examples), weights, vocab_size, dim), "pairs")
    return sgns_pair_gradients(pairs, weights, vocab_size, dim)


def apply_gradients(weights: DataFrame, grads: DataFrame, lr: float) -> DataFrame:
    """w - lr * grad for both matrices; rows without gradient are unchanged."""
    gi = grads.where(F.col("matrix") == "in").select("idx", F.col("grad").alias("_gi"))
    go = grads.where(F.col("matrix") == "out").select("idx", F.col("grad").alias("_go"))
    j = weights.join(gi, "idx", "left").join(go, "idx", "left")
    step = F.lit(-float(lr))

    def upd(w, g):
        return F.when(F.col(g).isNull(), F.col(w)).otherwise(
            VX.to_float_array(VX.axpy(step, F.col(g), F.col(w))))
    return j.select("idx", upd("w_in", "_gi").alias("w_in"), upd("w_out", "_go").alias("w_out"))


def sgns_step(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int, lr: float) -> DataFrame:
    # Both matrices take their rows from the gradients: written, they are summed once.
    return apply_gradients(weights, write_table(sgns_gradients(examples, weights, vocab_size, dim), "grads"), lr)


# ------------------------------------------------------------------ CBOW

def cbow_context_mean(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    """(doc_id, line_no, p, h ARRAY<DOUBLE>, n_ctx): mean of w_in over the
    context, a repeated word counted each time it occurs."""
    held = broadcast_weights(weights, vocab_size, dim)
    if held is not None:
        return _through(examples, K.means(held), f"{_key_fields(examples)}, h array<double>, n_ctx bigint",
                        *EX_KEY, "context")
    examples = table_of(examples)
    win = _maybe_broadcast(weights.select(F.col("idx").alias("ctx"), F.col("w_in").alias("v")),
                           vocab_size, dim)
    pc = examples.select(*EX_KEY, F.explode("context").alias("ctx")).join(win, "ctx")
    agg = pc.groupBy(*EX_KEY).agg(
        F.count(F.lit(1)).alias("n_ctx"),
        *[F.avg(F.col("v")[j].cast("double")).alias(f"_h{j}") for j in range(dim)])
    return agg.select(*EX_KEY, VX.assemble("_h", dim).alias("h"), "n_ctx")


def cbow_scored(examples: DataFrame, means: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    """Targets of CBOW (centre label 1, negatives != centre label 0), scored
    against the context means ``h``."""
    t = _with_targets(examples.select(*EX_KEY, "center", "negatives"), "center") \
        .select(*EX_KEY, "center", "target", "label")
    t = t.join(means.select(*EX_KEY, "h"), EX_KEY).join(
        _side(weights, "target", "w_out", "v_t", vocab_size, dim), "target")
    return _score(t, "h", "v_t", dim).drop("h", "v_t")


def cbow_gradients(examples: DataFrame, means: DataFrame, scored: DataFrame, weights: DataFrame,
                   vocab_size: int, dim: int) -> DataFrame:
    """(matrix, idx, grad, n): w_out[target] gets g * h; every context occurrence
    gets (sum_t g * w_out[t]) / n_ctx on its w_in row."""
    one = F.lit(1)
    slim = scored.select(*EX_KEY, "target", "g")
    g_out = _grad_sum(slim.join(means.select(*EX_KEY, "h"), EX_KEY), "target", F.col("g"), "h", dim, "out", one)
    gh = slim.join(_side(weights, "target", "w_out", "v_t", vocab_size, dim), "target").groupBy(*EX_KEY).agg(
        *[F.sum(F.col("g") * F.col("v_t")[j].cast("double")).alias(f"_s{j}") for j in range(dim)])
    gh = gh.select(*EX_KEY, VX.assemble("_s", dim).alias("gh"))
    # The join moves a centre once; its context uses exist only between it and the sum.
    per_ctx = examples.select(*EX_KEY, "context").join(gh, EX_KEY) \
        .select(F.size("context").alias("n_ctx"), "gh", F.explode("context").alias("ctx"))
    g_in = _grad_sum(per_ctx, "ctx", F.lit(1.0) / F.col("n_ctx").cast("double"), "gh", dim, "in", one)
    return g_in.unionByName(g_out)


def cbow_parts(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> tuple[DataFrame, DataFrame]:
    """Context means and scored targets of a batch, each written once."""
    means = write_table(cbow_context_mean(examples, weights, vocab_size, dim), "context-means")
    return means, write_table(cbow_scored(examples, means, weights, vocab_size, dim), "scored")


def cbow_example_loss(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    """``example_loss`` of a CBOW batch."""
    held = broadcast_weights(weights, vocab_size, dim)
    if held is not None:
        return _losses(examples, held, "cbow")
    examples = table_of(examples)
    means = cbow_context_mean(examples, weights, vocab_size, dim)
    return example_loss(cbow_scored(examples, means, weights, vocab_size, dim))


def cbow_batch_gradients(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int) -> DataFrame:
    got = step_sums(examples, weights, vocab_size, dim, "cbow")
    if got is not None:
        return got.where("matrix <> 'stat'")
    examples = table_of(examples)
    means, scored = cbow_parts(examples, weights, vocab_size, dim)
    return cbow_gradients(examples, means, scored, weights, vocab_size, dim)


def cbow_step(examples: DataFrame, weights: DataFrame, vocab_size: int, dim: int, lr: float) -> DataFrame:
    return apply_gradients(weights, write_table(cbow_batch_gradients(examples, weights, vocab_size, dim), "grads"), lr)
