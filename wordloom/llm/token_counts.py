"""Exact token counts: a length histogram and its suffix sums.

Documents are encoded whole (Arrow batches), and only their lengths leave the
worker.  ``groupBy(length).count()`` combines map-side, so the shuffle holds at
most one row per task and distinct length, however many documents share it.
Suffix sums over the histogram then answer, without touching a document again:

* totals: documents and tokens;
* quantiles of the length, exact (the value of rank ``ceil(q * n)``);
* truncated totals: tokens kept if every document is cut at a context limit,
  ``sum(len | len <= limit) + limit * count(len > limit)``.

Null and empty texts have length 0 (plus ``extra`` ids per document).
An empty table gives an empty histogram.  Repeated rows each count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, store, table
from .tokenizer import DEFAULT_VOCAB, encoder

BLOCK = 1 << 12          # histogram lengths per prefix-sum block


def encoded_lengths(docs: DataFrame, text_col: str = "text", vocab: str = DEFAULT_VOCAB,
                    extra: int = 0) -> DataFrame:
    """One row ``(n_tokens long)`` per document."""
    def run(batches):
        enc = encoder(vocab)
        for b in bounded(batches, 0):
            n = [len(x) // enc.width + extra for x in enc.encode(b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n_tokens"])
    return docs.select(F.col(text_col)).mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``(n_tokens, n_docs)``: one row per distinct length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per length L as a context limit: ``docs_le``, ``docs_ge``, ``tokens_le``,
    ``tokens_ge``, ``truncated_total`` (tokens left after cutting at L),
    ``total_docs``, ``total_tokens``.

    Running sums stay inside blocks of the length; block offsets come from one
    row per block, so no task sorts the whole histogram.
    """
    h = hist.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("_tok"),
                    F.floor(F.col("n_tokens") / F.lit(BLOCK)).alias("_blk"))
    blocks = h.groupBy("_blk").agg(F.sum("n_docs").alias("_d"), F.sum("_tok").alias("_t"))
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per 4096 lengths: a few hundred for million-token documents.
    offs = blocks.select(
        "_blk",
        F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_d0"),
        F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_t0"),
        F.sum("_d").over(whole).alias("total_docs"), F.sum("_t").over(whole).alias("total_tokens"))
    w = Window.partitionBy("_blk").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    run = h.join(offs, "_blk").select(
        "n_tokens", "n_docs", "total_docs", "total_tokens",
        (F.col("_d0") + F.sum("n_docs").over(w)).alias("docs_le"),
        (F.col("_t0") + F.sum("_tok").over(w)).alias("tokens_le"))
    return run.select(
        "n_tokens", "n_docs", "docs_le",
        (F.col("total_docs") - F.col("docs_le") + F.col("n_docs")).alias("docs_ge"),
        "tokens_le",
        (F.col("total_tokens") - F.col("tokens_le") + F.col("n_tokens") * F.col("n_docs")).alias("tokens_ge"),
        (F.col("tokens_le") + F.col("n_tokens") * (F.col("total_docs") - F.col("docs_le"))).alias("truncated_total"),
        "total_docs", "total_tokens")


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``(context_limit, kept_tokens, cut_docs)`` for any limits (a short literal
    list), not only lengths that occur."""
    rows = hist.select("n_tokens", "n_docs", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
                       .alias("context_limit"))
    cut = F.col("n_tokens") > F.col("context_limit")
    return rows.groupBy("context_limit").agg(
        F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("kept_tokens"),
        F.sum(F.when(cut, F.col("n_docs")).otherwise(0)).alias("cut_docs"))


def quantiles(spark: SparkSession, sums: DataFrame, qs: list[float]) -> DataFrame:
    """``(q, n_tokens)``: the length of rank ``max(1, ceil(q * n))``.  ``qs`` is a
    short literal list."""
    out = sums.agg(*[
        F.min(F.when(F.col("docs_le") >= F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * F.col("total_docs"))),
                     F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(qs)])
    return out.select(F.explode(F.array(*[
        F.struct(F.lit(float(q)).alias("q"), F.col(f"q{i}").alias("n_tokens"))
        for i, q in enumerate(qs)])).alias("r")).select("r.q", "r.n_tokens")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix sums for every context limit that changes an answer."""
    docs = table(spark, sf_dir, "documents")
    hist = store(length_histogram(encoded_lengths(docs)), "length-histogram")
    return suffix_sums(hist)


def brute_force(lengths: np.ndarray) -> list[tuple]:
    """The rows of :func:`suffix_sums` by direct counting (tests)."""
    rows = []
    for v in sorted(set(lengths.tolist())):
        le = lengths <= v
        rows.append((v, int((lengths == v).sum()), int(le.sum()), int((lengths >= v).sum()),
                     int(lengths[le].sum()), int(lengths[lengths >= v].sum()),
                     int(np.minimum(lengths, v).sum()), len(lengths), int(lengths.sum())))
    return rows
