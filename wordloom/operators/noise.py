"""Unigram^0.75 noise distribution and the lookup of uniform draws.

The distribution is a table of half-open ranges ``[lo, hi)`` over [0, 1)
in id order.  A draw ``u`` picks the word whose range holds it.  The lookup is
an equi-join on a bucket ``floor(u * B)`` plus a range filter: each word is
listed in every bucket its range touches (B + V rows), and draws are uniform
over buckets, so the join side of draws is never skewed and each draw meets
on average 1 + V/B candidate rows.

Training draws are looked up where they are made (:class:`NoiseRuns`): ids are
frequency ranks, so words of one count are one run of ids, and the runs (at most
sqrt(2 * tokens) of them) are enough to rebuild every range inside a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.training import NOISE_POWER, NOISE_TABLE_SIZE
from ..session import DEFAULT_BROADCAST_BYTES, fits_broadcast
from .rank import DEFAULT_BLOCK, prefix_sum

MIN_BUCKETS = 1 << 10
_BUCKET_ROW_BYTES = 40


def bucket_count(vocab_size: int) -> int:
    b = MIN_BUCKETS
    while b < vocab_size:
        b <<= 1
    return b


def noise_distribution(vocab: DataFrame) -> DataFrame:
    """vocab -> (idx, p, lo, hi), p = cnt^0.75 / sum, [lo, hi) contiguous."""
    powered = vocab.select("idx", F.pow(F.col("cnt").cast("double"), F.lit(NOISE_POWER)).alias("w"))
    cum = prefix_sum(powered, "idx", "w", "cum_incl", "cum_excl")
    total = cum.agg(F.max("cum_incl").alias("t")).first()["t"]
    if total is None:
        return cum.sparkSession.createDataFrame([], "idx bigint, p double, lo double, hi double")
    t = F.lit(float(total))
    return cum.select("idx", (F.col("w") / t).alias("p"),
                      (F.col("cum_excl") / t).alias("lo"),
                      (F.col("cum_incl") / t).alias("hi"))


def noise_buckets(dist: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, idx, lo, hi): every bucket a word's range touches."""
    b = F.lit(n_buckets)
    first = F.floor(F.col("lo") * b).cast("bigint")
    last = F.greatest(first, F.least(F.ceil(F.col("hi") * b).cast("bigint") - 1, F.lit(n_buckets - 1)))
    return dist.select(F.explode(F.sequence(first, last)).alias("bucket"), "idx", "lo", "hi")


@dataclass(frozen=True)
class NoiseRuns:
    """Runs of ids with one weight (cnt^0.75), in id order."""
    weight: np.ndarray
    n: np.ndarray

    def upper(self) -> np.ndarray:
        """``hi`` of every id, bit for bit that of :func:`noise_distribution`: running
        sums inside blocks of ids, plus the running sum of the blocks' totals."""
        w = np.repeat(self.weight, self.n)
        before = 0.0
        for a in range(0, len(w), DEFAULT_BLOCK):
            part = before + np.cumsum(w[a:a + DEFAULT_BLOCK])
            w[a:a + DEFAULT_BLOCK] = part
            before = part[-1]
        return w / before if len(w) else w


def draw_table(vocab: DataFrame, n_buckets: int, vocab_size: int) -> NoiseRuns | DataFrame:
    """What draws are looked up in: the runs of a vocabulary in rank order, or the
    bucket table if a task cannot hold 8 bytes a word (or ids are no ranks)."""
    if 8 * vocab_size <= DEFAULT_BROADCAST_BYTES:
        rows = vocab.groupBy("cnt").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("n")) \
            .select("first", "n", F.pow(F.col("cnt").cast("double"), F.lit(NOISE_POWER)).alias("w")) \
            .orderBy("first").collect()
        first, n = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("first", "n"))
        if np.array_equal(first, np.cumsum(n) - n):
            return NoiseRuns(np.array([r["w"] for r in rows], dtype=np.float64), n)
    return noise_buckets(noise_distribution(vocab), n_buckets)


def in_place(n_buckets: int, vocab_size: int) -> bool:
    """Whether the bucket table (B + V rows, known) is under the broadcast gate."""
    return fits_broadcast(n_buckets + vocab_size, _BUCKET_ROW_BYTES)


def lookup_draws(draws: DataFrame, buckets: DataFrame, n_buckets: int, vocab_size: int,
                 u_col: str = "u", out_col: str = "neg", shifted: bool = False) -> DataFrame:
    """Map uniform draws to word ids through the bucketed ranges.

    The bucket table is broadcast only when its row count (B + V, known) is
    under the size gate; otherwise both sides shuffle on the bucket.
    """
    side = buckets.select(F.col("bucket").alias("_b"), F.col("idx").alias("_nidx"),
                          F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    if in_place(n_buckets, vocab_size):
        side = F.broadcast(side)
    keyed = draws.withColumn("_b", F.floor(F.col(u_col) * F.lit(n_buckets)).cast("bigint"))
    hit = keyed.join(side, "_b").where((F.col(u_col) >= F.col("_lo")) & (F.col(u_col) < F.col("_hi")))
    word = F.col("_nidx")
    if shifted:
        # The reference's table loop moves each word's mass to the next id:
        # id 0 is never drawn and the last id gets the last two words' mass.
        word = F.least(word + F.lit(1), F.lit(vocab_size - 1))
    return hit.withColumn(out_col, word.cast("bigint")).drop("_b", "_nidx", "_lo", "_hi")


def noise_table(dist: DataFrame, n_buckets: int, vocab_size: int,
                table_size: int = NOISE_TABLE_SIZE, shifted: bool = False) -> DataFrame:
    """The reference's slot table: slot i holds the first word whose
    cumulative share reaches (i+1)/T (shifted: one id further, capped)."""
    spark = dist.sparkSession
    slots = spark.range(table_size).select(F.col("id").alias("slot"))
    theta = (F.col("slot") + F.lit(1)).cast("double") / F.lit(float(table_size))
    side = noise_buckets(dist, n_buckets).select(
        F.col("bucket").alias("_b"), F.col("idx").alias("_nidx"),
        F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    if in_place(n_buckets, vocab_size):
        side = F.broadcast(side)
    keyed = slots.withColumn("_t", theta).withColumn(
        "_b", (F.ceil(F.col("_t") * F.lit(n_buckets)) - 1).cast("bigint"))
    hit = keyed.join(side, "_b").where((F.col("_t") > F.col("_lo")) & (F.col("_t") <= F.col("_hi")))
    word = F.col("_nidx")
    if shifted:
        word = F.least(word + F.lit(1), F.lit(vocab_size - 1))
    return hit.select(F.col("slot").cast("bigint").alias("slot"), word.cast("bigint").alias("idx"))


def noise_shifted(dist: DataFrame, vocab_size: int) -> DataFrame:
    """(idx, p) of the reference's shifted table law: word j >= 1 gets the
    mass of word j - 1, word 0 gets none, the last word also keeps its own."""
    prev = dist.select((F.col("idx") + 1).alias("idx"), F.col("p").alias("_p"))
    own_last = dist.where(F.col("idx") == vocab_size - 1).select("idx", F.col("p").alias("_p"))
    parts = prev.where(F.col("idx") < vocab_size).unionByName(own_last)
    got = parts.groupBy("idx").agg(F.sum("_p").alias("p"))
    zero = dist.where(F.col("idx") == 0).select("idx", F.lit(0.0).alias("p"))
    return got.unionByName(zero)
