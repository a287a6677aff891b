"""Vocabulary: counts, min_count, frequency-ranked dense ids, lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.training import keep_probability
from .rank import dense_index


class EmptyVocabularyError(ValueError):
    pass


class CorpusTooSmallError(ValueError):
    pass


def word_counts(tokens: DataFrame) -> DataFrame:
    """tokens -> (word, cnt).  Partial aggregation runs map-side, so a word
    holding a third of all tokens is pre-summed before the shuffle."""
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def apply_min_count(counts: DataFrame, min_count: int) -> DataFrame:
    return counts.where(F.col("cnt") >= F.lit(int(min_count)))


def build_vocab(tokens: DataFrame, min_count: int = 1) -> DataFrame:
    """tokens -> vocab(idx, word, cnt): idx orders by count desc, then word
    by byte order; idx 0 is the most frequent word."""
    counts = apply_min_count(word_counts(tokens), min_count)
    return dense_index(counts, [F.desc("cnt"), F.asc("word")]).select("idx", "word", "cnt")


@dataclass(frozen=True)
class VocabStats:
    vocab_size: int
    total_tokens: int


def vocab_stats_df(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count(F.lit(1)).cast("bigint").alias("vocab_size"),
                     F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("total_tokens"))


def collect_stats(vocab: DataFrame) -> VocabStats:
    """Two scalars to the driver (never the table)."""
    row = vocab_stats_df(vocab).first()
    return VocabStats(int(row["vocab_size"]), int(row["total_tokens"]))


def check_trainable(stats: VocabStats) -> None:
    if stats.vocab_size == 0:
        raise EmptyVocabularyError("no word occurs often enough to be kept")
    if stats.vocab_size < 2:
        raise CorpusTooSmallError(
            f"{stats.vocab_size} different word is left; training takes two or more")


def word_count_lookup(words: DataFrame, vocab: DataFrame, word_col: str = "word") -> DataFrame:
    """Count of each asked word, 0 when it is not in the vocabulary."""
    v = vocab.select(F.col("word").alias("_w"), "cnt")
    return (words.join(v, words[word_col] == v["_w"], "left")
            .select(words[word_col].alias("word"), F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt")))


def words_sorted(vocab: DataFrame) -> DataFrame:
    """All words in byte order (a distributed sort)."""
    return vocab.select("word").orderBy("word")


def top_frequent(vocab: DataFrame, n: int) -> DataFrame:
    """The n most frequent words: a filter on the dense id, not a sort."""
    return vocab.where(F.col("idx") < F.lit(int(n)))


def with_keep_probability(vocab: DataFrame, total_tokens: int, threshold: float) -> DataFrame:
    return vocab.withColumn("keep", keep_probability(F.col("cnt"), F.lit(int(total_tokens)), threshold))
