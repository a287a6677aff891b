"""The vocabulary counter over a streaming corpus.

The reference is batch-only; this applies the same tokenizer and word count
(G1) to a Structured Streaming source of text lines, so a vocabulary can be
kept current while a corpus grows.  State is one row per distinct word
(count), kept by Spark's state store; the sink decides how results are used
(``update`` mode with a keyed table, so that only changed words move).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tokenize import token_array
from ..sources.corpus import split_lines


def streaming_word_counts(text_stream: DataFrame, text_col: str = "value") -> DataFrame:
    """(word, cnt) over a streaming DataFrame of texts (one row per text)."""
    lines = text_stream.select(F.explode(split_lines(F.col(text_col))).alias("line"))
    words = lines.select(F.explode(token_array("line")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))

