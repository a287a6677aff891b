"""Corpus sources: one sentence per line.

A sentence is one line of a text column (lines end in ``\\n`` or ``\\r\\n``;
a final empty piece after a trailing newline is not a line).  The corpus
schema is ``(doc_id BIGINT, line_no INT, line STRING)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rank import dense_index

LINE_BREAK = r"\r?\n"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_lines(text_col) -> F.Column:
    """Lines of a text column, without the empty piece after a final newline."""
    return without_last_empty(F.split(text_col, LINE_BREAK, -1))


def without_last_empty(parts: F.Column) -> F.Column:
    return (F.when((F.size(parts) > 0) & (F.element_at(parts, -1) == F.lit("")),
                   F.slice(parts, 1, F.size(parts) - 1))
            .otherwise(parts))


def balance_lines(lines: DataFrame) -> DataFrame:
    """Spread an under-partitioned corpus over the cluster.

    A scan gives one task per file split / row group.  When that is fewer
    tasks than the cluster runs at once (a small or unsplittable input), the
    lines are hash-partitioned by their sentence key, which the later
    per-sentence regroup then reuses without another shuffle.  Large inputs
    already have enough splits and are left alone.
    """
    spark = lines.sparkSession
    parallelism = spark.sparkContext.defaultParallelism
    have = lines.rdd.getNumPartitions()
    if have >= parallelism:
        return lines
    want = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parallelism)
    return lines.repartition(want, "doc_id", "line_no")


def lines_from_text(df: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, text) rows -> corpus(doc_id, line_no, line); row-local, plus a
    rebalance only when the input is under-partitioned."""
    # The pieces are a column of their own: a generator would split the text at each use.
    parts = df.select(F.col(key_col).cast("bigint").alias("doc_id"), F.split(text_col, LINE_BREAK, -1).alias("_parts"))
    lines = parts.select(
        "doc_id", F.posexplode(without_last_empty(F.col("_parts"))).alias("line_no", "line"),
    ).select("doc_id", F.col("line_no").cast("int").alias("line_no"), "line")
    return balance_lines(lines)


def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `documents` table as a corpus (only doc_id and text are read)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines_from_text(docs)


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `conversations` table as a corpus: each turn's text, line by line.

    doc_id packs (conv_id, turn) as conv_id * 2^20 + turn, so sentences of
    different turns never share a window; a turn that doesn't fit is an error.
    """
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    fits = F.col("turn").between(0, (1 << 20) - 1)
    turn = F.when(fits, F.col("turn")).otherwise(F.raise_error(F.concat(
        F.lit("turn outside 0..2^20-1: "), F.coalesce(F.col("turn").cast("string"), F.lit("null")))).cast("long"))
    keyed = conv.select((F.col("conv_id") * F.lit(1 << 20) + turn).alias("doc_id"), "text")
    return lines_from_text(keyed)


def text_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain text files, one sentence per line (the CLI's --input).

    Only ``\\n`` and ``\\r\\n`` end a line.  Files are read in parallel splits;
    a line's doc_id is its place in the order (file, line), found by a
    distributed rank, so it does not depend on how the files were split.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.regexp_replace("value", r"\r\z", "").alias("line"))
    ranked = dense_index(raw, ["_file", "_block", "_at"], "doc_id")
    return ranked.select("doc_id", F.lit(0).cast("int").alias("line_no"), "line")
