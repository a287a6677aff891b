"""Vector tables from the driver's data: the `embeddings` table, with
``vec_id`` playing the word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .corpus import read_table


def embedding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx BIGINT, word STRING, vec ARRAY<FLOAT>) from `embeddings`."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("bigint").alias("idx"),
                    F.col("vec_id").cast("string").alias("word"),
                    F.col("embedding").alias("vec"))
