"""Job entry points (the reference's two command-line programs, as functions).

``train_job``: corpus -> model folder + history + text vectors + chart data +
a neighbour preview.  ``query_job``: model folder + query tables -> pair
similarities, neighbours and analogies, written as tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import EmbeddingConfig
from ..operators import pca as PC
from ..operators import serving as S
from ..sources import corpus as C
from ..sources import model_store as MS
from .trainer import train

PREVIEW_WORDS = 5
PREVIEW_K = 5
PCA_WORDS = 50
NEAR_K = 10
ANALOGY_K = 5


def corpus_from(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A corpus from a DataFrame (doc_id, line_no, line), a Parquet table of
    (doc_id, text), or plain text files (one sentence per line)."""
    if isinstance(source, DataFrame):
        return source
    if source.endswith(".parquet"):
        return C.lines_from_text(spark.read.parquet(source).select("doc_id", "text"))
    return C.text_file_lines(spark, source)


def train_job(spark: SparkSession, source, out_dir: str, **cfg) -> dict:
    config = EmbeddingConfig(**cfg)
    model = train(spark, corpus_from(spark, source), config)
    MS.save_model(model, f"{out_dir}/model")
    MS.save_history_json(model.history, f"{out_dir}/training_history")
    emb = model.embeddings()
    MS.save_text_vectors(emb, config.embedding_dim, f"{out_dir}/vectors_txt")
    PC.loss_curve_points(model.history).write.mode("overwrite").parquet(f"{out_dir}/loss_curve")
    if model.vocab_size >= 2:
        coords = PC.pca_2d(emb, PCA_WORDS)
        coords.write.mode("overwrite").parquet(f"{out_dir}/pca")
        PC.pca_ranges(coords).write.mode("overwrite").parquet(f"{out_dir}/pca_ranges")
    first = emb.select("word").orderBy("word").limit(PREVIEW_WORDS)
    preview = S.most_similar(first, emb, PREVIEW_K)
    preview.write.mode("overwrite").parquet(f"{out_dir}/neighbor_sample")
    return {"vocab_size": model.vocab_size, "total_tokens": model.total_tokens,
            "history": [r.asDict() for r in model.history.orderBy("epoch").collect()]}


def query_job(spark: SparkSession, model_dir: str, out_dir: str, pairs: DataFrame | None = None,
              near: DataFrame | None = None, analogies: DataFrame | None = None,
              near_k: int = NEAR_K, analogy_k: int = ANALOGY_K) -> None:
    """pairs(word_a, word_b) / near(word) / analogies(pos_a, neg_a, pos_b)."""
    emb = MS.load_model(spark, model_dir).embeddings()
    if pairs is not None:
        S.pair_similarity(pairs, emb).write.mode("overwrite").parquet(f"{out_dir}/similarity")
    if near is not None:
        S.most_similar(near, emb, near_k).write.mode("overwrite").parquet(f"{out_dir}/near")
    if analogies is not None:
        S.analogy(analogies, emb, analogy_k).write.mode("overwrite").parquet(f"{out_dir}/analogy")

