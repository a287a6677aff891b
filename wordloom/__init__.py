"""wordloom: word embeddings (skip-gram / CBOW with negative sampling) as
Spark DataFrame jobs: corpus -> vocabulary -> training examples -> model
rounds -> vector queries."""

from .config import EmbeddingConfig  # noqa: F401

__version__ = "0.1.0"
