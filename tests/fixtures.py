"""Test corpora (FIXTURES.md).  Fixed values: the sentences below must equal
the reference's test and example corpora."""

from __future__ import annotations

# The eight integration-test templates, cycled to n.
TEMPLATES = [
    "the quick brown fox jumps over the lazy dog",
    "paris is the capital of france",
    "berlin is the capital of germany",
    "tokyo is the capital of japan",
    "king and queen are royalty",
    "man and woman are people",
    "cat and dog are animals",
    "deep learning neural networks artificial intelligence machine learning",
]

# The published example corpus (20 sentences, cycled to 200).
DEMO = [
    "paris is the capital of france and a major european city",
    "berlin is the capital of germany in central europe",
    "tokyo is the capital of japan and the largest city in asia",
    "london is the capital of england and the united kingdom",
    "madrid is the capital of spain in southern europe",
    "rome is the capital of italy and a historic city",
    "the king rules over the kingdom with great power",
    "the queen stands beside the king in royal ceremonies",
    "man and woman are both important members of society",
    "a dog is a loyal pet that loves to play outside",
    "a cat is an independent pet that enjoys sleeping",
    "machine learning algorithms learn from large datasets",
    "deep learning is a branch of machine learning using neural networks",
    "natural language processing enables text understanding by computers",
    "word embeddings are dense vector representations of words",
    "the quick brown fox jumps over the lazy dog near the river",
    "artificial intelligence is transforming how we interact with computers",
    "data science combines statistics programming and domain knowledge",
    "the sun rises every morning in the east bringing warm light",
    "rivers flow from mountains to the sea through valleys",
]

# The trainer smoke corpus.
TINY = [
    "the quick brown fox",
    "the lazy dog sleeps",
    "fox and dog are animals",
    "quick animals run fast",
]


def cycled(sentences, n):
    return [sentences[i % len(sentences)] for i in range(n)]


def corpus_df(spark, sentences):
    """(doc_id, line_no, line): one document per sentence, as the reference's
    in-memory corpus (one string per sentence)."""
    rows = [(i, 0, s) for i, s in enumerate(sentences)]
    return spark.createDataFrame(rows, "doc_id bigint, line_no int, line string")
