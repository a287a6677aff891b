"""Queries over an embeddings table ``(idx BIGINT, word STRING, vec ARRAY<FLOAT>)``.

Lookups and pair similarity are joins plus JVM vector expressions.  Nearest
neighbours and analogies are an exact top-k by cosine over the whole
vocabulary: blocks of candidates in cells of like direction, of which a query
visits those that can hold one of its k best (:mod:`.nearest`).  A small query
set (counted) goes to every task instead, and the candidates are scanned in
place without a shuffle.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as VX
from .nearest import nearest
from .topk import RESULT, best_of_block

# Rows of a block of queries, and of a cell's block of candidates.
QUERY_BLOCK_ROWS = 4096
CAND_BLOCK_ROWS = 4096
SMALL_QUERIES = 256           # query rows sent to every task


class UnknownWordError(KeyError):
    pass


def embedding_stats(emb: DataFrame) -> DataFrame:
    """(vocab_size, embedding_dim)."""
    return emb.agg(F.count(F.lit(1)).cast("bigint").alias("vocab_size"),
                   F.max(F.size("vec")).cast("int").alias("embedding_dim"))


def get_vectors(words: DataFrame, emb: DataFrame, word_col: str = "word") -> DataFrame:
    """Left join: (word, found, vec) with vec NULL for unknown words."""
    e = emb.select(F.col("word").alias("_w"), "vec")
    j = words.join(e, words[word_col] == e["_w"], "left")
    return j.select(words[word_col].alias("word"), F.col("vec").isNotNull().alias("found"), "vec")


def vector_norms(emb: DataFrame) -> DataFrame:
    return emb.select("idx", "word", VX.norm("vec").alias("norm"))


def normalize_vectors(emb: DataFrame) -> DataFrame:
    return emb.select("idx", "word", VX.normalize("vec").alias("vec"))


def pair_similarity(pairs: DataFrame, emb: DataFrame, strict: bool = False,
                    a_col: str = "word_a", b_col: str = "word_b") -> DataFrame:
    """(word_a, word_b, similarity, is_oov).  Unknown words give NULL and
    is_oov = true; ``strict`` raises like the reference instead."""
    ea = emb.select(F.col("word").alias("_wa"), F.col("vec").alias("_va"))
    eb = emb.select(F.col("word").alias("_wb"), F.col("vec").alias("_vb"))
    j = pairs.join(ea, pairs[a_col] == ea["_wa"], "left").join(eb, pairs[b_col] == eb["_wb"], "left")
    oov = F.col("_va").isNull() | F.col("_vb").isNull()
    out = j.select(pairs[a_col].alias("word_a"), pairs[b_col].alias("word_b"),
                   F.when(oov, F.lit(None).cast("double")).otherwise(VX.cosine("_va", "_vb")).alias("similarity"),
                   oov.alias("is_oov"))
    if strict:
        missing = out.where("is_oov").select("word_a", "word_b").limit(1).collect()
        if missing:
            raise UnknownWordError(f"Unknown word in pair {tuple(missing[0])}")
    return out


def top_k_cosine(queries: DataFrame, emb: DataFrame, k: int, n_queries: int | None = None,
                 n_cands: int | None = None) -> DataFrame:
    """Exact top-k by cosine for every query row.

    queries: (qid BIGINT, qname STRING, qvec ARRAY<FLOAT|DOUBLE>, excl ARRAY<BIGINT>)
    returns: (qid, qname, idx, word, similarity, rank), rank 1..k, ties by idx.
    ``qname`` is a label carried through (no join back to the queries).
    """
    n_queries = n_queries if n_queries is not None else queries.count()
    w = Window.partitionBy("qid", "qname").orderBy(F.desc("similarity"), F.asc("idx"))
    q = queries.select("qid", "qname", F.col("qvec").cast("array<double>").alias("qvec"), "excl")
    if n_queries <= SMALL_QUERIES:
        rows = q.collect()                       # at most SMALL_QUERIES rows
        part = emb.select("idx", "word", "vec").mapInPandas(_scan_kernel(rows, k), RESULT)
        return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    n_cands = n_cands if n_cands is not None else emb.count()
    part = nearest(q, emb, k, n_cands, QUERY_BLOCK_ROWS, CAND_BLOCK_ROWS)
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _scan_kernel(rows, k: int):
    """Best k of every query among a task's candidates, batch by batch."""
    best_of = best_of_block(k)

    def run(batches):
        if not rows:
            return
        q = pd.DataFrame([r.asDict() for r in rows])
        best = None
        for c in batches:
            got = best_of(None, q, c)
            best = got if best is None else pd.concat([best, got], ignore_index=True)
            best = best.sort_values(["similarity", "idx"], ascending=[False, True], kind="stable") \
                .groupby(["qid", "qname"], sort=False).head(k)
        if best is not None:
            yield best
    return run


def most_similar(query_words: DataFrame, emb: DataFrame, k: int, word_col: str = "word") -> DataFrame:
    """(query, word, similarity, rank): k nearest words of every query word,
    the query itself excluded.  Unknown query words give no rows."""
    qs = (query_words.select(F.col(word_col).alias("query")).distinct()
          .join(emb.select(F.col("word").alias("query"), "idx", "vec"), "query"))
    qs = qs.select(F.col("idx").alias("qid"), F.col("query").alias("qname"), F.col("vec").alias("qvec"),
                   F.array(F.col("idx")).alias("excl"))
    res = top_k_cosine(qs, emb, k)
    return res.select(F.col("qname").alias("query"), "word", "similarity", F.col("rank").cast("int"))


TERMS = ["pos_a", "neg_a", "pos_b"]


def analogy_queries(triples: DataFrame, emb: DataFrame, strict: bool = False) -> DataFrame:
    """(pos_a, neg_a, pos_b) -> (qid, pos_a, neg_a, pos_b, qvec, excl, is_oov) with
    qvec = normalise(a - b + c), null if a word is unknown (``strict``: an error)."""
    j = triples.select(*TERMS).dropDuplicates(TERMS)
    for name in TERMS:
        j = j.join(emb.select(F.col("word").alias(name), F.col("idx").alias(f"_{name}_i"),
                              F.col("vec").alias(f"_{name}_v")), name, "left")
    oov = F.col("_pos_a_i").isNull() | F.col("_neg_a_i").isNull() | F.col("_pos_b_i").isNull()
    if strict:
        bad = j.where(oov).limit(1).collect()
        if bad:
            raise UnknownWordError(f"Unknown word in analogy {tuple(bad[0][t] for t in TERMS)}")
    qv = VX.normalize(VX.add(VX.sub("_pos_a_v", "_neg_a_v"), "_pos_b_v"))
    return j.select(
        F.xxhash64(*TERMS).alias("qid"), *TERMS, F.when(~oov, qv).alias("qvec"),
        F.array("_pos_a_i", "_neg_a_i", "_pos_b_i").alias("excl"), oov.alias("is_oov"))


def analogy(triples: DataFrame, emb: DataFrame, k: int, strict: bool = False) -> DataFrame:
    """(pos_a, neg_a, pos_b, word, similarity, rank, is_oov): k best answers of
    a - b + c, the three terms excluded.  A triple with an unknown word gives one
    row with is_oov and no answer."""
    qs = analogy_queries(triples, emb, strict).withColumn("qname", F.to_json(F.array(*TERMS)))
    res = top_k_cosine(qs.where(~F.col("is_oov")).select("qid", "qname", "qvec", "excl"), emb, k)
    terms = F.from_json("qname", "array<string>")
    found = res.select(*[terms[i].alias(t) for i, t in enumerate(TERMS)], "word", "similarity",
                       F.col("rank").cast("int").alias("rank"), F.lit(False).alias("is_oov"))
    unknown = qs.where("is_oov").select(
        *TERMS, F.lit(None).cast("string").alias("word"), F.lit(None).cast("double").alias("similarity"),
        F.lit(None).cast("int").alias("rank"), F.lit(True).alias("is_oov"))
    return found.unionByName(unknown)


def vector_means(emb: DataFrame, dim: int) -> DataFrame:
    """Column means: one AVG per dimension in a single aggregate."""
    row = emb.agg(*[F.avg(F.col("vec")[j].cast("double")).alias(f"m{j}") for j in range(dim)])
    return row.select(VX.assemble("m", dim).alias("mean"))


def centered_vectors(emb: DataFrame, dim: int) -> DataFrame:
    """vec - column mean.  The mean is ``dim`` numbers: it comes back to the
    driver and goes out again as a literal vector."""
    mean = vector_means(emb, dim).first()["mean"]
    return emb.select("idx", "word", VX.sub("vec", VX.literal_vector(mean)).alias("vec"))


def six_decimals(x: F.Column) -> F.Column:
    """``%.6f`` with ties to even and the sign of a negative zero."""
    exact = F.abs(x).cast("double").try_cast("decimal(38,20)")
    digits = F.bround(exact, 6).cast("decimal(38,6)").cast("string")
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    # From 1e18 on a float has no decimals to round; NaN and infinity have none.
    return F.coalesce(F.concat(sign, digits), F.format_string("%.6f", x.cast("double")))


def text_vectors(emb: DataFrame, dim: int) -> DataFrame:
    """Word2vec text format as (line_no, line): header 'V dim' at line 0,
    then 'word x1 ... xd' with 6 decimals in id order at line idx + 1."""
    header = emb.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).cast("bigint").alias("line_no"),
        F.concat_ws(" ", F.col("n").cast("string"), F.lit(str(dim))).alias("line"))
    fmt = F.transform("vec", six_decimals)
    body = emb.select((F.col("idx") + 1).cast("bigint").alias("line_no"),
                      F.concat_ws(" ", F.col("word"), F.array_join(fmt, " ")).alias("line"))
    return header.unionByName(body)


def long_form(df: DataFrame, keys: list[str], vec_col: str = "vec", val: str = "val") -> DataFrame:
    """(keys..., j, val) with one row per dimension."""
    return df.select(*keys, F.posexplode(vec_col).alias("j", val)) \
        .select(*keys, F.col("j").cast("int").alias("j"), val)
