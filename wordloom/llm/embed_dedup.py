"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products.

* Equal vectors of a label are one class (copies cost one row).
* Each large (label, dimension) group gets a codebook by spherical k-means on a
  keyed sample (at most ``SAMPLE_PER_CELL`` vectors per centroid); codebooks
  together hold at most ``MAX_FLOATS`` numbers, so they are broadcast.
* A vector lives in the cell of its nearest centroid.  It also visits every cell
  that a neighbour at cosine >= 0.98 could live in: unit vectors that close are
  at most d = sqrt(2 - 2 * 0.98) apart, so if y lives at h and its neighbour at
  c, then y . (h - c) <= d |h - c|.  Hence no link is lost at a cell's border.
* Cells are cut into blocks of about ``BLOCK`` vectors; the residents of one block
  meet the residents and visitors of another in one double-precision product.
  Only link counts and a spanning forest of the block's links are emitted, never
  the pairs, so a dense group costs products but no rows.

Rows: null, empty, zero or non-finite vectors, null labels and null ids link with
nothing.  Vectors of different lengths are not compared.  Rows that repeat an id
with the same vector count as one vector.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import measured_broadcast, sorted_groups, store, table
from .components import components

MIN_COSINE = 0.98
CELL = 2048                  # vectors per cell aimed at
MAX_CELLS = 256              # per label: larger cells only take more blocks
MAX_FLOATS = 1 << 22         # numbers in all codebooks together
SAMPLE_PER_CELL = 64
ROUNDS = 8
BLOCK = 1024
REACH = float(np.sqrt(2 - 2 * MIN_COSINE)) + 1e-9


def unit_rows(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 3) -> np.ndarray:
    """Unit centroids; a centroid that loses its cell stays where it was."""
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        home = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        norm = np.sqrt((sums * sums).sum(axis=1))
        c[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return c


def _train(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node")
    c = spherical_kmeans(unit_rows(pdf["embedding"]), int(pdf["k"].iat[0]))
    return pd.DataFrame({"label": pdf["label"].iat[0], "dim": pdf["dim"].iat[0],
                         "cell": range(len(c)), "centre": list(c)})


def _assign(books):
    """Rows (label, dim, node, copies, embedding) -> one row per cell they enter."""
    def enter(x, book):
        if book is None:
            return np.arange(len(x)), np.zeros(len(x), dtype=np.int64), np.ones(len(x), dtype=bool)
        sim = x @ book.T
        home = np.argmax(sim, axis=1)
        apart = np.sqrt(np.maximum(2 - 2 * (book @ book.T), 0))[home]
        lead = sim[np.arange(len(x)), home][:, None] - sim
        row, cell = np.nonzero(lead <= REACH * apart + 1e-12)
        return row, cell, home[row] == cell

    def run(batches):
        for b in batches:
            df = b.to_pandas()
            for (label, dim), g in df.groupby(["label", "dim"]):
                row, cell, resident = enter(unit_rows(g["embedding"]), books.value.get((label, dim)))
                g = g.iloc[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g["label"], pa.int64()), pa.array(g["dim"], pa.int32()), pa.array(cell, pa.int32()),
                     pa.array(resident), pa.array(g["node"], pa.int64()), pa.array(g["copies"], pa.int64()),
                     pa.array(list(g["embedding"]), b.schema.field("embedding").type)],
                    ["label", "dim", "cell", "resident", "node", "copies", "embedding"])
    return run


def block_forest(close: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest ``(a, b)`` with the components of a block's links."""
    nodes = np.unique(np.concatenate([left, right]))
    li, ri = np.searchsorted(nodes, left), np.searchsorted(nodes, right)
    low, last = np.arange(len(nodes)), None
    top = len(nodes)
    while last is None or (low != last).any():
        last = low.copy()
        np.minimum.at(low, li, np.where(close, low[ri][None, :], top).min(axis=1, initial=top))
        np.minimum.at(low, ri, np.where(close, low[li][:, None], top).min(axis=0, initial=top))
        low = low[low]
    at = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[low[at]], nodes[at]


def _compare(batches):
    """Sorted rows of one block pair: residents (side 0) against members (side 1)."""
    for g in sorted_groups(batches, ["label", "dim", "cell", "i", "j"]):
        side = g["side"].to_numpy()
        if (side == 0).all() or (side == 1).all():
            continue
        x, node, copies = unit_rows(g["embedding"]), g["node"].to_numpy(), g["copies"].to_numpy()
        l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        close = (x[l] @ x[r].T >= MIN_COSINE) & (node[l][:, None] != node[r][None, :])
        use_l, use_r = close.any(axis=1), close.any(axis=0)
        if not use_l.any():
            continue
        close, l, r = close[use_l][:, use_r], l[use_l], r[use_r]
        a, b = block_forest(close, node[l], node[r])
        n = close @ copies[r]
        none = [None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*node[l].tolist(), *b.tolist()], pa.int64()),
             pa.array([*n.tolist(), *none * len(b)], pa.int64()),
             pa.array([*none * len(l), *a.tolist()], pa.int64())], ["node", "n", "other"])


def links_and_components(vectors: DataFrame) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors(vec_id, embedding, label)``."""
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    moved = F.exists("embedding", lambda x: x != 0)
    usable = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & moved, F.lit(False)))
    classes = store(usable.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("copies"))
        .withColumn("dim", F.size("embedding")), "vector-classes")

    groups = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    total = classes.agg(F.sum(F.col("dim").cast("long")).alias("floats")).first()["floats"] or 0
    share = F.floor(F.col("n") * F.lit(MAX_FLOATS / max(total, 1)))
    k = F.least(F.lit(MAX_CELLS), F.ceil(F.col("n") / F.lit(CELL)), share).cast("int")
    # Groups of one cell need no codebook, so at most MAX_FLOATS / dim rows remain.
    large = groups.withColumn("k", k).where("k > 1")
    dice = F.pmod(F.xxhash64(F.lit(31), "node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = classes.join(F.broadcast(large), ["label", "dim"]) \
        .where(dice < F.lit(float(SAMPLE_PER_CELL)) * F.col("k") / F.col("n"))
    books: dict = {}
    for r in sample.select("label", "dim", "k", "node", "embedding").groupBy("label", "dim").applyInPandas(
            _train, "label long, dim int, cell int, centre array<double>").orderBy("label", "dim", "cell").collect():
        books.setdefault((r["label"], r["dim"]), []).append(r["centre"])
    held = spark.sparkContext.broadcast({key: np.array(c) for key, c in books.items()})

    kind = dict(classes.dtypes)["embedding"]
    cells = store(classes.select("label", "dim", "node", "copies", "embedding").mapInArrow(
        _assign(held), f"label long, dim int, cell int, resident boolean, node long, copies long, embedding {kind}"),
        "cells")
    cell = ["label", "dim", "cell"]
    sizes = cells.groupBy(*cell).agg(
        F.ceil(F.count(F.when(F.col("resident"), 1)) / F.lit(BLOCK)).cast("int").alias("ni"),
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("nj")).where("ni > 0")
    sized = cells.join(measured_broadcast(sizes, 64), cell)
    own = F.xxhash64("node")
    left = sized.where("resident").select(
        *cell, F.pmod(own, "ni").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j"),
        F.lit(0).alias("side"), "node", "copies", "embedding")
    right = sized.select(
        *cell, F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"), F.pmod(own, "nj").cast("int").alias("j"),
        F.lit(1).alias("side"), "node", "copies", "embedding")
    block = [*cell, "i", "j"]
    found = store(left.unionByName(right).repartition(*block).sortWithinPartitions(*block)
                  .mapInArrow(_compare, "node long, n long, other long"), "vector-links")

    counts = found.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    roots = store(roots, "vector-groups")
    least = roots.groupBy("root").agg(F.min("node").alias("least"))
    labels = classes.join(counts, "node", "left").join(roots, "node", "left").join(least, "root", "left").where(
        "copies > 1 or n is not null").select(
        "label", "embedding", F.coalesce("least", "node").alias("component"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = v.join(labels, ["label", "embedding"], "left")
    comp = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(
        F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), comp.alias("component_id"),
        F.coalesce(comp == F.col("vec_id"), F.lit(True)).alias("kept"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links_and_components(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e)
    / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
t(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT t.a, l.y FROM t JOIN l ON l.x = t.b),
m AS (SELECT a, min(b) AS c FROM t GROUP BY a),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, m.c AS component_id, m.c = vec_id AS kept
FROM embeddings e JOIN m ON m.a = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""
