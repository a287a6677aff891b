"""Centroid clustering on heap-ordered bounds.

Lloyd's rounds on integer vectors, exact, that look again only at vectors whose
assignment can have changed.  A vector's gap is the distance to its second
nearest centroid less that to its own.  A round lowers the gap of every vector
of a cluster by at most the same amount: what its centroid moved plus the most
any other moved.  So a cluster keeps one number, its accumulated drift, and a
heap of entries keyed by ``gap + drift when the entry was made``: an entry has
expired once its key is not above the drift, and no other entry changes at all.

The heaps are kept in external memory, as sorted runs.  A round writes the
entries it makes as one run, every file in order of (cluster, key).  Drift never
falls, so an entry's key says by itself when it was popped: between last round's
drift and this one's.  Popping is a range filter on (cluster, key) over the runs,
which Parquet's statistics answer from the heads of the sorted files; entries
popped before are left behind.  Popped vectors are rescanned against all centroids
(numpy on Arrow batches) and pushed with a new key.  After a round that popped
more than half of all entries the next run takes in the live rest as it is, and the
older runs are deleted, so dead entries never outgrow the live ones for long.
Centroid sums change by the vectors that changed cluster alone.

Keys are lowered by a relative 1e-12, far more than the rounding of the bounds, so
a tie or a near tie always counts as expired; distances are exact integers.

The driver holds the model: k centroids, k drifts, k sums (``k`` at most MAX_K).
A cluster of any size is spread over the files of its runs, no vectors are
grouped, and nothing but partial sums is shuffled.  Every run is a written table
in the shared folder, so a lost executor costs one round's tasks.

Rows: a vector is kept if it has exactly ``dim`` components, none null or
non-finite; others have no row.  Kept rows that share a vec_id are vectors of
their own; a null vec_id is kept, but named last for a first centroid.  Fewer
kept vectors than k give as many centroids; no vector, no rows.  A component of
2 ** 17 or more in size is an error: its distance would not be exact.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_table
from .common import store, table

DIM = 64
K = 8
ROUNDS = 10
SCALE = 1024
LARGEST = 1 << 27               # of a scaled component: 64 squared differences stay below 2 ** 63
MAX_K = 256                     # clusters: bounds the filter and the model
SAFE = 1e-12
ENTRY = "vec_id long, v array<int>, cluster int, was int, key double"


def integer_vectors(table_: DataFrame, dim: int = DIM) -> DataFrame:
    """``(vec_id, v)``: kept vectors as integers ``floor(SCALE * x)``."""
    e = F.col("embedding")
    good = (F.size(e) == dim) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform(e, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    far = F.exists(v, lambda x: (x >= LARGEST) | (x <= -LARGEST))
    return table_.where(F.coalesce(good, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(far, F.raise_error(F.lit("embedding component too large for exact distances")))
        .otherwise(v.cast("array<int>")).alias("v"))


def first_centroids(vectors: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The k vectors whose ids hash least, in that order."""
    h = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(h.asc_nulls_last(), "vec_id", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of ``x`` by centroids), as int64."""
    most = max(int(np.abs(a).max(initial=0)) for a in (x, centroids))
    if 4 * x.shape[1] * most ** 2 < 1 << 53:            # every partial sum is an exact double
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def _matrix(col, dim: int) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(-1, dim)


def _push(centroids: np.ndarray, drift: np.ndarray):
    """Rescan: nearest centroid and key of every vector handed in."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            d = squared_distances(_matrix(b.column("v"), centroids.shape[1]), centroids)
            own = d.argmin(axis=1)                       # the first of equals
            near = np.sqrt(d.min(axis=1).astype(np.float64))
            if d.shape[1] > 1:
                other = np.sqrt(np.partition(d, 1, axis=1)[:, 1].astype(np.float64))
            else:
                other = np.full(len(d), np.inf)          # nothing to change to
            at = drift[own]
            loss = np.where(np.isinf(other), 0.0, SAFE * (1 + at + other + near))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.array(own, pa.int32()), b.column("was"),
                 pa.array(at + other - near - loss, pa.float64())],
                ["vec_id", "v", "cluster", "was", "key"])
    return run


def _measure(centroids: np.ndarray):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            own = b.column("cluster").to_numpy()
            diff = _matrix(b.column("v"), centroids.shape[1]) - centroids[own]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("cluster"), pa.array((diff * diff).sum(1), pa.int64())],
                ["vec_id", "cluster", "distance"])
    return run


class Heaps:
    """The clusters' heaps: written runs of sorted entries, the last one newest."""

    def __init__(self) -> None:
        self.runs: list[DataFrame] = []

    def push(self, vectors: DataFrame, centroids: np.ndarray, drift: np.ndarray, merge: bool = False) -> DataFrame:
        """Write one more run and return it.  ``merge`` takes every live entry into
        it (``was`` null: not rescanned) and deletes the older runs."""
        run = vectors.mapInArrow(_push(centroids, drift), ENTRY)
        if merge:
            for old in self.runs:
                rest = old.where(self._keys(drift, lambda d: F.col("key") > d))
                run = run.unionByName(rest.withColumn("was", F.lit(None).cast("int")))
        new = store(run.sortWithinPartitions("cluster", "key"), "heap-run")
        if merge:
            self.drop()
        self.runs.append(new)
        return new

    @staticmethod
    def _keys(drift: np.ndarray, of) -> F.Column:
        """A condition on the key for every cluster, for Parquet to prune by."""
        out = F.lit(False)
        for j, d in enumerate(drift.tolist()):
            out = out | ((F.col("cluster") == j) & of(d))
        return out

    def popped(self, before: np.ndarray, now: np.ndarray) -> DataFrame:
        """Entries that expire as drifts go from ``before`` to ``now``.  Those of
        the last run may hold keys below ``before``: ties, expired at once."""
        *older, last = self.runs
        out = last.where(self._keys(now, lambda d: F.col("key") <= d))
        for run in older:
            out = out.unionByName(run.where(self._keys(before, lambda d: F.col("key") > d)
                                            & self._keys(now, lambda d: F.col("key") <= d)))
        return out

    def live(self, drift: np.ndarray) -> DataFrame:
        """One entry per vector."""
        *older, out = self.runs
        for run in older:
            out = out.unionByName(run.where(self._keys(drift, lambda d: F.col("key") > d)))
        return out

    def drop(self) -> None:
        for run in self.runs:
            drop_table(run)
        self.runs = []


def _moved_sums(run: DataFrame, dim: int) -> list:
    """Per cluster: vectors gained less lost in a run, and their component sums."""
    ends = F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("s")),
                   F.struct(F.col("was").alias("c"), F.lit(-1).alias("s")))
    moves = run.where("was != cluster").select("v", F.explode(ends).alias("e")).select("v", "e.c", "e.s").where("c >= 0")
    return moves.groupBy("c").agg(
        F.sum(F.col("s").cast("long")).alias("n"),
        *[F.sum(F.col("v")[i].cast("long") * F.col("s")).alias(f"x{i}") for i in range(dim)]).collect()


def heap_clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, prefix: str = "3:"):
    """``rounds`` rounds of assignment and exact floor means over ``vectors(vec_id,
    v)``, then one more assignment.  Returns (assignment ``(vec_id, cluster,
    distance)``, centroids, vectors scanned per assignment)."""
    if not 1 <= k <= MAX_K:
        raise ValueError(f"k: expected 1 to {MAX_K}, found {k}")
    spark = vectors.sparkSession
    centroids = first_centroids(vectors, k, prefix)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids, []
    dim = centroids.shape[1]
    heaps = Heaps()
    drift = np.zeros(len(centroids))
    run = heaps.push(vectors.withColumn("was", F.lit(-1)), centroids, drift)
    scanned = [run.count()]
    count = [0] * len(centroids)
    total = [[0] * dim for _ in centroids]               # Python integers: exact at any size
    for _ in range(rounds):
        for r in _moved_sums(run, dim):
            count[r["c"]] += r["n"]
            total[r["c"]] = [a + r[f"x{i}"] for i, a in enumerate(total[r["c"]])]
        moved = np.array([[s // n for s in row] if n else old.tolist()
                          for row, n, old in zip(total, count, centroids)], dtype=np.int64)
        step = np.array([math.sqrt(int(((a - b) ** 2).sum())) for a, b in zip(moved, centroids)]) * (1 + SAFE)
        centroids, before = moved, drift
        others = np.array([np.delete(step, j).max(initial=0.0) for j in range(len(step))])
        drift = before + step + others
        due = heaps.popped(before, drift).select("vec_id", "v", F.col("cluster").alias("was"))
        run = heaps.push(due, centroids, drift, merge=2 * scanned[-1] > scanned[0])
        scanned.append(run.where("was is not null").count())
    assigned = store(heaps.live(drift).select("vec_id", "v", "cluster").mapInArrow(
        _measure(centroids), "vec_id long, cluster int, distance long"), "clusters")
    heaps.drop()
    return assigned, centroids, scanned


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every kept vector, with the final model's sums."""
    rows, centroids, _ = heap_clusters(integer_vectors(table(spark, sf_dir, "embeddings")))
    sums = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    model = [(j, sums.get(j, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
             for j, c in enumerate(centroids)]
    # One row per centroid: at most MAX_K.
    small = spark.createDataFrame(model, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(small), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    ctes = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, vec_id, v) - 1 AS j, v AS c
  FROM v QUALIFY j < {K})"""]
    for t in range(ROUNDS + 1):
        ctes.append(f"""a{t} AS MATERIALIZED (
  SELECT r, vec_id, v, j, dist FROM (
    SELECT r, vec_id, v, j, list_sum(list_transform(range(1, {DIM + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT
      AS dist FROM v, c{t}) QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, j) = 1)""")
        if t < ROUNDS:
            ctes.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT j, coalesce(q, c) AS c FROM c{t} LEFT JOIN (
    SELECT j, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS q FROM (
      SELECT j, i, sum(x) AS s, count(*) AS n
      FROM (SELECT j, unnest(v) AS x, unnest(range({DIM})) AS i FROM a{t}) GROUP BY j, i) GROUP BY j) USING (j))""")
    return f"""WITH {', '.join(ctes)}
SELECT vec_id, j::INTEGER AS cluster, dist AS distance, (sum(dist) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
       (sum(dist) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (j)"""


SQL = _sql()
