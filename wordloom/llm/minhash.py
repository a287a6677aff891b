"""Near-duplicate documents by b-bit MinHash, confirmed on full sets.

1. Every whole text becomes its set of distinct five-word shingles.  128 of 256
   MinHash minima feed 32 band keys of four rows; all 256 keep only their low
   four bits, packed into 16 longs.  A pair at similarity 0.75 shares no band
   with probability (1 - 0.75^4)^32 < 6e-6.
2. Equal sets (128-bit fingerprints) are one class, so copies cost one row.
3. In a band's bucket every class meets the bucket's least class only: as many
   candidate pairs as bucket rows, however large the bucket.  Packed signatures
   are compared by bit counts, corrected for chance collisions of four bits
   (1/16), and pairs far below the threshold go.
4. The rest is confirmed exactly on the full sets, and linked.
5. Buckets that still hold several groups are finished: members of *different*
   groups are compared, block against block, first by signature and then on
   their full sets; a block emits a spanning forest of its links, never its
   pairs.  Nothing is capped, a pair is compared in the first band it shares only,
   and members that already share a group are never compared.
6. Components carry the smallest doc_id.

Memory: texts and sets stay in Arrow batches; a block holds about ``2 * BLOCK``
sets; only emptiness tests reach the driver.

Rows: null, empty or blank texts have no shingles and link with nothing.  A null
doc_id links with nothing (component_id null, kept).  Repeated rows are copies.
An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, columns_of, free_names, sorted_groups, store, table
from .components import components
from .shingles import _POS, U64, fmix, keyed_words, minima_of_sets, set_fingerprint, shingle_set

WIDTH = 5                     # words per shingle
THRESHOLD = 75                # percent
BANDS, ROWS = 32, 4
SLOTS, BITS = 256, 4          # signature: low bits of so many minima
# A signature's standard error at 0.75 is 0.028: four of them are left.
ESTIMATE_FROM = THRESHOLD / 100 - 0.11
BLOCK = 512                   # members of a bucket per compared block

_MULT = keyed_words(SLOTS, 21) | U64(1)
_ADD = keyed_words(SLOTS, 22)
_BAND = keyed_words(BANDS, 23)
_NIBBLES = 0x1111111111111111

SIGNED = ("doc_id long, text_hash long, n_shingles long, node long, check long, bands array<long>, "
          "sig array<long>")


def band_keys(mins: np.ndarray) -> np.ndarray:
    """``(n, BANDS)`` signed keys, the band's number mixed in."""
    rows = mins[:, :BANDS * ROWS].reshape(len(mins), BANDS, ROWS)
    return fmix((rows * _POS[:ROWS]).sum(axis=2, dtype=U64) + _BAND).view(np.int64)


def packed(mins: np.ndarray) -> np.ndarray:
    """Low ``BITS`` bits of every minimum, packed into signed longs."""
    per = 64 // BITS
    low = (mins & U64((1 << BITS) - 1)).reshape(len(mins), -1, per)
    return (low << (U64(BITS) * np.arange(per, dtype=U64))).sum(axis=2, dtype=U64).view(np.int64)


def _sign(batches):
    for b in bounded(batches, 1):
        sets = [shingle_set(t, WIDTH) for t in b.column(1).to_pylist()]
        mins = minima_of_sets(sets, _MULT, _ADD)
        prints = [set_fingerprint(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
             pa.array(list(band_keys(mins)), pa.list_(pa.int64())),
             pa.array(list(packed(mins)), pa.list_(pa.int64()))],
            ["doc_id", "text_hash", "n_shingles", "node", "check", "bands", "sig"])


def _sets(batches):
    for b in bounded(batches, 1):
        sets = [shingle_set(t, WIDTH) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([set_fingerprint(s)[0] for s in sets], pa.int64()),
             pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
            ["want", "node", "shingles"])


def estimate(a: str, b: str) -> Column:
    """Collision-corrected similarity of two packed signatures, in the JVM."""
    def differing(x, y):
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseAND(F.lit(_NIBBLES)))
    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << BITS)
    return (F.lit(1.0) - apart / F.lit(float(SLOTS)) - chance) / (1.0 - chance)


def _sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(node, shingles)``: the full sets of distinct ``nodes``, from one document each."""
    wanted = classes.select("node", "first_id").join(nodes, "node")
    texts = docs.join(wanted.select(F.col("first_id").alias("doc_id"), F.col("node").alias("want")), "doc_id") \
        .select("want", "text")
    # A repeated doc_id may carry another text: only the class's own set counts.
    return store(texts.mapInArrow(_sets, "want long, node long, shingles array<long>")
                 .where("want = node").select("node", "shingles"), "shingle-sets").dropDuplicates(["node"])


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose full sets reach the threshold."""
    sets = _sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), classes, docs)
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    return store(pairs.select("a", "b").join(x, "a").join(y, "b")
                 .where(100 * both >= THRESHOLD * either).select("a", "b"), "confirmed-links")


def _reach(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets reach the threshold."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= THRESHOLD * (len(a) + len(b) - both)


def _close_block(batches):
    """Rows sorted by (key, lo, hi), a group being one pair of blocks of a bucket:
    links between members of different groups, as a spanning forest.

    A pair counts in the first band it shares (its members hold all their
    keys), so it is compared once; the signature's estimate goes first, the full
    sets decide, and members that are joined meanwhile are not compared again.
    """
    chance = 1.0 / (1 << BITS)
    most = int(np.floor(SLOTS * (1 - chance) * (1 - ESTIMATE_FROM)))
    for g in sorted_groups(batches, ["key", "lo", "hi"]):
        key, lo, hi = (g[c].iat[0] for c in ("key", "lo", "hi"))
        sig, bands = np.stack(g["sig"].to_numpy()).view(U64), np.stack(g["bands"].to_numpy())
        node, own, hub = g["node"].to_numpy(), g["own"].to_numpy(), g["hub"].iat[0]
        sets, group = g["shingles"].to_numpy(), g["comp"].to_numpy().copy()
        left, right = np.flatnonzero((own == lo) & (node != hub)), np.flatnonzero((own == hi) & (node != hub))
        links = []
        for i in left:
            d = sig[i] ^ sig[right]
            d |= d >> U64(2)
            d |= d >> U64(1)
            apart = np.bitwise_count(d & U64(_NIBBLES)).sum(axis=1)
            at = right[(apart <= most) & (group[right] != group[i])]
            at = at[(own[at] != own[i]) | (node[i] < node[at])]
            if not len(at):
                continue
            same = bands[at] == bands[i]
            for j in at[bands[i][np.argmax(same, axis=1)] == key]:
                if group[i] != group[j] and _reach(sets[i], sets[j]):
                    links.append((min(node[i], node[j]), max(node[i], node[j])))
                    group[group == group[j]] = group[i]
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, text_hash)`` per row of
    ``docs(doc_id, text)``; the hash tells rows apart that share an id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = store(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sign, SIGNED), "signatures")
    usable = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # Signature and bands are functions of the set, so any row of a class has them.
    classes = store(usable.groupBy("node", "check").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_rows"),
        F.first("bands").alias("bands"), F.first("sig").alias("sig")), "classes")

    rows = classes.select("node", F.explode("bands").alias("key"))
    hubs = rows.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = store(rows.join(hubs, "key"), "buckets")

    sig_a = classes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    sig_b = classes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    tried = store(buckets.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
                  .join(sig_a, "a").join(sig_b, "b")
                  .where(estimate("sig_a", "sig_b") >= ESTIMATE_FROM).select("a", "b"), "hub-pairs")
    links = _confirm(tried, classes, docs)
    groups = store(components(links), "groups")

    labelled = buckets.where("n > 2").join(groups, "node", "left").select(
        "key", "node", "hub", "n", F.coalesce("root", "node").alias("comp"))
    open_keys = labelled.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")) \
        .where("c0 != c1").select("key")
    members = store(labelled.join(open_keys, "key"), "open-buckets")
    if not members.isEmpty():
        sets = _sets_of(members.select("node").distinct(), classes, docs)
        full = classes.select("node", "bands", "sig").join(sets, "node")
        blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
        spread = members.join(full, "node") \
            .withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")) \
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
            .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                    "own", "node", "comp", "hub", "sig", "bands", "shingles")
        rest = spread.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi") \
            .mapInArrow(_close_block, "a long, b long")
        links = links.union(store(rest, "rest-links"))
        groups = store(components(links), "groups")

    # Only classes with copies or links need a lookup; all other rows stand alone.
    rooted = classes.join(groups, "node", "left").select(
        "node", "check", "first_id", "n_rows", "root")
    least = rooted.where("root is not null").groupBy("root").agg(F.min("first_id").alias("least_id"))
    labels = rooted.where("n_rows > 1 or root is not null").join(least, "root", "left").select(
        "node", "check", F.coalesce("least_id", "first_id").alias("label"))
    known = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    out = signed.select("doc_id", "text_hash", "n_shingles", "node", "check").join(labels, ["node", "check"], "left")
    comp = F.when(known, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"), "text_hash")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group stays (rows that repeat an id and
    its text are one document); rows with a null doc_id stay."""
    th, = free_names(docs, "text_hash")
    drop = near_duplicates(docs).where(~F.col("kept")).select("doc_id", F.col("text_hash").alias(th)).distinct()
    known = docs.where("doc_id is not null").withColumn(th, F.xxhash64("text"))
    once = known.join(drop, ["doc_id", th], "left_anti").dropDuplicates(["doc_id", th]).select(*columns_of(docs))
    return once.union(docs.where("doc_id is null"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS MATERIALIZED (SELECT DISTINCT x, y FROM (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(na.n) AS p, any_value(nb.n) AS q
  FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r JOIN n na ON na.r = a.r JOIN n nb ON nb.r = b.r
  GROUP BY a.r, b.r, a.doc_id, b.doc_id) WHERE 100 * c >= 75 * (p + q - c)),
t(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT t.a, l.y FROM t JOIN l ON l.x = t.b),
m AS (SELECT a, min(b) AS c FROM t GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, m.c = d.doc_id AS kept
FROM d LEFT JOIN n USING (r) JOIN m ON m.a = d.doc_id
"""
