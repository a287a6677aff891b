"""Mixing sources to target weights by capped water-filling.

The budget is shared in proportion to the sources' weights; a source whose share
exceeds ``max_epochs`` times its size is clamped there, and what is left is
shared again among the others until none is above.  Each round is one
aggregation over the table of sources; two sums per round reach the driver.

A source of ``target / size`` epochs takes every document the whole number of
times, and a seeded sample of them once more: documents are ordered by a keyed
hash, and the sample ends nearest the source's target.  No source is sorted
as a whole: sizes are summed per 1/256 of the hash range (map-side), a running sum
over these parts finds the one in which the sample ends, the same once more in
that part gives a cell (1/65536), and only that cell's documents are ordered.  Documents are taken whole, so a source misses its
target by at most half of its last sampled document.

DataFrame operations only.  The hash depends on the seed and the doc_id, so reruns
agree on any cluster.

Rows: a null or blank text has size 0 and is taken 0 times.  A null source is a
source of its own, after all others.  Repeated rows are separate documents that
share their hash.  Empty tables and sources without words get a target of 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rng import keyed_uniform, uniform_sql
from ..operators.rank import dense_index
from .common import columns_of, free_names, measured_broadcast, store, table

WEIGHTS = (3, 1, 2)          # by rank of the source, repeating
BUDGET = 1.5                 # of all words
MAX_EPOCHS = 2
SEED = 42
CELLS = 1 << 16              # of the hash range
PARTS = 1 << 8               # cells per part, and parts
WORD = r"[^\x20\x09-\x0D]+"


def n_words(c: str) -> F.Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(docs: DataFrame, source_col: str, size_col: str) -> DataFrame:
    """``(source, source_size, rank)``: code-point order, null last, from 0."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size"))
    return dense_index(sizes, [F.col("source").isNull(), "source"], "rank")


def water_fill(sources: DataFrame, budget: float, max_epochs: int) -> DataFrame:
    """Add ``target`` to ``sources(source_size, weight)``."""
    cap = F.col("source_size") * F.lit(max_epochs)
    level, clamped = 0.0, -1
    while True:
        above = (cap <= F.lit(level) * F.col("weight")) & F.lit(clamped >= 0)
        got = sources.agg(F.sum(F.when(above, cap).otherwise(0)).alias("held"),
                          F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
                          F.count(F.when(above, 1)).alias("n")).first()
        if got["n"] == clamped or not got["open"]:
            break
        # The level only rises, so a clamped source stays clamped.
        level, clamped = max(budget - got["held"], 0.0) / got["open"], got["n"]
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _end_of(rows: DataFrame, plan: DataFrame, same) -> DataFrame:
    """Per source, the last ``at`` of ``rows(source, at, size, base)`` before which
    no more than ``rest`` words stand, and the words before it.  Sizes are summed
    per ``at`` first (map-side), so a window holds at most ``PARTS`` rows."""
    before = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "at").agg(F.sum("size").alias("c"), F.first("base").alias("base"))
    return sums.withColumn("c0", F.col("base") + F.coalesce(F.sum("c").over(before), F.lit(0))) \
        .join(plan, same).where("c0 <= rest").groupBy("source").agg(F.max(F.struct("at", "c0")).alias("last")) \
        .select("source", "last.at", "last.c0")


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """``docs(doc_id, source, size)`` -> plus ``source_size``, ``target``, ``taken``."""
    docs = store(docs.withColumn("u", keyed_uniform("mix", seed, "doc_id"))
                 .withColumn("cell", F.floor(F.col("u") * F.lit(CELLS)).cast("int")), "mix-sizes")
    ranked = ranked_sources(docs, "source", "size")
    weighted = ranked.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    total = docs.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    plan = store(water_fill(store(weighted, "mix-sources"), budget * total, max_epochs), "mix-targets")

    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    plan = plan.select(F.col("source").alias("p_source"), "source_size", "target", whole.alias("whole"),
                       (F.col("target") - whole * size).alias("rest"))
    same = F.col("source").eqNullSafe(F.col("p_source"))
    small_plan = measured_broadcast(plan, 128)

    # Where in the hash order does each source's sample end?  First among 256
    # parts of the range, then among the 256 cells of that part.
    part = F.floor(F.col("cell") / F.lit(PARTS)).cast("int")
    first = _end_of(docs.select("source", part.alias("at"), "size", F.lit(0).alias("base")), small_plan, same)
    first = store(first.select(F.col("source").alias("p_source"), F.col("at").alias("part"), "c0"), "mix-parts")
    inside = docs.withColumn("part", part).join(measured_broadcast(first.withColumnRenamed("part", "end_part"), 64), same) \
        .where("part = end_part").select("source", F.col("cell").alias("at"), "size", F.col("c0").alias("base"))
    ends = store(_end_of(inside, small_plan, same).select(
        F.col("source").alias("e_source"), F.col("at").alias("end_cell"), F.col("c0").alias("end_c0")), "mix-ends")
    # One plan row per source, its end cell included.
    plan = plan.join(ends, F.col("p_source").eqNullSafe(F.col("e_source")), "left").drop("e_source")
    rows = docs.join(measured_broadcast(plan, 160), same).drop("p_source")

    order = Window.partitionBy("source").orderBy("u", "doc_id", "size")
    last = rows.where("cell = end_cell").withColumn(
        "at", F.col("end_c0") + F.coalesce(F.sum("size").over(
            order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # The document that crosses the target is taken if that ends nearer to it.
    last = last.withColumn("more", (F.col("at") + F.col("size") / 2 <= F.col("rest")).cast("long")).drop("at")
    other = rows.where("end_cell is null or cell <> end_cell").withColumn(
        "more", (F.coalesce(F.col("cell") < F.col("end_cell"), F.lit(False))).cast("long"))
    return last.unionByName(other).withColumn(
        "taken", (F.col("size") * (F.col("whole") + F.when(F.col("rest") > 0, F.col("more")).otherwise(0)))
        .cast("long"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words("text").alias("size"))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stands as often as the mix takes it."""
    th, times, rows, nth = free_names(docs, "text_hash", "times", "rows", "nth")
    both = ["doc_id", "source", th]
    key = docs.withColumn(th, F.xxhash64("text"))
    mixed = mix(key.select(*both, n_words("text").alias("size")))
    got = mixed.groupBy(*both).agg(
        F.sum(F.when(F.col("taken") > 0, F.col("taken") / F.col("size"))).cast("int").alias(times),
        F.count(F.lit(1)).alias(rows))
    plan = store(got.where(F.col(times) > 0), "mix-times")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in both]
    joined = key.alias("x").join(plan.alias("y"), same).select("x.*", f"y.{times}", f"y.{rows}")
    # Repeated input rows share their repetitions, so one of them stands for all.
    once = joined.where(F.col(rows) == 1).unionByName(joined.where(F.col(rows) > 1).dropDuplicates(both))
    return once.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*columns_of(docs))


_N = "coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)"
SQL = f"""
WITH d AS (SELECT doc_id, source, {_N}::BIGINT AS size, {uniform_sql('mix', SEED, 'doc_id')} AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k
      FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE k WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
r AS (SELECT *, sum(2 * source_size) OVER o AS held, sum(weight) OVER () - sum(weight) OVER o AS open_w,
             2.0 * source_size / weight AS ratio
      FROM w WINDOW o AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT 0::DOUBLE AS held, sum(weight)::DOUBLE AS open_w, -1::DOUBLE AS ratio FROM w
      UNION ALL SELECT held::DOUBLE, open_w::DOUBLE, ratio FROM r WHERE open_w > 0),
b AS (SELECT 1.5 * sum(source_size) AS budget FROM w),
lv AS (SELECT coalesce(min(level), 0) AS level FROM (
        SELECT (budget - held) / open_w AS level, ratio,
               (SELECT min(2.0 * source_size / weight) FROM w WHERE 2.0 * source_size / weight > c.ratio) AS nxt
        FROM c, b) WHERE ratio <= level AND (nxt IS NULL OR nxt > level)),
t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, level * weight) AS target FROM w, lv),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY u, d.doc_id, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN target - whole * source_size > 0
                              AND pre + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
