"""Connected components of a link table, by contraction in written rounds.

Every node points at the neighbour (or itself) of least hash; both ends of all
links are then replaced by what they point at, and the round repeats on the
links that are left.  Priorities are hashes of the ids, so a long chain loses a
constant share of its nodes per round, and a star ends after two.  A round is
one map-side combined aggregation and two joins whose skewed keys AQE splits;
nothing but the test for an empty table reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _rank(c: str) -> F.Column:
    return F.struct(F.xxhash64(F.lit(7), F.col(c)).alias("h"), F.col(c).alias("id"))


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of ids of one type that sorts -> ``(node, root)``: equal roots mean linked.

    Self-links, repeated links and both directions are allowed; nodes without
    a link to another node are not returned; no links give no rows.
    """
    links = store(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    out = None
    while out is None or not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min(_rank("b")).alias("least")).select(
            F.col("a").alias("node"), F.least(_rank("a"), F.col("least"))["id"].alias("root"))
        step = store(step, "component-step")
        ends = links.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a") \
            .join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        links = store(ends.where("ra != rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if out is None:
            out = step
        else:
            nxt = step.select(F.col("node").alias("root"), F.col("root").alias("_to"))
            out = out.join(nxt, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return out
