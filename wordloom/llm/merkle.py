"""Merkle manifest of a dataset, by concatenated-level strings.

A leaf is the digest of one row.  Leaves of a group (here: a language) are
numbered in order and cut into aligned blocks of ``2 ** BITS``.  A block keeps
each level of its tree as one hex string: the parents of a level are the
digests of its substrings of two digests' width (an odd last one stands alone),
joined again, so a block's tree is a few strings and no row per node.  A
member's sibling on a level is the substring that flanks its own, empty where
there is none, so a proof's segment inside the block is read off the strings.

The blocks' roots are the next tier's leaves, blocked the same way, until one
node is left per group (its subroot); subroots in order of their groups are one
more such tree.  Coming down again, every block hands its members the path above
it: joins of one row per block with one row per block.

All tiers are written tables in the shared folder.  A group of any size is
spread over its blocks, so a language that holds a third of all rows is like
any other; a task holds a block's members (256 digests), never a group.  The
driver learns the number of nodes left, nothing else.

Rows: null columns are coded as ``-``; null languages are a group of their own,
the first; rows with a null doc_id come first in their group, rows that share a
doc_id follow their digests, equal rows stay (each is a leaf).  A text of any
length is one field of one digest.  An empty table gives no rows.  Only the
columns named are read: others, whatever their names, change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rank import dense_index
from .common import measured_broadcast, store, table

BITS = 8                        # a block has 2 ** BITS leaves
HEX = 64                        # characters of a digest
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = "array<struct<sib:string,left:boolean>>"


def record_digest(fields: list) -> F.Column:
    """SHA-256 of fields, each ``-`` or its byte count, a colon and its value."""
    def coded(c):
        text = F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[coded(c) for c in fields]).cast("binary"), 256)


def _height(n: str) -> str:
    """Levels of a block above its leaves, in a group of ``n`` nodes: all of them
    while the group goes on above, else up to its last node."""
    return f"least({BITS}, if({n} <= 1, 0, length(bin({n} - 1))))"


def _blocks(nodes: DataFrame, carry: list[str]) -> DataFrame:
    """``(g, p, n, levels, m)`` per block ``p`` of ``nodes(g, pos, n, leaf, *carry)``:
    its levels from the leaves up, and its members in order."""
    got = nodes.groupBy("g", F.shiftright("pos", BITS).alias("p")).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "leaf", *carry))).alias("m"))
    leaves = "cast(array_join(transform(m, x -> x.leaf), '') as binary)"
    last = "element_at(done, -1)"
    parents = f"""transform(sequence(0, cast(ceil(length({last}) / {2 * HEX}) as int) - 1),
        i -> sha2(substring({last}, i * {2 * HEX} + 1, {2 * HEX}), 256))"""
    climb = f"""aggregate(if(h = 0, cast(array() as array<int>), sequence(1, h)), array({leaves}),
        (done, l) -> concat(done, array(cast(array_join({parents}, '') as binary))))"""
    return got.withColumn("h", F.expr(f"int({_height('n')})")).withColumn("levels", F.expr(climb))


def _tiers(nodes: DataFrame, carry: list[str]) -> list[DataFrame]:
    """Written block tables, from the leaves to one block per group."""
    out = []
    while True:
        out.append(store(_blocks(nodes, carry), "merkle-tier"))
        most = out[-1].agg(F.max("p")).first()[0]
        if not most:
            return out
        left = F.expr(f"(n + {1 << BITS} - 1) div {1 << BITS}")
        nodes = out[-1].select("g", F.col("p").alias("pos"), left.alias("n"), _top().alias("leaf"))
        carry = []


def _top() -> F.Column:
    return F.element_at("levels", -1).cast("string")


def _members(blocks: DataFrame, above: DataFrame, carry: list[str], hand: list[str]) -> DataFrame:
    """``(g, pos, leaf, *carry, path, *hand)`` per member: the siblings inside its
    block, then ``above(g, p, path, *hand)``."""
    # Inside the array: an exploded row must not carry its block's strings.
    at = f"(x.pos & {(1 << BITS) - 1})"
    steps = f"""transform(if(h = 0, cast(array() as array<int>), sequence(0, h - 1)), l -> struct(
        cast(substring(levels[l], (shiftright({at}, l) ^ 1) * {HEX} + 1, {HEX}) as string) as sib,
        (shiftright({at}, l) & 1) = 1 as left))"""
    fields = ", ".join(f"x.{c} as {c}" for c in ["pos", "leaf", *carry])
    rows = blocks.join(measured_broadcast(above, 4096), ["g", "p"]).select(
        "g", F.col("path").alias("over"), *hand, F.explode(F.expr(f"transform(m, x -> struct({fields}, {steps} as low))"))
        .alias("x"))
    return rows.select("g", "x.pos", "x.leaf", *[f"x.{c}" for c in carry],
                       F.concat("x.low", "over").cast(STEP).alias("path"), *hand)


def _descend(tiers: list[DataFrame], above: DataFrame, carry: list[str], hand: list[str]) -> DataFrame:
    """Members of the lowest tier with their whole paths; ``above(g, path, *hand)``
    holds the path of every group's last node."""
    above = above.withColumn("p", F.lit(0).cast("long"))
    for t in reversed(tiers[1:]):
        above = _members(t, above, [], hand).select("g", F.col("pos").alias("p"), "path", *hand)
    return _members(tiers[0], above, carry, hand)


def fold(start: F.Column, path: str = "path") -> F.Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(
        F.when(s["left"], s["sib"]).otherwise(""), acc, F.when(s["left"], "").otherwise(s["sib"])).cast("binary"), 256))


def merkle_paths(leaves: DataFrame, order: list, carry: list[str]) -> DataFrame:
    """``(g, pos, leaf, *carry, path, subroot, root)`` per row of ``leaves(g, leaf,
    ...)``; ``g`` (a non-null string) names its group, ``order`` sorts inside it."""
    rows = dense_index(leaves.select("g", "leaf", *carry), ["g", *order], "_i")
    groups = rows.groupBy("g").agg(F.min("_i").alias("_0"), F.count(F.lit(1)).alias("n"))
    nodes = rows.join(measured_broadcast(groups, 64), "g").select(
        "g", (F.col("_i") - F.col("_0")).alias("pos"), "n", "leaf", *carry)
    low = _tiers(nodes, carry)
    # The groups' last nodes, in order of the groups, are the leaves of the upper tree.
    tops = dense_index(low[-1].select(F.col("g").alias("of"), _top().alias("leaf")), ["of"], "pos")
    n = tops.count()
    high = _tiers(tops.select(F.lit("").alias("g"), "pos", F.lit(n).cast("long").alias("n"), "leaf", "of"), ["of"])
    root = high[-1].select("g", F.array().cast(STEP).alias("path"), _top().alias("root"))
    above = _descend(high, root, ["of"], ["root"]).select(
        F.col("of").alias("g"), "path", F.col("leaf").alias("subroot"), "root")
    return _descend(low, above, carry, ["subroot", "root"])


def document_leaves(docs: DataFrame) -> DataFrame:
    """``(doc_id, g, leaf, altered)`` per document: its digest, and for a keyed
    seventh the digest it has once n_chars is off by one (else null)."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # Byte order of the coded name: null first, then the languages.
        F.coalesce(F.concat(F.lit("s"), "lang"), F.lit("n")).alias("g"),
        record_digest(FIELDS).alias("leaf"),
        F.when(hit, record_digest([*FIELDS[:3], more.cast("decimal(20,0)"), "text"])).alias("altered"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and each one's check against the root."""
    leaves = store(document_leaves(table(spark, sf_dir, "documents")), "merkle-leaves")
    rows = merkle_paths(leaves, [F.asc_nulls_first("doc_id"), "leaf"], ["doc_id", "altered"])
    folded = rows.withColumn("folded_root", fold(F.coalesce("altered", "leaf")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.transform("path", lambda s: s["sib"]), "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(n_chars: str) -> str:
    def coded(c):
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    return f"sha256({' || '.join(coded(n_chars if c == 'n_chars' else c) for c in FIELDS)})"


# CRC-32, bit by bit (reflected polynomial 0xEDB88320).
_SQL_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ord(ch)::BIGINT)), lambda a, x:
    list_reduce(list_concat([xor(a, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda c, k: xor(c >> 1, (c & 1) * 3988292384))))"""

SQL = f"""
WITH RECURSIVE
base AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
                count(*) OVER (PARTITION BY g) AS n, row_number() OVER () AS r
         FROM (SELECT doc_id, coalesce('s' || lang, 'n') AS g, {_sql_leaf('n_chars')} AS leaf,
                      CASE WHEN {_SQL_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_sql_leaf('(n_chars + 1)')}
                      END AS altered FROM documents)),
low AS (SELECT g, 0 AS l, p, n, leaf AS h FROM base
        UNION ALL
        SELECT g, l + 1, p // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY p))
        FROM low WHERE n > 1 GROUP BY g, l + 1, p // 2),
subs AS (SELECT g, l AS depth, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS p, count(*) OVER () AS n
         FROM low WHERE n = 1),
high AS (SELECT 0 AS l, p, n, subroot AS h FROM subs
         UNION ALL
         SELECT l + 1, p // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY p))
         FROM high WHERE n > 1 GROUP BY l + 1, p // 2),
top AS (SELECT l AS depth, h AS root FROM high WHERE n = 1),
steps AS (
  SELECT r, k, CASE WHEN side = 1 THEN 'L' ELSE 'R' END || coalesce(h, '') AS s
  FROM (SELECT b.r, b.g, u.l AS k, xor(b.p >> u.l, 1) AS q, (b.p >> u.l) & 1 AS side
        FROM base b JOIN subs USING (g), (SELECT unnest(range(40)) AS l) u WHERE u.l < depth) x
  LEFT JOIN low ON low.g = x.g AND low.l = x.k AND low.p = x.q
  UNION ALL
  SELECT r, 100 + k, CASE WHEN side = 1 THEN 'L' ELSE 'R' END || coalesce(h, '')
  FROM (SELECT b.r, u.l AS k, xor(s.p >> u.l, 1) AS q, (s.p >> u.l) & 1 AS side
        FROM base b JOIN subs s USING (g), top, (SELECT unnest(range(40)) AS l) u WHERE u.l < top.depth) x
  LEFT JOIN high ON high.l = x.k AND high.p = x.q),
paths AS (SELECT r, list(s ORDER BY k) AS path FROM steps GROUP BY r),
done AS (
  SELECT doc_id, leaf, subroot, root,
         sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x[2:]), '')) AS proof_sha256,
         list_reduce(list_concat([coalesce(altered, leaf)], coalesce(path, [])), lambda a, x:
             sha256(CASE WHEN x[1] = 'L' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
  FROM base JOIN subs USING (g) CROSS JOIN top LEFT JOIN paths USING (r))
SELECT *, folded_root = root AS verified FROM done
"""
