"""Near-duplicate lines by a segment-partition edit join.

Two different lines link if their edit distance is at most ``limit`` and both have
at least ``min_chars`` code points (by default 2 and 20: an edit budget never exceeds a
tenth of a line); equal lines of any length are one class.

* An indexed line is cut into ``limit + 1`` segments of nearly equal length; with at
  most ``limit`` edits one of them stands unchanged in the other line.
* A line probes, for every length from its own down to ``limit`` less, the substrings
  that can meet a segment of a line of that length (multi-match-aware starts: twelve
  probes for a limit of 2, three of them its own segments).  Segments and probes
  are 64-bit keys of (length, segment number, content), computed for a whole Arrow
  batch at once; only segments and the probes that met one are written.
* Lines are counted per key in a map-side combined grouping, never a window; keys
  with at most ``HOT`` indexed lines are joined; keys with more are cut into
  blocks of ``BLOCK`` indexed and probing lines that meet in one task each, which
  emits link counts and a spanning forest instead of pairs.
* Candidates are verified by banded bit-parallel edit distance on whole lines, many
  pairs per machine word operation, in batches of bounded code points.  A pair that
  shares several segments counts at the first of them only, so each link is counted once.

Rows: a null text has no lines, an empty text one empty line.  Repeated rows are
repeated lines; a null doc_id sorts first, and rows of equal (doc_id, line_no) and text
are kept or dropped together.  Other columns are ignored.  A line of any length is
hashed and compared whole, in a batch of its own if it is very long.  Lines are told
apart by 128 bits (``node, check``); the class and component ids shown are the first
64 of them.  Empty tables give no rows.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, measured_broadcast, sorted_groups, store, table
from .components import components
from .embed_dedup import block_forest
from .shingles import _POWERS, U64, fmix

LIMIT = 2
MIN_CHARS = 20
HOT = 16
BLOCK = 256
CHUNK = 1 << 20               # bytes hashed at once
CELLS = 1 << 20               # code points compared at once


def segments(n: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths (rows: lines, columns: segments) for lines of ``n`` points."""
    k = limit + 1
    length = n[:, None] // k + (np.arange(k) >= k - n[:, None] % k)
    return np.cumsum(length, axis=1) - length, length


def probe_starts(i: int, start: int, delta: int, limit: int = LIMIT) -> range:
    """Where segment ``i`` (from 0, at ``start``) of a line may stand in one that is
    ``delta`` longer, if no earlier segment fits better on its side."""
    lo = max(start - i, start + delta - (limit - i))
    hi = min(start + i, start + delta + (limit - i))
    return range(lo, hi + 1)


def _span_keys(points: np.ndarray):
    """A function (first point, length, line length, segment) -> keys of spans."""
    up, down = _POWERS.get(len(points) + 1)
    total = np.zeros(len(points) + 1, dtype=U64)
    np.cumsum(fmix(points.astype(U64) + U64(77)) * up[:-1], out=total[1:])

    def keys(a, length, l, i):
        h = fmix((total[a + length] - total[a]) * down[a])
        return fmix(h + l.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(i + 1)).view(np.int64)
    return keys


def _index_rows(keys, first, n, limit, min_chars):
    """(line, segment, key) of every segment."""
    start, length = segments(n, limit)
    for i in range(limit + 1):
        yield np.arange(len(n)), i, keys(first + start[:, i], length[:, i], n, i)


def _probe_rows(keys, first, n, limit, min_chars):
    """(line, how much longer than the line it looks for, key) of every probe but
    the unshifted ones at equal length, which are the line's own segments."""
    for delta in range(limit + 1):
        at = np.flatnonzero(n - delta >= min_chars)
        l = n[at] - delta
        start, length = segments(l, limit)
        for i in range(limit + 1):
            for shift in probe_starts(i, 0, delta, limit):
                s = start[:, i] + shift
                ok = (s >= 0) & (s + length[:, i] <= n[at])
                if delta or shift:
                    yield at[ok], delta, keys(first[at[ok]] + s[ok], length[ok, i], l[ok], i)


def _distinct(batches):
    """Batches of (node, check, line) with every line once."""
    for b in batches:
        node, check = (b.column(i).to_numpy() for i in range(2))
        order = np.lexsort((check, node))
        again = (np.diff(node[order]) == 0) & (np.diff(check[order]) == 0)
        yield b.take(pa.array(np.sort(np.delete(order, np.flatnonzero(again) + 1))))


def _code_points(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of an Arrow string array, one line after the other, and the
    lines' lengths; no Python string per line."""
    lines = lines.cast(pa.large_string())
    ends = np.frombuffer(lines.buffers()[1], dtype=np.int64)[lines.offset:lines.offset + len(lines) + 1]
    raw = memoryview(lines.buffers()[2])[ends[0]:ends[-1]]
    points = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), dtype="<u4")
    return points, pc.utf8_length(lines).to_numpy().astype(np.int64)


def _line_keys(rows_of, name: str, limit: int, min_chars: int):
    """Distinct long lines of a batch -> (``name``, key, node)."""
    def run(batches):
        for part in bounded(_distinct(batches), 2, CHUNK):
            points, n = _code_points(part.column(2))
            node_of = part.column(0).to_numpy()
            got = list(rows_of(_span_keys(points), np.cumsum(n) - n, n, limit, min_chars))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.full(len(at), v, dtype=np.int32) for at, v, _ in got])),
                 pa.array(np.concatenate([key for *_, key in got])),
                 pa.array(node_of[np.concatenate([at for at, *_ in got])])], [name, "key", "node"])
    return run


def within_limit(a: list[str], b: list[str], limit: int = LIMIT) -> np.ndarray:
    """Which pairs are at edit distance <= ``limit``: banded bit-parallel columns,
    one machine word per pair.  Needs ``len(a) >= len(b) > limit``."""
    out = np.zeros(len(a), dtype=bool)
    size = np.array([len(x) for x in a], dtype=np.int64)
    order = np.argsort(size, kind="stable")
    lo = 0
    while lo < len(order):
        # As many pairs as fit the bound when padded to the longest of them.
        cells = size[order[lo:lo + 2048]] * np.arange(1, min(2048, len(order) - lo) + 1)
        pick = order[lo:lo + max(1, int(np.searchsorted(cells, CELLS, side="right")))]
        out[pick] = _columns([a[k] for k in pick], [b[k] for k in pick], limit)
        lo += len(pick)
    return out


def _points(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.full((int(n.max()), len(texts)), pad, dtype=np.uint32)      # one row per place
    for k, t in enumerate(texts):
        out[:len(t), k] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return out, n


def _columns(a: list[str], b: list[str], limit: int) -> np.ndarray:
    x, n = _points(a, 0xFFFFFFFF)
    y, m = _points(b, 0xFFFFFFFE)
    one = U64(1)
    vp = np.full(len(a), ((1 << (limit + 1)) - 1) << (63 - limit), dtype=U64)
    vn = np.zeros(len(a), dtype=U64)
    dist = np.full(len(a), limit, dtype=np.int64)
    for j in range(int(m.max())):
        live = j < m
        eq = np.zeros(len(a), dtype=U64)
        for t in range(2 * limit + 2):                   # the band, lowest row first
            i = j + limit - t
            if 0 <= i < len(x):
                eq |= (x[i] == y[j]).astype(U64) << U64(63 - t)
        with np.errstate(over="ignore"):
            d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        inside = j < n - limit                           # the band's last row is still in a
        side = np.where(inside, 0, j - (n - limit)).astype(U64)
        bit = U64(62) - np.minimum(side, U64(62))
        step = np.where(inside, 1 - (d0 >> U64(63)).astype(np.int64),
                        ((hp >> bit) & one).astype(np.int64) - ((hn >> bit) & one).astype(np.int64))
        dist += np.where(live, step, 0)
        d0 >>= one
        vp = np.where(live, hn | ~(d0 | hp), vp)
        vn = np.where(live, d0 & hp, vn)
    return (dist <= limit) & (n - m <= limit)


@lru_cache(maxsize=1 << 14)
def _places(n: int, delta: int, limit: int) -> tuple:
    """(start, end, where a ``delta`` longer line may hold it) of each segment."""
    start, length = (x[0].tolist() for x in segments(np.array([n]), limit))
    return tuple((a, a + m, tuple(at for at in probe_starts(i, a, delta, limit) if at >= 0))
                 for i, (a, m) in enumerate(zip(start, length)))


def first_shared(s: str, r: str, limit: int = LIMIT) -> int:
    """The first segment of ``s`` that a probe of the longer line ``r`` meets, or -1."""
    for i, (a, z, places) in enumerate(_places(len(s), len(r) - len(s), limit)):
        seg = s[a:z]
        for at in places:
            if r.startswith(seg, at):
                return i
    return -1


def _linked(s: list[str], r: list[str], seg: list[int], limit: int) -> np.ndarray:
    """Pairs (indexed line, probing line) that link and count at this segment."""
    ok = np.array([0 <= len(y) - len(x) <= limit and first_shared(x, y, limit) == i for x, y, i in zip(s, r, seg)],
                  dtype=bool)
    at = np.flatnonzero(ok)
    if len(at):
        ok[at] = within_limit([r[k] for k in at], [s[k] for k in at], limit)
    return ok


def _verify_pairs(limit: int, batches):
    """(a, its check, b, its check, segment, line of a, line of b) -> the ids that link."""
    for b in bounded(batches, 5):
        seg, s, r = (b.column(i).to_pylist() for i in range(4, 7))
        yield b.select([0, 1, 2, 3]).filter(pa.array(_linked(s, r, seg, limit)))


def _verify_blocks(limit: int, batches):
    for g in sorted_groups(batches, ["key", "i", "j"]):
        side = g["side"].to_numpy()
        l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(l) or not len(r):
            continue
        text, longer = g["line"].tolist(), g["longer"].to_numpy()
        ids, place = np.unique(g[["node", "check"]].to_numpy(), axis=0, return_inverse=True)
        place = place.ravel()
        u, v = (x.ravel() for x in np.meshgrid(l, r, indexing="ij"))
        # Lines of one length meet twice: the smaller id counts as indexed.
        ok = np.where(longer[v] > 0, place[u] != place[v], place[u] < place[v])
        at = np.flatnonzero(ok)
        ok[at] = _linked([text[k] for k in u[at]], [text[k] for k in v[at]], [int(g["seg"].iat[0])] * len(at), limit)
        close = ok.reshape(len(l), len(r))
        if not close.any():
            continue
        a, b = block_forest(close, place[l], place[r])
        member = np.concatenate([place[l], place[r]])
        n = np.concatenate([close.sum(axis=1), close.sum(axis=0)])
        member, n = member[n > 0], n[n > 0]
        # Link counts of lines, then the forest's links.
        one, two = np.concatenate([member, b]), np.concatenate([np.zeros_like(member), a])
        forest = np.arange(len(one)) >= len(member)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[one, 0]), pa.array(ids[one, 1]), pa.array(np.concatenate([n, np.zeros_like(b)]), mask=forest),
             pa.array(ids[two, 0], mask=~forest), pa.array(ids[two, 1], mask=~forest)],
            ["node", "check", "n", "other", "other_check"])


def split_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line, node, check)`` of every line of every text."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumns(
        {"node": F.xxhash64("line"), "check": F.xxhash64(F.lit(1), "line")})


def _texts_of(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, check, line)`` of distinct ``nodes``.  Up to the size gate the ids go to
    the lines; beyond it both shuffle."""
    nodes = store(nodes, "wanted-lines")
    return lines.join(measured_broadcast(nodes, 16), "node", "left_semi").dropDuplicates(["node", "check"])


def line_links(docs: DataFrame, limit: int = LIMIT, min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """(``id, n_links``; ``node, root``) of lines that link with another one; ids and
    roots are structs of node and check."""
    if not 0 <= limit < min(min_chars, 16):
        raise ValueError("limit must be from 0 to 15 and less than min_chars")
    lines = split_lines(docs.select("doc_id", "text"))
    long = lines.where(F.char_length("line") >= min_chars).select("node", "check", "line")
    index = long.mapInArrow(_line_keys(_index_rows, "seg", limit, min_chars), "seg int, key long, node long").distinct()
    index = store(index, "line-index")
    # Counts combine map-side; only the large keys are kept and sent to the index.
    large = measured_broadcast(store(index.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
                                     .where(F.col("m") > HOT).select("key"), "hot-keys"), 8)
    few = index.join(large, "key", "left_anti")
    hot = index.join(large, "key", "left_semi").select("key", "seg", "node")
    # A probe meets each line of a small key, and a large key once.
    targets = few.select("key", "seg", F.col("node").alias("a")).union(
        hot.select("key", "seg", F.lit(None).cast("long")).distinct())
    probe = long.mapInArrow(_line_keys(_probe_rows, "longer", limit, min_chars), "longer int, key long, node long")
    met = store(probe.withColumnRenamed("node", "b").join(targets, "key").where(
        "a is null or (longer > 0 and a <> b) or a < b").distinct(), "line-probes")

    # At most HOT lines a key.
    same = few.groupBy("key", "seg").agg(F.collect_list("node").alias("nodes")).where(F.size("nodes") > 1)
    level = same.select("seg", F.explode("nodes").alias("a"), "nodes").select(
        "seg", "a", F.explode("nodes").alias("b")).where("a < b")
    pairs = store(met.where("a is not null").select("a", "b", "seg").union(level.select("a", "b", "seg")).distinct(),
                  "line-pairs")
    zero = F.lit(0)
    members = hot.select("key", "seg", zero.alias("side"), zero.alias("longer"), "node").union(
        hot.select("key", "seg", F.lit(1), zero, "node")).union(
        met.where("a is null").select("key", "seg", F.lit(1), "longer", F.col("b"))).distinct()
    members = store(members, "hot-members")
    # One more pass over the texts, for the lines of pairs and of large keys alike.
    texts = store(_texts_of(long, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(
        members.select("node")).distinct()), "line-texts")
    def side(a: str, check: str, line: str) -> DataFrame:
        return texts.select(F.col("node").alias(a), F.col("check").alias(check), F.col("line").alias(line))

    cold = store(pairs.join(side("a", "ca", "s"), "a").join(side("b", "cb", "r"), "b")
                 .select("a", "ca", "b", "cb", "seg", "s", "r")
                 .mapInArrow(partial(_verify_pairs, limit), "a long, ca long, b long, cb long"), "line-links")

    sizes = members.groupBy("key").agg(
        F.ceil(F.count(F.when(F.col("side") == 0, 1)) / F.lit(BLOCK)).cast("int").alias("ni"),
        F.ceil(F.count(F.when(F.col("side") == 1, 1)) / F.lit(BLOCK)).cast("int").alias("nj"))
    busy = members.join(measured_broadcast(sizes, 32), "key")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("ni")).otherwise(F.col("nj"))).cast("int")
    other = F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("nj")).otherwise(F.col("ni")) - 1)
    placed = busy.withColumn("own", own).withColumn("other", F.explode(other)).select(
        "key", "seg", F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")).alias("j"), "side", "longer", "node")
    blocks = store(placed.join(texts, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
                   .mapInArrow(partial(_verify_blocks, limit), "node long, check long, n long, other long, other_check long"),
                   "hot-links")

    def line_id(node: str, check: str) -> F.Column:
        return F.struct(F.col(node).alias("node"), F.col(check).alias("check"))

    one = F.lit(1).cast("long")
    links = cold.select(line_id("a", "ca").alias("a"), line_id("b", "cb").alias("b"))
    counts = links.select(F.col("a").alias("id"), one.alias("n")).union(links.select("b", one)).union(
        blocks.where("other is null").select(line_id("node", "check"), "n")).groupBy("id").agg(F.sum("n").alias("n_links"))
    edges = links.union(blocks.where("other is not null").select(line_id("node", "check"), line_id("other", "other_check")))
    return counts, store(components(edges), "line-groups")


def near_duplicate_lines(docs: DataFrame, limit: int = LIMIT, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, line_no, class_id, n_links, component_id, kept)`` per line; the
    first line of a component by (doc_id, line_no) is kept."""
    counts, groups = line_links(docs, limit, min_chars)
    linked = store(groups.withColumnRenamed("node", "id").join(counts, "id", "left").select(
        "id.node", "id.check", "root", "n_links"), "linked-lines")
    rows = store(split_lines(docs.select("doc_id", "text")).select("doc_id", "line_no", "node", "check"), "line-rows")
    classes = rows.groupBy("node", "check").agg(F.min(F.struct("doc_id", "line_no")).alias("c"), F.count(F.lit(1)).alias("m"))
    # Only lines with copies or links need a lookup; all others stand alone.
    known = store(classes.join(measured_broadcast(linked, 64), ["node", "check"], "left").where("m > 1 or root is not null"),
                  "line-classes")
    least = known.where("root is not null").groupBy("root").agg(
        F.min("c").alias("g"), F.min("node").alias("least"))
    labels = store(known.join(least, "root", "left").select(
        "node", "check", F.coalesce("g", "c").alias("first"), F.coalesce("least", "node").alias("component"), "n_links"),
        "line-labels")
    return rows.join(measured_broadcast(labels, 64), ["node", "check"], "left").select(
        "doc_id", "line_no", F.col("node").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
        F.coalesce(F.col("first").eqNullSafe(F.struct("doc_id", "line_no")) | F.col("first").isNull(),
                   F.lit(True)).alias("kept"))


def drop_near_duplicate_lines(docs: DataFrame, limit: int = LIMIT, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, text)`` with only the kept lines, in order."""
    kept = near_duplicate_lines(docs, limit, min_chars).where("kept").select("doc_id", "line_no")
    lines = split_lines(docs.select("doc_id", "text")).join(kept, ["doc_id", "line_no"], "left_semi")
    return lines.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l")).select(
        "doc_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_lines(table(spark, sf_dir, "documents"))
