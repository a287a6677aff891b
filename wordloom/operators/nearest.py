"""Exact k nearest rows by cosine for many queries, skipping cells that cannot hold one.

* A codebook of directions is fitted on a keyed sample of bounded size.  Every
  candidate joins the cell of its nearest direction; a cell knows its size and the
  largest angle between its direction and a member.  Cells are cut into blocks.
* A query first meets one block of its nearest cell.  Its k-th best similarity there
  is a floor that the answer cannot fall below.
* By the triangle inequality on angles a member of a cell is at least
  ``angle(query, direction) - radius`` away from the query, so a cell whose best
  possible cosine is below the floor is not visited.  All others are, block by block.

The codebook and the cell table have at most ``MAX_NUMBERS`` numbers, whatever the
vocabulary; larger cells only have more blocks.  A first group holds one block of candidates
and one of queries.  For the rest a task owns a bounded part of the queries, of neighbouring
cells (:mod:`.owned`): a query moves once, a candidate once per part that may need its cell,
and a task keeps only the best k of its queries, so neither visits nor their results are moved.  The answer does not depend on the codebook: a poor one only skips
less.  Vectors shorter than the norm floor have similarity 0 with everything and form a
cell of their own; vectors with a non-finite component are visited by every query, and
such a query visits every cell.  Null vectors are no candidates.  A query that is itself
too short ties with everything, so the lowest ids are its answer.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as VX
from ..session import fits_broadcast, write_table
from .owned import ODD, SHORT, SLACK, Owned, stream
from .topk import RESULT, best_of_block

MAX_NUMBERS = 4 << 20         # numbers in the codebook
SAMPLE_PER_CELL = 16          # rows a cell's direction is fitted on, on average
FIT_ROUNDS = 6
ROWS = 512                    # rows held against the codebook at once
OUT_ROWS = 4096               # visits given back at once, each with its query's vector
OWN_ROWS = 1 << 16            # queries that a task owns
OWN_NUMBERS = 8 << 20         # numbers in their vectors
_QUERY = "qid long, qname string, qvec array<double>, excl array<bigint>, cell int"


def _matrix(col) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows, and which rows are too short or non-finite (their rows are zero)."""
    with np.errstate(invalid="ignore", over="ignore"):
        n = np.sqrt(np.einsum("ij,ij->i", x, x))
    odd = ~np.isfinite(n)
    short = ~odd & (n < VX.COSINE_NORM_FLOOR)
    off = odd | short
    return np.where(off[:, None], 0.0, x) / np.where(off, 1.0, n)[:, None], short, odd


def fit_codebook(emb: DataFrame, n_rows: int, cell_rows: int) -> np.ndarray:
    """Spherical k-means directions, fitted on a keyed sample of the candidates."""
    dim = emb.where("vec is not null").select(F.size("vec").alias("d")).first()
    if dim is None:
        return np.zeros((0, 0))
    cells = max(1, min(math.ceil(n_rows / cell_rows), MAX_NUMBERS // (SAMPLE_PER_CELL * max(1, dim["d"]))))
    every = max(1, n_rows // (SAMPLE_PER_CELL * cells))
    rows = emb.where(F.col("vec").isNotNull() & (F.pmod(F.xxhash64(F.lit(3), "idx"), F.lit(every)) == 0)) \
        .select("idx", "vec").toPandas().sort_values("idx", kind="stable")
    if not len(rows):
        return np.zeros((0, dim["d"]))
    x, short, odd = _directions(_matrix(rows["vec"]))
    x = np.unique(x[~(short | odd)], axis=0)
    if not len(x):
        return np.zeros((0, dim["d"]))
    book = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(FIT_ROUNDS):
        near = np.argmax(x @ book.T, axis=1)
        total = np.zeros_like(book)
        np.add.at(total, near, x)
        n = np.sqrt(np.einsum("ij,ij->i", total, total))
        book = np.where((n > VX.COSINE_NORM_FLOOR)[:, None], total / np.maximum(n, VX.COSINE_NORM_FLOOR)[:, None], book)
    return book


def _angles(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ book.T, -1.0, 1.0))


def _few(batches):
    """The batches in parts of ``ROWS`` rows: what a task holds beside the codebook grows
    neither with the number of cells times a batch nor with the visits of a batch."""
    for b in batches:
        for a in range(0, len(b), ROWS):
            yield b.iloc[a:a + ROWS]


def _assign(book: np.ndarray):
    def run(batches):
        for c in _few(batches):
            x, short, odd = _directions(_matrix(c["vec"]))
            cell, angle = np.full(len(c), SHORT), np.zeros(len(c))
            if len(book):
                a = _angles(x, book)
                cell = np.argmin(a, axis=1)
                angle = a[np.arange(len(c)), cell]
            cell[short], cell[odd] = SHORT, ODD
            # Without a codebook every finite row is visited like a non-finite one.
            cell[~short & (cell == SHORT)] = ODD
            yield c.assign(cell=cell.astype(np.int32), angle=angle)
    return run


def _first_cells(book: np.ndarray, cells: pd.DataFrame):
    """Every query with its nearest cell that has members."""
    real = cells[cells["cell"] >= 0]["cell"].to_numpy()

    def run(batches):
        for q in _few(batches):
            x, short, odd = _directions(_matrix(q["qvec"]))
            home = np.full(len(q), int(cells["cell"].max()))
            if len(real):
                home = real[np.argmin(_angles(x, book[real]), axis=1)]
            yield q.assign(cell=home.astype(np.int32))[["qid", "qname", "qvec", "excl", "cell"]]
    return run


def _open(book: np.ndarray, cells: pd.DataFrame):
    """Which cells' best possible cosine reaches the floors of some queries."""
    cell = cells["cell"].to_numpy()
    radius = cells["radius"].to_numpy()
    real = cell >= 0

    def of(q: pd.DataFrame) -> np.ndarray:
        x, short, odd = _directions(_matrix(q["qvec"]))
        best = np.zeros((len(q), len(cell)))
        best[:, cell == ODD] = np.inf
        if real.any():
            away = _angles(x, book[cell[real]]) - radius[real] - SLACK
            best[:, real] = np.cos(np.maximum(away, 0.0))
        best[odd] = np.inf
        floor = q["floor"].fillna(-np.inf).to_numpy(dtype=np.float64)
        return best >= floor[:, None] - 1e-9
    return of


def _open_cells(book: np.ndarray, cells: pd.DataFrame):
    """Every query once per cell whose best possible cosine reaches its floor."""
    cell, open_of = cells["cell"].to_numpy(), _open(book, cells)

    def run(batches):
        for q in _few(batches):
            at, to = np.nonzero(open_of(q))
            out = q[["qid", "qname", "qvec", "excl", "home", "hblk"]]
            for a in range(0, len(at), OUT_ROWS):
                yield out.iloc[at[a:a + OUT_ROWS]].assign(cell=cell[to[a:a + OUT_ROWS]].astype(np.int32))
    return run


def _wanted_cells(book: np.ndarray, cells: pd.DataFrame):
    """The cells that a part's queries may need, each once per batch."""
    cell, open_of = cells["cell"].to_numpy(), _open(book, cells)

    def run(batches):
        for q in _few(batches):
            at, to = np.nonzero(open_of(q))
            pairs = np.unique(np.stack([q["part"].to_numpy()[at], cell[to]]), axis=1)
            yield pd.DataFrame({"part": pairs[0].astype(np.int32), "cell": pairs[1].astype(np.int32)})
    return run


def _shares(homes: pd.DataFrame, most: int, least: int) -> tuple[list[tuple[int, int, int]], int]:
    """(home, its first part, its parts) and the number of parts: ``most`` queries in a part,
    and ``least`` parts if there are queries for them; a cell with more is cut."""
    size = max(1, min(most, -(-int(homes["n"].sum()) // least)))
    out, part, held = [], 0, 0
    for home, n in homes.sort_values("home")[["home", "n"]].itertuples(index=False):
        if held and held + n > size:
            part, held = part + 1, 0
        cut = -(-n // size)
        out.append((int(home), part, int(cut)))
        part, held = (part + cut, 0) if cut > 1 else (part, held + n)
    return out, part + (held > 0)


def _blocks(key, n) -> F.Column:
    return F.pmod(F.xxhash64(key), n).cast("int")


def _meet(queries: DataFrame, cands: DataFrame, k: int, query_block: int) -> DataFrame:
    """Best k of every query in the candidate block ``(cell, blk)`` it names."""
    n = queries.groupBy("cell", "blk").agg(F.ceil(F.count(F.lit(1)) / F.lit(query_block)).cast("int").alias("nq"))
    n = write_table(n, "nearest-groups")              # one row per block
    side = F.broadcast(n) if fits_broadcast(n.count(), 32) else n
    q = queries.join(side, ["cell", "blk"]).withColumn("part", _blocks("qid", F.col("nq"))).drop("nq")
    c = cands.join(side, ["cell", "blk"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))) \
        .select("cell", "blk", "part", "idx", "word", "vec")
    return q.groupBy("cell", "blk", "part").cogroup(c.groupBy("cell", "blk", "part")) \
        .applyInPandas(best_of_block(k), RESULT)


def nearest(queries: DataFrame, emb: DataFrame, k: int, n_cands: int, query_block: int,
            cell_rows: int) -> DataFrame:
    """``(qid, qname, idx, word, similarity)``: rows among which every query's best
    ``k`` are.  ``queries``: ``(qid, qname, qvec array<double>, excl)``."""
    p = _Plan(queries, emb, k, n_cands, query_block, cell_rows)
    if p.known is None:
        return p.first.unionByName(p.low)
    return p.first.unionByName(_rest(p, k)).unionByName(p.low)


def _rest(p: "_Plan", k: int) -> DataFrame:
    """Best k of every query outside its first block."""
    spark = p.known.sparkSession
    known = write_table(p.known, "nearest-known")
    homes = known.groupBy("home").agg(F.count(F.lit(1)).alias("n")).toPandas()     # a row per cell
    if not len(homes):
        return p.first.limit(0)
    dim = known.select(F.size("qvec").alias("d")).first()["d"]
    shares, parts = _shares(homes, max(1, min(OWN_ROWS, OWN_NUMBERS // max(1, dim))), spark.sparkContext.defaultParallelism)
    shares = F.broadcast(spark.createDataFrame(shares, "home int, base int, cut int"))
    known = known.join(shares, "home").withColumn("part", (F.col("base") + _blocks("qid", F.col("cut"))).cast("int"))
    wanted = known.select("part", "qvec", "floor").mapInPandas(_wanted_cells(p.book, p.table), "part int, cell int").distinct()
    wanted = write_table(wanted, "nearest-wanted")
    side = F.broadcast(wanted) if fits_broadcast(wanted.count(), 16) else wanted
    return stream(known, p.cands.join(side, "cell"), parts, Owned(p.book, dict(zip(p.table["cell"], p.table["radius"])), k))


def plan_visits(queries: DataFrame, emb: DataFrame, k: int, n_cands: int, query_block: int, cell_rows: int):
    """(which query visits which block, candidates, results of the first blocks,
    results of too short queries)."""
    p = _Plan(queries, emb, k, n_cands, query_block, cell_rows)
    if p.known is None:
        return p.queries.limit(0).selectExpr("qid", "0 cell", "0 blk", "0 home", "0 hblk", "qname", "qvec", "excl"), \
            p.cands, p.first, p.low
    visits = p.known.mapInPandas(_open_cells(p.book, p.table), "qid long, qname string, qvec array<double>, "
                                 "excl array<bigint>, home int, hblk int, cell int") \
        .join(p.blocks, "cell").withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).drop("nb")
    return visits, p.cands, p.first, p.low


class _Plan:
    """Cells, candidates in their blocks, and queries with their first block's floor."""

    def __init__(self, queries: DataFrame, emb: DataFrame, k: int, n_cands: int, query_block: int, cell_rows: int) -> None:
        self.book = book = fit_codebook(emb, n_cands, cell_rows)
        cands = emb.where("vec is not null").select("idx", "word", "vec")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cands.schema.fields)
        cands = write_table(cands.mapInPandas(_assign(book), f"{fields}, cell int, angle double"), "nearest-cells")
        cells = cands.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")) \
            .withColumn("nb", F.ceil(F.col("n") / F.lit(cell_rows)).cast("int"))
        cells = write_table(cells, "nearest-radii")       # at most one row per direction, and two
        self.table = table = cells.toPandas()
        self.blocks = blocks = F.broadcast(cells.select("cell", "nb"))
        self.cands = cands.join(blocks, "cell").select("cell", _blocks("idx", F.col("nb")).alias("blk"), "idx", "word", "vec")

        queries = queries.withColumn("short", (VX.norm("qvec") < VX.COSINE_NORM_FLOOR)
                                     & ~F.exists("qvec", F.isnan))
        queries = write_table(queries, "nearest-queries")
        self.low = _of_short(queries.where("short"), emb, k)
        self.queries = queries = queries.where(~F.col("short")).drop("short")
        self.known, self.first = None, self.low.limit(0)
        if not len(table):
            return
        homes = queries.mapInPandas(_first_cells(book, table), _QUERY).join(blocks, "cell") \
            .withColumn("blk", _blocks("qid", F.col("nb"))).drop("nb")
        homes = write_table(homes, "nearest-homes")
        self.first = write_table(_meet(homes, self.cands, k, query_block), "nearest-first")
        floors = self.first.groupBy("qid", "qname").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("floor")) \
            .where(F.col("n") >= k).drop("n")
        self.known = homes.withColumnsRenamed({"cell": "home", "blk": "hblk"}).join(floors, ["qid", "qname"], "left") \
            .select("qid", "qname", "qvec", "excl", "home", "hblk", "floor")


def _of_short(queries: DataFrame, emb: DataFrame, k: int) -> DataFrame:
    """Too short queries tie with everything: the ``k`` lowest ids not excluded."""
    most = queries.agg(F.max(F.size("excl")).alias("n")).first()["n"]
    rows = [] if most is None else emb.where("vec is not null").select("idx", "word").orderBy("idx") \
        .limit(k + max(most, 0)).collect()
    lowest = F.array(*[F.struct(F.lit(r["idx"]).cast("long").alias("idx"), F.lit(r["word"]).alias("word"))
                       for r in rows]) if rows else F.expr("cast(array() as array<struct<idx:bigint,word:string>>)")
    free = F.filter(lowest, lambda x: ~F.coalesce(F.array_contains("excl", x["idx"]), F.lit(False)))
    return queries.select("qid", "qname", F.explode(F.slice(free, 1, k)).alias("x")) \
        .select("qid", "qname", "x.idx", "x.word", F.lit(0.0).alias("similarity"))
