"""A part of the queries against the candidates that its cells call for.

The rows of a part arrive sorted: its queries, then the candidates block by block.  A task
holds the queries with the best k found for each, and one block; a query meets a block
only if the cell's best possible cosine reaches the query's floor, which rises as better
candidates are found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as VX
from .topk import RESULT

ROWS = 512                    # queries scored at once: a product has ROWS * block numbers
OUT_ROWS = 4096               # queries whose results are given back at once
QUERY, CANDIDATE = 0, 1
SLACK = 1e-6                  # radians: above the rounding error of an angle
SHORT, ODD = -1, -2           # cells of too short and of non-finite vectors


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _norms(x: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", over="ignore"):
        return np.sqrt(np.einsum("ij,ij->i", x, x))


class _Part:
    """Queries, their floors, and the best k so far."""

    def __init__(self, plan: "Owned", t: pa.Table) -> None:
        t = t.combine_chunks()
        own = {c: t.column(c).combine_chunks() for c in ("id", "name", "qvec", "excl", "home", "hblk", "floor")}
        self.plan, k, n = plan, plan.k, len(t)
        self.qid, self.home, self.hblk = (own[c].to_numpy() for c in ("id", "home", "hblk"))
        self.qname, self.q = own["name"], _matrix(own["qvec"])
        self.norm = _norms(self.q)
        self.odd = ~np.isfinite(self.norm)
        self.unit = np.where(self.odd[:, None], 0.0, self.q) / np.where(self.odd, 1.0, self.norm)[:, None]
        floor = own["floor"].to_numpy(zero_copy_only=False)
        self.floor = np.where(np.isnan(floor), -np.inf, floor)
        excl = own["excl"].to_pylist()
        self.out_row = np.repeat(np.arange(n), [len(e or ()) for e in excl])
        self.out_idx = np.array([-1 if x is None else x for e in excl for x in e or ()], dtype=np.int64)
        self.some = np.array([x is not None for e in excl for x in e or ()], dtype=bool)
        self.n = np.zeros(n, dtype=np.int64)
        self.sim, self.idx = np.full((n, k), -np.inf), np.zeros((n, k), dtype=np.int64)
        self.word = np.full((n, k), None, dtype=object)

    def _open(self, cell: int) -> np.ndarray:
        if cell == ODD:
            return np.ones(len(self.qid), dtype=bool)
        best = np.zeros(len(self.qid))
        if cell >= 0:
            away = np.arccos(np.clip(self.unit @ self.plan.book[cell], -1.0, 1.0)) - self.plan.radius[cell] - SLACK
            best = np.cos(np.maximum(away, 0.0))
        return self.odd | (best >= self.floor - 1e-9)

    def meet(self, cell: int, blk: int, t: pa.Table) -> None:
        rows = np.flatnonzero(self._open(cell) & ~((self.home == cell) & (self.hblk == blk)))
        if not len(rows):
            return
        t = t.combine_chunks()
        c, cidx = _matrix(t.column("vec").combine_chunks()), t.column("id").to_numpy()
        nc, word = _norms(c), t.column("name").combine_chunks()
        ids, back = np.unique(cidx[::-1], return_index=True)
        # Excluded: the last row of a query's excluded id.
        at = np.minimum(np.searchsorted(ids, self.out_idx), len(ids) - 1)
        hit = self.some & (ids[at] == self.out_idx)
        out_row, out_col = self.out_row[hit], len(cidx) - 1 - back[at[hit]]
        for a in range(0, len(rows), ROWS):
            r = rows[a:a + ROWS]
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                s = (self.q[r] @ c.T) / np.outer(self.norm[r], nc)
            s = np.clip(s, -1.0, 1.0)
            s[(self.norm[r] < VX.COSINE_NORM_FLOOR)[:, None] | (nc < VX.COSINE_NORM_FLOOR)[None, :]] = 0.0
            mine = (out_row >= r[0]) & (out_row <= r[-1])
            place = np.searchsorted(r, out_row[mine])
            same = r[place] == out_row[mine]
            s[place[same], out_col[mine][same]] = -np.inf
            i, j = np.nonzero((s >= self.floor[r][:, None]) & (s > -np.inf))
            if len(i):
                self._keep(r[i], s[i, j], cidx[j], word, j)

    def _keep(self, row, sim, idx, word, j) -> None:
        k, some = self.plan.k, np.unique(row)
        old = np.arange(k)[None, :] < self.n[some][:, None]
        was = np.repeat(some, k)[old.reshape(-1)]
        rows = np.concatenate([was, row])
        sims = np.concatenate([self.sim[some][old], sim])
        idxs = np.concatenate([self.idx[some][old], idx])
        order = np.lexsort((idxs, -sims, rows))
        rows = rows[order]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        rank = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        order, rows, rank = order[rank < k], rows[rank < k], rank[rank < k]
        words = np.empty(len(order), dtype=object)
        new = order >= len(was)
        words[~new] = self.word[some][old][order[~new]]
        words[new] = word.take(pa.array(j[order[new] - len(was)])).to_pylist()
        self.sim[rows, rank], self.idx[rows, rank], self.word[rows, rank] = sims[order], idxs[order], words
        self.n[some] = np.bincount(np.searchsorted(some, rows), minlength=len(some))
        full = some[self.n[some] == k]
        self.floor[full] = np.maximum(self.floor[full], self.sim[full, k - 1])

    def results(self):
        k = self.plan.k
        for a in range(0, len(self.qid), OUT_ROWS):
            z = slice(a, a + OUT_ROWS)
            some = np.arange(k)[None, :] < self.n[z][:, None]
            row = a + np.nonzero(some)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.qid[row]), self.qname.take(pa.array(row)), pa.array(self.idx[z][some]),
                 pa.array(self.word[z][some].tolist(), pa.string()), pa.array(self.sim[z][some])],
                ["qid", "qname", "idx", "word", "similarity"])


class Owned:
    """The kernel over a task's parts; ``radius`` is by cell."""

    def __init__(self, book: np.ndarray, radius: dict, k: int) -> None:
        self.book, self.radius, self.k = book, radius, k

    def __call__(self, batches):
        part, own, held, at = None, None, [], None

        def end():
            nonlocal own, held
            if held and at[1] == QUERY:
                own = _Part(self, pa.Table.from_batches(held))
            elif held and own is not None:
                own.meet(at[2], at[3], pa.Table.from_batches(held))
            held = []
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("part", "kind", "cell", "blk")])
            cuts = np.flatnonzero(np.append(True, (np.diff(keys, axis=1) != 0).any(axis=0)))
            for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), b.num_rows]):
                key = tuple(keys[:, a].tolist())
                if key != at:
                    end()
                    if at is None or key[0] != at[0]:
                        if own is not None:
                            yield from own.results()
                        own = None
                    at = key
                held.append(b.slice(a, z - a))
        end()
        if own is not None:
            yield from own.results()


def stream(queries: DataFrame, cands: DataFrame, parts: int, kernel: Owned) -> DataFrame:
    """The kernel's results for ``queries(part, qid, qname, qvec, excl, home, hblk, floor)``
    and ``cands(part, cell, blk, idx, word, vec)``."""
    vec = cands.schema["vec"].dataType

    def none(kind):
        return F.lit(None).cast(kind)
    q = queries.select("part", F.lit(QUERY).alias("kind"), F.lit(0).alias("cell"), F.lit(0).alias("blk"),
                       F.col("qid").cast("bigint").alias("id"), F.col("qname").alias("name"), "qvec", "excl", "home", "hblk",
                       "floor", none(vec).alias("vec"))
    c = cands.select("part", F.lit(CANDIDATE).alias("kind"), "cell", "blk", F.col("idx").cast("bigint").alias("id"),
                     F.col("word").alias("name"), none("array<double>").alias("qvec"), none("array<bigint>").alias("excl"),
                     none("int").alias("home"), none("int").alias("hblk"), none("double").alias("floor"), "vec")
    return q.unionByName(c).repartitionById(parts, "part").sortWithinPartitions("part", "kind", "cell", "blk", "id") \
        .mapInArrow(kernel, RESULT)
