"""Best k of a block of queries in a block of candidates, by cosine."""

from __future__ import annotations

import numpy as np
import pandas as pd

from ..functions import vectors as VX

ROWS = 256                    # queries scored at once: a product has ROWS * block numbers
RESULT = "qid long, qname string, idx long, word string, similarity double"


def best_of_block(k: int):
    """A cogroup function: best ``k`` of every query among one block of candidates."""
    def run(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        cols = ["qid", "qname", "idx", "word", "similarity"]
        if len(q) == 0 or len(c) == 0:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "qname": pd.Series([], dtype="object"),
                                 "idx": pd.Series([], dtype="int64"),
                                 "word": pd.Series([], dtype="object"),
                                 "similarity": pd.Series([], dtype="float64")})[cols]
        cm = np.stack(c["vec"].to_numpy()).astype(np.float64)
        cidx = c["idx"].to_numpy(dtype=np.int64)
        nc = np.sqrt(np.einsum("ij,ij->i", cm, cm))
        pos = {int(v): j for j, v in enumerate(cidx)}
        out_q, out_i, out_s, out_n = [], [], [], []
        for a in range(0, len(q), ROWS):
            _score(q.iloc[a:a + ROWS], cm, nc, cidx, pos, k, out_q, out_i, out_s, out_n)
        if not out_q:
            return run(key, q.iloc[0:0], c.iloc[0:0])
        oi = np.concatenate(out_i)
        words = c.set_index("idx").loc[oi, "word"].to_numpy()
        return pd.DataFrame({"qid": np.concatenate(out_q), "qname": np.concatenate(out_n), "idx": oi,
                             "word": words, "similarity": np.concatenate(out_s)})[cols]
    return run


def _score(q: pd.DataFrame, cm, nc, cidx, pos, k: int, out_q, out_i, out_s, out_n) -> None:
    """Adds the best ``k`` of a few queries to the lists."""
    qm = np.stack(q["qvec"].to_numpy()).astype(np.float64)
    nq = np.sqrt(np.einsum("ij,ij->i", qm, qm))
    with np.errstate(divide="ignore", invalid="ignore"):
        s = (qm @ cm.T) / np.outer(nq, nc)
    s = np.clip(s, -1.0, 1.0)
    s[(nq < VX.COSINE_NORM_FLOOR)[:, None] | (nc < VX.COSINE_NORM_FLOOR)[None, :]] = 0.0
    for i, ex in enumerate(q["excl"].to_numpy()):
        if ex is None:
            continue
        for e in ex:
            j = pos.get(int(e))
            if j is not None:
                s[i, j] = -np.inf
    kk = min(k, s.shape[1])
    qids = q["qid"].to_numpy(dtype=np.int64)
    qnames = q["qname"].to_numpy()
    part = np.argpartition(-s, kk - 1, axis=1)[:, :kk]
    for i in range(s.shape[0]):
        row = s[i]
        thr = row[part[i]].min()
        if thr == -np.inf:
            cand = np.nonzero(row > -np.inf)[0]
        else:
            cand = np.nonzero(row >= thr)[0]
        if cand.size == 0:
            continue
        order = np.lexsort((cidx[cand], -row[cand]))[:kk]
        sel = cand[order]
        out_q.append(np.full(sel.size, qids[i], dtype=np.int64))
        out_n.append(np.full(sel.size, qnames[i], dtype=object))
        out_i.append(cidx[sel])
        out_s.append(row[sel])
