"""What a task holds while queries meet the codebook and a block of candidates."""

import numpy as np
import pandas as pd

from wordloom.operators import nearest as NE
from wordloom.operators import topk as TK


def queries(n, dim, rng):
    return pd.DataFrame({"qid": np.arange(n), "qname": [str(i) for i in range(n)], "qvec": list(rng.normal(size=(n, dim))),
                         "excl": [[i] for i in range(n)], "home": np.zeros(n, np.int32), "hblk": np.zeros(n, np.int32),
                         "floor": np.full(n, -1.0)})


def test_visits_come_in_small_batches():
    rng = np.random.default_rng(1)
    book = rng.normal(size=(40, 8))
    book /= np.linalg.norm(book, axis=1)[:, None]
    cells = pd.DataFrame({"cell": np.arange(40), "radius": np.full(40, 0.2)})
    got = list(NE._open_cells(book, cells)(iter([queries(1500, 8, rng)])))
    assert max(map(len, got)) <= NE.OUT_ROWS
    all_of = pd.concat(got)
    assert len(all_of) == 1500 * 40 and not all_of.duplicated(["qid", "cell"]).any()


def test_products_are_cut_by_queries(monkeypatch):
    rng = np.random.default_rng(2)
    q = queries(700, 8, rng)
    c = pd.DataFrame({"idx": np.arange(300), "word": [str(i) for i in range(300)], "vec": list(rng.normal(size=(300, 8)))})
    seen = []
    real = np.clip
    monkeypatch.setattr(TK.np, "clip", lambda x, *a: seen.append(x.shape) or real(x, *a))
    got = TK.best_of_block(5)(None, q, c)
    assert max(s[0] for s in seen) <= TK.ROWS and sum(s[0] for s in seen) == 700
    x, y = np.stack(q.qvec), np.stack(c.vec)
    s = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    s[np.arange(300), np.arange(300)] = -np.inf
    want = np.argsort(-s, axis=1)[:, :5]
    assert np.array_equal(got.idx.to_numpy().reshape(700, 5), want)
