"""Queries move once and candidates once per part, however many blocks a query visits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wordloom.operators import nearest as N
from wordloom.operators import serving as S


def table(spark, x):
    rows = [(i, f"w{i}", None if v is None else [float(a) for a in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "idx bigint, word string, vec array<float>")


def test_visits_are_not_moved(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 6)).astype(np.float32)
    x[40], x[41] = x[200], 0.0                                       # a tie, and a too short one
    emb = table(spark, x)
    q = emb.select(F.col("idx").alias("qid"), F.col("word").alias("qname"), F.col("vec").cast("array<double>").alias("qvec"),
                   F.array("idx", (F.col("idx") + 1) % 300).alias("excl"))
    seen = []
    real = N.stream
    monkeypatch.setattr(N, "stream", lambda q, c, parts, kernel: seen.append((q.count(), c.count(), parts)) or real(q, c, parts, kernel))
    monkeypatch.setattr(N, "OWN_ROWS", 120)
    monkeypatch.setattr(S, "CAND_BLOCK_ROWS", 20)
    visits = N.plan_visits(q, emb, 5, 300, 64, 20)[0].count()
    got = {}
    for r in S.top_k_cosine(q, emb, 5, 300, 300).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["idx"], r["word"], r["similarity"]))
    queries, cands, parts = seen[0]
    assert queries == 299 and 3 <= parts and cands <= parts * 300 < visits      # no vector is moved for a visit
    y = x.astype(np.float64)
    n = np.linalg.norm(y, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        s = y @ y.T / np.outer(n, n)
    s[np.isnan(s)] = 0.0
    for i in range(300):
        free = [j for j in range(300) if j not in (i, (i + 1) % 300)]
        want = sorted(free, key=lambda j: (-round(s[i, j], 9), j))[:5]
        mine = sorted(got[i])
        assert [m[3] for m in mine] == pytest.approx([s[i, j] for j in want], abs=1e-9)
        assert [m[1] for m in mine] == want and all(m[2] == f"w{m[1]}" for m in mine)


def test_parts_hold_a_bounded_number_of_queries():
    homes = pd.DataFrame({"home": [0, 1, 2, 5], "n": [10, 250, 30, 40]})
    shares, parts = N._shares(homes, 100, 1)
    assert shares == [(0, 0, 1), (1, 1, 3), (2, 4, 1), (5, 4, 1)] and parts == 5
    assert N._shares(homes, 1000, 1)[1] == 1 and N._shares(homes, 1000, 4)[1] >= 4
