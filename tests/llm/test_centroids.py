import hashlib
import math

import numpy as np
import pytest

from wordloom.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k, rounds, dim):
    """Plain Lloyd rounds with Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((r for r in kept if r[0] is not None),
                   key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[0], r[1]))
    cent = [list(v) for _, v in order + sorted(r for r in kept if r[0] is None)][:k]

    def nearest():
        d = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in cent] for _, v in kept]
        return [min(range(len(cent)), key=lambda j: (x[j], j)) for x in d], d
    for _ in range(rounds):
        own, _ = nearest()
        for j in range(len(cent)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                cent[j] = [sum(c) // len(mine) for c in zip(*mine)]
    own, d = nearest() if cent else ([], [])
    return sorted(((i, o, x[o]) for (i, _), o, x in zip(kept, own, d)), key=repr), cent


def run(spark, rows, k, rounds, dim):
    got, cent, scanned = C.heap_clusters(C.integer_vectors(spark.createDataFrame(rows, SCHEMA), dim), k, rounds)
    return sorted(((r.vec_id, r.cluster, r.distance) for r in got.collect()), key=repr), cent.tolist(), scanned


@pytest.mark.parametrize("scale", [1.0, 30_000.0])
def test_equals_plain_rounds(spark, scale):
    rng = np.random.default_rng(3)
    hubs = rng.normal(size=(6, 4))
    rows = [(i, ((hubs[i % 6] + .15 * rng.normal(size=4)) * scale).tolist(), i % 3) for i in range(240)]
    rows += [(i, rows[0][1], None) for i in range(300, 340)]                  # copies
    rows += [(7, rows[9][1], 1), (8, rows[8][1], 1), (None, rows[3][1], 0), (None, rows[3][1], 0)]
    rows += [(900, None, 1), (901, [], 1), (902, [1.0] * 3, 1), (903, [1.0, None, 1.0, 1.0], 1),
             (904, [1.0, float("nan"), 1.0, 1.0], 1), (905, [1.0, float("inf"), 1.0, 1.0], 1), (906, [0.0] * 4, 1)]
    want, cent = brute(rows, 5, 6, 4)
    got, centroids, scanned = run(spark, rows, 5, 6, 4)
    assert got == want and centroids == cent
    assert scanned[0] == len(want) and sum(scanned[1:]) < 6 * len(want)       # most rounds look at a part


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 4), 0.0], 0) for i in range(24)]
    for k in (2, 3, 8):
        want, cent = brute(rows, k, 4, 2)
        got, centroids, _ = run(spark, rows, k, 4, 2)
        assert got == want and centroids == cent


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5, 1.0], 0), (2, [0.5, 1.0], 0), (None, [3.0, 1.0], 0)]
    want, cent = brute(rows, 8, 3, 2)
    assert run(spark, rows, 8, 3, 2)[:2] == (want, cent)
    assert run(spark, [(1, None, None)], 8, 3, 2) == ([], [], [])
    assert run(spark, [(5, [1.0, 2.0], None)], 1, 2, 2)[0] == [(5, 0, 0)]


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e300, 0.0], 0), (2, [1.0, 0.0], 0)], 2, 1, 2)


def test_clashing_columns_change_nothing(spark):
    rows = [(i, [float(i % 7), float(i % 5)], 0) for i in range(30)]
    d = spark.createDataFrame(rows, SCHEMA)
    for c in ("v", "cluster", "was", "key", "run", "distance"):
        d = d.withColumn(c, C.F.lit("z"))
    got = C.heap_clusters(C.integer_vectors(d, 2), 3, 3)[0]
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got.collect()), key=repr) == brute(rows, 3, 3, 2)[0]


def test_query_equals_sql(sf_tables):
    sf_tables.check("op11_centroid_clustering", C.SQL)
