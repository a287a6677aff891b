import math

import pytest
from pyspark.sql import functions as F

from wordloom.functions import vectors as VX
from wordloom.operators import serving as S


def emb_df(spark, rows):
    return spark.createDataFrame(rows, "idx bigint, word string, vec array<float>")


def cos(spark, a, b):
    df = spark.createDataFrame([([float(x) for x in a], [float(x) for x in b])], "a array<float>, b array<float>")
    return df.select(VX.cosine("a", "b").alias("c")).first()["c"]


def test_cosine_cases(spark):
    assert abs(cos(spark, [1, 2, 3], [1, 2, 3]) - 1) < 1e-5
    assert abs(cos(spark, [1, 0], [-1, 0]) + 1) < 1e-5
    assert abs(cos(spark, [1, 0], [0, 1])) < 1e-5
    assert cos(spark, [0, 0], [1, 0]) == 0.0


def test_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    got = [r["n"] for r in df.select(VX.normalize("v").alias("n")).collect()]
    assert abs(math.hypot(*got[0]) - 1) < 1e-5
    assert got[1] == [0.0, 0.0]


@pytest.fixture
def small(spark):
    rows = [(0, "a", [1.0, 0.0, 0.0]), (1, "b", [0.9, 0.1, 0.0]), (2, "c", [0.0, 1.0, 0.0]),
            (3, "d", [0.9, 0.1, 0.0]), (4, "e", [-1.0, 0.0, 0.0]), (5, "z", [0.0, 0.0, 0.0])]
    return emb_df(spark, rows)


def test_most_similar_excludes_query_sorted_ties_by_id(spark, small):
    q = spark.createDataFrame([("a",), ("nope",)], "word string")
    res = S.most_similar(q, small, 3).orderBy("rank").collect()
    assert [r["word"] for r in res] == ["b", "d", "c"]
    assert all(r["query"] == "a" for r in res)
    assert res[0]["similarity"] == res[1]["similarity"]


def test_k_larger_than_vocabulary(spark, small):
    q = spark.createDataFrame([("c",)], "word string")
    res = S.most_similar(q, small, 50).collect()
    assert len(res) == 5
    sims = [r["similarity"] for r in sorted(res, key=lambda r: r["rank"])]
    assert sims == sorted(sims, reverse=True)


def test_similarity_symmetric_and_oov(spark, small):
    pairs = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "q")], "word_a string, word_b string")
    got = {(r["word_a"], r["word_b"]): r for r in S.pair_similarity(pairs, small).collect()}
    assert abs(got[("a", "b")]["similarity"] - got[("b", "a")]["similarity"]) < 1e-12
    assert got[("a", "q")]["is_oov"] and got[("a", "q")]["similarity"] is None
    with pytest.raises(S.UnknownWordError):
        S.pair_similarity(pairs, small, strict=True)


def test_analogy_excludes_terms(spark, small):
    t = spark.createDataFrame([("a", "c", "b")], "pos_a string, neg_a string, pos_b string")
    res = S.analogy(t, small, 3).collect()
    assert len(res) == 3 and not {"a", "b", "c"} & {r["word"] for r in res}
    bad = spark.createDataFrame([("a", "nope", "b")], "pos_a string, neg_a string, pos_b string")
    with pytest.raises(S.UnknownWordError):
        S.analogy(bad, small, 3, strict=True)


def test_block_top_k_matches_brute_force(spark, monkeypatch):
    import random
    rnd = random.Random(5)
    rows = [(i, f"w{i}", [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    emb = emb_df(spark, rows)
    monkeypatch.setattr(S, "QUERY_BLOCK_ROWS", 17)
    monkeypatch.setattr(S, "CAND_BLOCK_ROWS", 41)
    q = emb.select("word").where(F.col("idx") % 3 == 0)
    got = {(r["query"], r["rank"]): r["word"] for r in S.most_similar(q, emb, 4).collect()}

    def c(a, b):
        d = sum(x * y for x, y in zip(a, b))
        return d / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(y * y for y in b)))
    vecs = {w: [float(x) for x in v] for _, w, v in [(r[0], r[1], r[2]) for r in emb.collect()]}
    for i in range(0, 300, 3):
        qw = f"w{i}"
        best = sorted(((-c(vecs[qw], v), int(w[1:])) for w, v in vecs.items() if w != qw))[:4]
        for rank, (_, j) in enumerate(best, 1):
            assert got[(qw, rank)] == f"w{j}"


def test_text_vectors_header(spark, small):
    lines = S.text_vectors(small, 3).orderBy("line_no").collect()
    assert lines[0]["line"] == "6 3"
    assert lines[1]["line"] == "a 1.000000 0.000000 0.000000"


def test_six_decimals_keep_sign_and_round_half_even(spark):
    values = [-1e-7, 0.0078125, -0.0078125, 0.0234375, -0.0, 0.0, 1.5, -123456.5, 2.5e-6, 3.4e38, float("nan")]
    df = spark.createDataFrame([([float(v) for v in values],)], "vec array<float>")
    got = df.select(F.transform("vec", S.six_decimals).alias("x")).first()["x"]
    import numpy as np
    assert got[:9] == ["%.6f" % float(np.float32(v)) for v in values[:9]]
    assert got[10] == "NaN"


def test_analogy_flags_unknown_words_once(spark, small):
    t = spark.createDataFrame([("a", "b", "c"), ("a", "b", "nope"), ("a", "b", "nope"), ("a", "b", "c")],
                              "pos_a string, neg_a string, pos_b string")
    res = S.analogy(t, small, 2).collect()
    assert [r["word"] for r in res if r["is_oov"]] == [None]
    assert len([r for r in res if not r["is_oov"]]) == 2


def test_scan_and_blocks_agree(spark, small, monkeypatch):
    q = small.select("word")
    scan = sorted(map(tuple, S.most_similar(q, small, 3).collect()))
    monkeypatch.setattr(S, "SMALL_QUERIES", 0)
    assert scan == sorted(map(tuple, S.most_similar(q, small, 3).collect()))


def clustered(n, groups, dim=8, seed=3):
    import numpy as np
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    x = centre[np.arange(n) % groups] + 0.05 * rng.normal(size=(n, dim))
    return x.astype(np.float32)


def brute(x, queries, excl, k):
    import numpy as np
    x, q = x.astype(np.float64), queries.astype(np.float64)
    nx, nq = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        s = (q @ x.T) / np.outer(nq, nx)
    s[(nq < VX.COSINE_NORM_FLOOR)[:, None] | (nx < VX.COSINE_NORM_FLOOR)[None, :]] = 0.0
    out = []
    for i in range(len(q)):
        ids = [j for j in np.lexsort((np.arange(len(x)), -np.round(s[i], 9))) if j not in excl[i]][:k]
        out.append([(int(j), round(float(s[i, j]), 6)) for j in ids])
    return out


def test_cells_skip_most_blocks_and_stay_exact(spark):
    from wordloom.operators import nearest as N
    x = clustered(1200, 24)
    x[7], x[8], x[600] = 0.0, 0.0, x[601]                    # too short ones, and a tie
    emb = emb_df(spark, [(i, f"w{i}", [float(v) for v in r]) for i, r in enumerate(x)])
    q = emb.select(F.col("idx").alias("qid"), F.col("word").alias("qname"),
                   F.col("vec").cast("array<double>").alias("qvec"), F.array("idx").alias("excl"))
    visits, cands, _, _ = N.plan_visits(q, emb, 5, 1200, 64, 50)
    met = visits.count()
    blocks = cands.select("cell", "blk").distinct().count()
    assert blocks >= 24 and met < 0.3 * 1200 * blocks
    got = S.top_k_cosine(q, emb, 5).collect()
    want = brute(x, x, [{i} for i in range(len(x))], 5)
    by = {}
    for r in got:
        by.setdefault(r["qid"], {})[r["rank"]] = (r["idx"], round(r["similarity"], 6))
    for i, w in enumerate(want):
        mine = [by[i][rank] for rank in range(1, 6)]
        assert [s for _, s in mine] == pytest.approx([s for _, s in w], abs=2e-6)
        assert mine == w or len({s for _, s in w}) < 5


def test_cells_with_small_blocks_equal_one_block(spark, monkeypatch):
    x = clustered(400, 7, seed=9)
    x[5] = 0.0
    emb = emb_df(spark, [(i, f"w{i}", [float(v) for v in r]) for i, r in enumerate(x)])
    words = emb.select("word")

    def rows():
        return sorted((r["query"], r["word"], round(r["similarity"], 6), r["rank"])
                      for r in S.most_similar(words, emb, 6).collect())
    whole = rows()
    monkeypatch.setattr(S, "QUERY_BLOCK_ROWS", 13)
    monkeypatch.setattr(S, "CAND_BLOCK_ROWS", 9)
    assert rows() == whole and len(whole) == 400 * 6


def test_cells_of_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(S, "SMALL_QUERIES", 0)
    none = emb_df(spark, [])
    q = spark.createDataFrame([("a",)], "word string")
    assert S.most_similar(q, none, 3).count() == 0
    zero = emb_df(spark, [(0, "a", [0.0, 0.0]), (1, "b", [0.0, 0.0]), (2, "c", None)])
    assert [tuple(r) for r in S.most_similar(q, zero, 3).collect()] == [("a", "b", 0.0, 1)]
    same = emb_df(spark, [(i, f"w{i}", [1.0, 2.0]) for i in range(30)])
    got = S.most_similar(same.select("word"), same, 2).collect()
    assert len(got) == 60
