import random

import numpy as np

from wordloom.llm import minhash as M
from wordloom.llm.components import components
from wordloom.llm.shingles import minima_of_sets, keyed_words, shingle_set, U64


def brute(rows):
    """doc_id -> (n, component) by all pairs on exact shingle sets."""
    import re
    sets = []
    for d, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    comp = {d: d for d, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, (a, _) in enumerate(rows):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((find(a), find(rows[j][0])))
                comp[y] = x
    return {d: (len(s), find(d)) for (d, _), s in zip(rows, sets)}


def make(seed=0, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for g in range(n):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 40, 90]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((i, (" " if i % 2 else "\n").join(t).upper() if i % 3 else " ".join(t)))
            i += 1
    rows += [(i, ""), (i + 1, " \t\n"), (i + 2, "one two"), (i + 3, "ONE\x0btwo"), (i + 4, "é É"), (i + 5, "É é")]
    return rows


def test_equals_all_pairs(spark):
    rows = make()
    want = brute(rows)
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_open_buckets_are_finished(spark, monkeypatch):
    # A drifting family: neighbours are near, the ends are far, buckets are shared.
    rng = random.Random(3)
    t, rows = [f"x{rng.randrange(5000)}" for _ in range(120)], []
    for i in range(150):
        rows.append((i, " ".join(t)))
        t[rng.randrange(len(t))] = f"x{rng.randrange(5000)}"
    monkeypatch.setattr(M, "BLOCK", 8)
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got} == {d: c for d, (_, c) in want.items()}


def test_edges(spark):
    same = " ".join(f"a{i}" for i in range(2000))
    docs = spark.createDataFrame([(5, same, 1), (5, same, 1), (3, same, 2), (None, same, 3), (9, None, 4)],
                                 "doc_id long, text string, kept int")
    got = sorted(((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in M.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(False, 5, 1996, 3, False)] * 2 + [(False, 3, 1996, 3, True), (True, None, 1996, None, True),
                                                            (False, 9, 0, 9, True)], key=str)
    assert M.near_duplicates(docs.limit(0)).count() == 0
    kept = M.dedup_stage(spark, docs, "")
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "9", "None"]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (5000, 4999)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r.node for r in got}) == len(got) == 201 + 300 + 2
    by = {r.node: r.root for r in got}
    assert len({by[i] for i in range(201)}) == 1 and len({by[1000 + i] for i in range(300)}) == 1
    assert len(set(by.values())) == 3
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_estimate_and_minima(spark):
    a, b = keyed_words(4000, 1), np.concatenate([keyed_words(4000, 1)[:3000], keyed_words(1000, 2)])
    mins = minima_of_sets([a, np.zeros(0, U64), b], M._MULT, M._ADD, chunk=700)
    whole = minima_of_sets([a, np.zeros(0, U64), b], M._MULT, M._ADD)
    assert np.array_equal(mins, whole)
    sig = M.packed(mins)
    row = spark.createDataFrame([(sig[0].tolist(), sig[2].tolist())], "x array<long>, y array<long>")
    got = row.select(M.estimate("x", "y")).first()[0]
    same = np.mean([(int(x) & 15) == (int(y) & 15) for x, y in zip(mins[0], mins[2])])
    assert abs(got - (same - 1 / 16) / (15 / 16)) < 1e-9 and abs(got - 0.6) < 0.15


def test_shingles_of_long_texts(monkeypatch):
    from wordloom.llm import shingles as S
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = shingle_set(text)
    monkeypatch.setattr(S, "_CHUNK", 1000)
    assert np.array_equal(whole, shingle_set(text))
