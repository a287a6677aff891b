import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from wordloom.llm import decontam as D
from wordloom.llm import embed_dedup as V
from wordloom.llm import line_dedup as LD


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(1)
    voc = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.choice([1, 4, 13, 14, 30])))) for i in range(12)]
    items += [(12, None), (13, "..."), (None, "v1 v2 v3"), (3, items[3][1]), (14, "the " * 20), (15, "É v1")]
    docs = []
    for d in range(120):
        w = [rng.choice(voc) for _ in range(rng.choice([0, 5, 40, 200]))]
        for _ in range(rng.randint(0, 2)):
            it = words(rng.choice(items)[1])
            a = rng.randrange(len(it) + 1) if it else 0
            at = rng.randrange(len(w) + 1)
            w[at:at] = it[a:a + rng.choice([5, 13, 30])] if rng.random() < .5 else it
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(w).replace("v1", "V1")))
    docs += [(0, docs[0][1]), (500, None), (501, ""), (502, "the " * 300), (None, items[2][1]), (503, "é V1"), (504, "É v1")]
    want = []
    for d, t in docs:
        w, hit, got = words(t), set(), set()
        for i, x in items:
            iw = words(x)
            if i is None or not iw:
                continue
            n = min(13, len(iw))
            wins = {tuple(iw[s:s + n]) for s in range(len(iw) - n + 1)}
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in wins:
                    hit |= set(range(s, s + n))
                    got.add(i)
        want.append((d, len(w), len(hit), len(got), len(hit) > 0 and 20 * len(hit) >= len(w)))
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated))
                                            for r in got.collect())
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.contaminated for r in D.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), none).collect())
    assert D.contamination(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x alpha y beta z"), (2, "alpha q q q q q q beta"), (3, "beta alpha")],
                                 "doc_id long, text string")
    items = D.item_terms(spark.createDataFrame([(7, "alpha y beta")], "item_id long, text string"))
    index = D.postings(docs, items.select("term").distinct())
    index = index.union(D.postings(docs.where("doc_id = 1"), items.select("term").distinct()))
    got = {(r.d, r.gap) for r in D.proximity_matches(index.where("term <> 'y'"), items.where("term <> 'y'"), 5).collect()}
    # Distance in the item is 2; document 1 has it exactly, 2 is five further, 3 three back.
    assert got == {(1, 0), (2, 5), (3, 3)}


def near_brute(docs, items, slop):
    import re
    words = [re.findall(r"[a-z0-9]+", (t or "").lower()) for _, t in docs]
    cf = {}
    for w in words:
        for x in w:
            cf[x] = cf.get(x, 0) + 1
    out = []
    for w in words:
        n = 0
        for _, text in items:
            v = re.findall(r"[a-z0-9]+", text.lower())
            size, hit = min(13, len(v)), False
            for s in range(len(v) - size + 1 if v else 0):
                i0 = min(range(s, s + size), key=lambda i: (cf.get(v[i], 0), v[i], i))
                hit = hit or any(
                    all(any(x == v[i] and abs(p - i - (p0 - i0)) <= slop for p, x in enumerate(w)) for i in range(s, s + size))
                    for p0, x0 in enumerate(w) if x0 == v[i0])
            n += hit
        out.append(n)
    return out


def test_near_items_and_word_counts_equal_brute_force(spark):
    import random
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choices("abcdefghijklmnop", k=rnd.choice([1, 3, 13, 15, 20])))) for i in range(12)]
    docs = [(1, None), (2, ""), (3, " .,"), (4, "..a"), (5, "a b."), (6, " a  b ")]
    for k in range(40):
        w = rnd.choice(items)[1].split()
        for _ in range(k % 4):
            w.insert(rnd.randrange(len(w) + 1), rnd.choice(["zz", "b"]))
        docs.append((10 + k, "-".join([*rnd.choices("abcdefgh", k=5), *w, "end"])))
    docs += [docs[-1], (None, docs[-2][1])]
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), 2).collect()
    import re
    want = sorted((str(d), len(re.findall("[a-z0-9]+", t or "")), n) for (d, t), n in zip(docs, near_brute(docs, items, 2)))
    assert sorted((str(r.doc_id), r.n_words, r.n_near) for r in got) == want
    assert sum(n for *_, n in want) > 40


def test_decontaminate_stage_keeps_clean_rows(spark, tmp_path):
    passage = " ".join(f"p{i}" for i in range(20))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, passage, "en"), (2, "clean " * 30, "fr"), (None, None, None), (None, "x", "en")],
                                 "doc_id long, text string, lang string")
    out = D.decontaminate_stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and sorted(str(r.doc_id) for r in out.collect()) == ["2", "None", "None"]


def test_vector_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(V, "CELL", 40)
    monkeypatch.setattr(V, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for g in range(60):
        base = rng.normal(size=12)
        for _ in range(rng.integers(1, 8)):
            v = base + rng.normal(size=12) * rng.choice([0.0, 0.05, 0.12])
            rows.append((i, v.astype("float32").tolist(), int(g % 3) if g % 10 else None))
            i += 1
    rows += [(i, None, 1), (i + 1, [0.0] * 12, 1), (i + 2, [float("nan")] + [1.0] * 11, 1),
             (i + 3, [None] + [1.0] * 11, 1), (i + 4, [1.0] * 5, 1), (i + 5, [], 1), (i + 6, [float("inf")] * 12, 1)]
    rows.append(rows[0])
    got = V.links_and_components(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert got.count() == len(rows)
    good = {r[0]: r for r in rows if r[2] is not None and r[1] and all(x is not None for x in r[1])
            and np.isfinite(r[1]).all() and any(r[1])}
    links, comp = defaultdict(set), {r[0]: r[0] for r in rows}
    for a, x in good.items():
        for b, y in good.items():
            if a != b and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, v = np.array(x[1], float), np.array(y[1], float)
                if u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98:
                    links[a].add(b)
    for _ in rows:
        comp = {a: min([c] + [comp[b] for b in links[a]]) for a, c in comp.items()}
    assert sum(map(len, links.values())) > 100
    for r in got.collect():
        assert (r.n_links, r.component_id, r.kept) == (len(links[r.vec_id]), comp[r.vec_id], comp[r.vec_id] == r.vec_id)
    assert V.links_and_components(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def edit(rng, s, n):
    t = list(s)
    for _ in range(n):
        k, o = rng.randrange(len(t)), rng.random()
        if o < .4:
            t[k] = rng.choice("abcé")
        elif o < .7:
            t.insert(k, rng.choice("abc"))
        else:
            t.pop(k)
    return "".join(t)


def test_edit_distance_and_segments():
    rng = random.Random(0)
    a, b = [], []
    while len(a) < 1500:
        s = "".join(rng.choice("ab") for _ in range(rng.randint(21, 80)))
        t = edit(rng, s, rng.randint(0, 4))
        s, t = (s, t) if len(s) >= len(t) else (t, s)
        if len(s) - len(t) <= 2 and len(t) >= 20:
            a.append(s)
            b.append(t)
    want = [lev(x, y) <= 2 for x, y in zip(a, b)]
    assert LD.within_limit(a, b).tolist() == want
    assert all(LD.first_shared(y, x) >= 0 for x, y, w in zip(a, b, want) if w)


def test_long_pairs_are_compared_in_bounded_batches():
    import tracemalloc

    rng = random.Random(2)
    long = "".join(rng.choice("abcdé") for _ in range(20000))
    a = [long + "xy"] + ["a line of thirty characters %03d" % (i % 7) for i in range(1500)]
    b = [long] + ["a line of thirty characters %03d" % (i % 5) for i in range(1500)]
    want = [lev(x, y) <= 2 for x, y in zip(a[1:], b[1:])]
    tracemalloc.start()
    got = LD.within_limit(a, b).tolist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [True, *want]
    assert peak < 40 << 20                  # 1,501 pairs padded to 20,000 would be 240 MB


def test_code_points_of_a_slice():
    import pyarrow as pa

    lines = ["ab", "é\U0001f600", "", "xyz"]
    points, n = LD._code_points(pa.array(["skip", *lines, "skip"]).slice(1, 4))
    assert n.tolist() == [len(x) for x in lines]
    assert points.tolist() == [ord(c) for x in lines for c in x]


def check_lines(spark, rows, monkeypatch, limit=2, least=20):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as node", "'x' as line")
    got = LD.near_duplicate_lines(docs, limit, least).collect()
    lines = [(d, n, x) for d, t in rows if t is not None for n, x in enumerate(t.split("\n"))]
    assert sorted((r.doc_id, r.line_no) for r in got) == sorted((d, n) for d, n, _ in lines)
    text = {(d, n): x for d, n, x in lines}
    kinds = sorted(set(text.values()))
    links = {x: {y for y in kinds if y != x and min(len(x), len(y)) >= least and abs(len(x) - len(y)) <= limit
                 and lev(x, y) <= limit} for x in kinds}
    comp = {x: i for i, x in enumerate(kinds)}
    for _ in kinds:
        comp = {x: min([c] + [comp[y] for y in links[x]]) for x, c in comp.items()}
    first = {}
    for at, x in sorted(text.items()):
        first.setdefault(comp[x], at)
    seen = {}
    for r in got:
        x = text[r.doc_id, r.line_no]
        assert r.n_links == len(links[x]), (x, links[x])
        assert seen.setdefault(r.component_id, comp[x]) == comp[x]
        assert r.kept == (first[comp[x]] == (r.doc_id, r.line_no))
    assert len(seen) == len(set(comp.values()))


def test_lines_equal_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    lines = ["", "a", "short", "short"]
    for _ in range(25):
        s = "".join(rng.choice("abc ") for _ in range(rng.choice([19, 21, 25, 60])))
        lines += [edit(rng, s, rng.randint(0, 3)) for _ in range(rng.choice([1, 2, 4]))]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i::12])) for i in range(12)] + [(50, None), (51, "")]
    check_lines(spark, rows, monkeypatch)
    check_lines(spark, rows, monkeypatch, limit=3, least=15)


def test_lines_of_one_hash_are_told_apart(spark, monkeypatch):
    """Every two lines share their first 64 bits with another one: the second 64 decide."""
    split = LD.split_lines

    def colliding(docs):
        return split(docs).withColumn("node", F.xxhash64(F.length("line") % 2, F.substring("line", 1, 3)))

    monkeypatch.setattr(LD, "split_lines", colliding)
    kinds = ["abcd" + c * 24 for c in "mnop"]
    near = ["xyz" + k[3:] for k in kinds[:2]] + ["uvw" + kinds[0][3:]]
    rows = [(i, t) for i, t in enumerate([*kinds, *near, "abcd" + "m" * 22 + "..", "pqr" + "m" * 25])]
    got = {r.doc_id: r for r in LD.near_duplicate_lines(
        spark.createDataFrame(rows, "doc_id long, text string"), limit=3).collect()}
    text = dict(rows)
    for d, r in got.items():
        assert r.n_links == sum(lev(text[d], t) <= 3 and split_key(t) != split_key(text[d]) for t in text.values()), text[d]
        assert r.kept or any(lev(text[d], t) <= 3 for e, t in text.items() if e < d)


def split_key(t):
    return len(t) % 2, t[:3]


def test_hot_segments_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(LD, "HOT", 5)
    monkeypatch.setattr(LD, "BLOCK", 7)
    rng = random.Random(6)
    stem = "the same long beginning of every line number "
    rows = [(i, "\n".join(stem + str(rng.randrange(3000)) for _ in range(6))) for i in range(10)]
    check_lines(spark, rows, monkeypatch)
    out = LD.drop_near_duplicate_lines(spark.createDataFrame(rows + [(77, stem * 2)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in out}[77] == stem * 2


def test_line_keys_are_counted_without_a_window(spark, monkeypatch):
    plans, keep = {}, LD.store

    def store(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(LD, "store", store)
    stem = "the same long beginning of every line number "
    check_lines(spark, [(i, "\n".join(stem + str(1000 + 6 * i + k) for k in range(6))) for i in range(8)], monkeypatch)
    assert "hot-keys" in plans and not any("Window" in p for p in plans.values())


def test_tables(sf_tables):
    sf_tables.check("op10_decontamination", D.SQL)
