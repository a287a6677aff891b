import random
import re

from wordloom.llm import license_scan as L


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, phrases=L.PHRASES, notices=L.NOTICES):
    w = words(text)
    starts, base, labels, score = [], set(), set(), 0.0
    for label, phrase in phrases:
        p = words(phrase)
        at = [i for i in range(len(w) - len(p) + 1) if p and w[i:i + len(p)] == p]
        starts += at
        if at:
            base.add(label)
            labels.add(label)
            score = 1.0
    for label, notice in notices:
        t = words(notice)
        k = min(3, len(t))
        found = [(i - j, j) for i in range(len(w) - k + 1) for j in range(len(t) - k + 1) if w[i:i + k] == t[j:j + k]]
        for d in {d for d, _ in found}:
            cover = len({j + o for e, j in found if abs(e - d) <= 4 for o in range(k)}) / len(t)
            if cover >= 0.8:
                labels.add(label)
                score = max(score, cover)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def got(spark, rows, **kw):
    d = spark.createDataFrame(rows, "doc_id long, text string") if isinstance(rows, list) else rows
    return sorted(repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score))
                  for r in L.scan(d, **kw).collect())


def texts():
    rng = random.Random(5)
    out = [None, "", " ... ", "cc", "CC BY", "cc-by cc\nBY", "x all rights reserved. All Rights Reserved",
           "ALL RIGHTS reserved " * 40, "General Public License general public", "É cc by É", "general public licenses"]
    plain = [f"w{i}" for i in range(30)] + ["license", "under", "the", "public", "software", "cc", "by"]
    for _ in range(60):
        w = [rng.choice(plain) for _ in range(rng.choice([0, 5, 60]))]
        for _ in range(rng.randint(1, 3)):
            n = words(rng.choice(L.NOTICES + L.PHRASES)[1])
            for _ in range(rng.choice([0, 0, 1, 2, 6])):                       # edits
                at = rng.randrange(len(n))
                n[at:at + rng.choice([0, 1])] = rng.choice([[], ["odd"], ["two", "odd"]])
            at = rng.randrange(len(w) + 1)
            w[at:at] = n
        out.append(rng.choice([" ", ", ", "\n"]).join(w))
    return out


def test_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    rows += [rows[5], rows[5], rows[30], (None, rows[30][1]), (None, None), (4, "other all rights reserved")]
    assert got(spark, rows) == sorted(repr((i, *brute(t))) for i, t in rows)


def test_notices_and_near_misses(spark):
    rows = [(1, "Released under the MIT License."), (2, "Released under the terms of a treaty."),
            (3, "Licensed under CC BY-NC 4.0."),
            (4, "Permission is hereby granted, wholly free of charge, to any person obtaining copies of this "
                "software and associated documentation files")]
    by = {r.doc_id: (r.base_labels, r.labels) for r in
          L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert by == {1: ("", "mit"), 2: ("", ""), 3: ("cc-by", "cc-by,cc-by-nc"), 4: ("", "mit")}


def test_long_text_other_templates_and_empty_table(spark):
    rows = [(1, "a b c d e " * 60_000 + "one two"), (2, "b")]
    kw = {"phrases": [("pair", "one two"), ("one", "b"), ("five", "b c d e a")], "notices": [("n", "e one two")]}
    assert got(spark, rows, **kw) == sorted(repr((i, *brute(t, **kw))) for i, t in rows)
    none = {"phrases": [("x", "...")], "notices": []}
    assert got(spark, rows[1:], **none) == [repr((2, 1, 0, None, None, "", "", 0.0))]
    assert got(spark, spark.createDataFrame([], "doc_id long, text string")) == []


def test_clashing_columns_change_nothing(spark):
    rows = list(enumerate(texts()[:20]))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("d", "th", "w", "n", "t", "gram", "pos", "at", "label"):
        d = d.withColumn(c, L.F.lit("z"))
    assert got(spark, d) == got(spark, rows)


def test_query_equals_sql(sf_tables):
    sf_tables.check("op13_license_scan", L.SQL)
