import hashlib

import pytest
from pyspark.sql import functions as F

from wordloom.llm import chat as C
from wordloom.llm import mixing as X


def test_water_fill_clamps_and_reshares(spark):
    rows = [(10, 3.0), (1000, 1.0), (1000, 2.0), (0, 5.0)]
    got = X.water_fill(spark.createDataFrame(rows, "source_size long, weight double"), 1500.0, 2).collect()
    by = {(r.source_size, r.weight): r.target for r in got}
    assert by[10, 3.0] == 20 and by[0, 5.0] == 0
    assert abs(by[1000, 1.0] - 1480 / 3) < 1e-9 and abs(by[1000, 2.0] - 2960 / 3) < 1e-9


def test_mix_meets_targets(spark):
    rows = [(i, f"s{i % 7}" if i % 11 else None, (i * 37) % 300) for i in range(3000)] + [(1, "s1", 37)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = X.mix(docs).collect()
    assert len(got) == len(rows)
    total = sum(r[2] for r in rows)
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * total) < 1e-6 * total
    for s in {r.source for r in got}:
        mine = [r for r in got if r.source == s]
        assert mine[0].source_size == sum(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 300 / 2
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)
    again = X.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_edges_and_stage(spark):
    docs = spark.createDataFrame([(1, None, "a", None), (2, "x y", "a", "p"), (2, "x y", "a", "p"),
                                  (None, "u v w", None, "q"), (4, "  ", "b", "r")],
                                 "doc_id long, text string, lang string, source string").selectExpr(
        "doc_id", "text", "lang", "source", "1L as size")
    out = X.mix_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert all(r.text.strip() for r in out.collect())
    assert X.mix(spark.createDataFrame([], "doc_id long, source string, size long")).count() == 0


def conv(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def expect(rows):
    by = {}
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (len(v), sha("".join(f"{r}\n{x}\n" for r, x in v)), sum(len(x) for r, x in v if r == "assistant"),
                sha("".join(x for r, x in v if r == "assistant"))) for c, v in by.items()}


@pytest.mark.parametrize("budget", [40, 400])
def test_windows_round_trip(spark, budget):
    nasty = "a\\b <|turn|>x<|text|> <\\| </s>[INST] \\[INST] [\\/INST] <s> \\\\<|end|>\n\n"
    rows = [(c, t, ["system", "user", "assistant"][0 if t == 0 and c % 2 else 1 + t % 2], nasty * (t % 3) + "w " * (c * t))
            for c in range(4) for t in range(30)]
    rows += [(9, 0, None, None), (9, 1, "assistant", None), (9, 1, "assistant", None), (None, None, "user", "x"),
             (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (8, 600, "a<|b", "é" * 50)]
    w = C.format_windows(conv(spark, rows), budget, 10, 6)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(w).collect()}
    assert got == expect(rows)
    stride = (budget - 16) // 2
    for r in w.collect():
        turns = r.formatted.split(C.TURN)[1:]
        assert len(turns) > r.n_repeated and all(t.endswith(C.END) and t.count(C.END) == 1 for t in turns)
        if r.conv_id in (1, 3):
            assert turns[0].startswith("system") and r.window == 0 or turns[0].startswith("system")
        longest = max(len(t.split()) + 3 for t in turns)
        assert r.n_tokens <= budget or longest > stride or r.conv_id in (1, 3)


def test_long_system_turns_keep_the_budget(spark):
    rows = [(c, t, "system" if t == 0 else ["user", "assistant"][t % 2], "w " * (n if t == 0 else 20 + t % 5))
            for c, n in enumerate([1, 126, 200, 500, 690]) for t in range(40)]
    rows += [(9, 0, "system", "w " * 2000), (9, 1, "assistant", "ok ok"), (9, 2, "user", "x")]
    w = C.format_windows(conv(spark, rows), 1024, 256)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(w).collect()}
    assert got == expect(rows)
    seen = w.collect()
    assert all(r.n_tokens <= 1024 for r in seen if r.conv_id != 9)
    # A system turn that leaves no room: one own turn a window.
    assert sorted(len(r.formatted.split(C.TURN)) - 1 - r.n_repeated for r in seen if r.conv_id == 9) == [1, 1, 1]


def test_token_counts_of_the_caller(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", "one") for t in range(12)]
    df = conv(spark, rows).withColumn("my count", F.when(F.col("turn") != 3, 30).cast("int"))
    w = C.format_windows(df, 200, 20, 0, tokens="my count").collect()
    assert sum(len(r.formatted.split(C.TURN)) - 1 - r.n_repeated for r in w) == 12
    assert len(w) == 4 and all(r.n_tokens <= 200 for r in w)


def test_repeats_are_limited_and_masked(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"t{t} " * 5) for t in range(40)]
    w = C.format_windows(conv(spark, rows), 60, 20, 4).orderBy("window").collect()
    assert len(w) > 5 and all(r.n_repeated >= 1 for r in w[1:])
    learned = [r.formatted[s.start:s.start + s.length] for r in w for s in r.loss]
    assert learned == [f"t{t} " * 5 for t in range(1, 40, 2)]
    assert C.digests(C.format_windows(conv(spark, []))).count() == 0


def test_oracles(spark, sf_tables):
    sf_tables.check("op5_mixing", X.SQL)
    sf_tables.check("op8_chat_format", C.SQL)
