"""The pipeline, stage by stage, against plain computations on each stage's input."""

import duckdb
import numpy as np
import public_tokenizers
import zlib
from tokenizers import Tokenizer

import corpus_pipeline as P
from wordloom.llm import decontam as D
from wordloom.llm import mixing as X
from wordloom.llm.common import store, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import __spark_entry__ as E
    assert [n for n, _ in P.STAGES] == ["language", "near_dedup", "decontaminate", "mix", "tokens"]
    assert E.queries()["pipeline"].__name__ == "run"
    docs = table(spark, SF, "documents")
    cols, seen = docs.columns, [docs]
    for name, stage in P.STAGES[:-1]:
        seen.append(store(stage(spark, seen[-1], SF), f"test-{name}"))
        assert seen[-1].columns == cols
    raw, lang, dedup, clean, mixed = (sorted(map(tuple, d.collect()), key=repr) for d in seen)
    text = cols.index("text")
    # Invented prose in known languages stays; texts without a letter go.
    assert {r[0] for r in raw if any(c.isalpha() for c in r[text] or "")} == {r[0] for r in lang}
    assert set(dedup) <= set(lang) and len({r[0] for r in dedup}) == len(dedup)
    from llm.test_minhash import brute
    want = brute([(r[0], r[text]) for r in lang])
    assert {r[0] for r in dedup} == {d for d, (_, c) in want.items() if c == d}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    import pyarrow as pa
    con.register("documents", pa.table({"doc_id": [r[0] for r in dedup], "text": [r[text] for r in dedup]}))
    bad = {r[0] for r in con.execute(f"SELECT doc_id FROM ({D.SQL}) WHERE contaminated").fetchall()}
    assert {r[0] for r in clean} == {r[0] for r in dedup} - bad
    taken = X.mix(seen[3].select("doc_id", "source", X.n_words("text").alias("size"))).collect()
    times = {r.doc_id: r.taken // r.size for r in taken if r.taken}
    assert sorted(r[0] for r in mixed) == sorted(d for d, n in times.items() for _ in range(n))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted(map(tuple, P.STAGES[-1][1](spark, seen[-1], SF).collect()), key=lambda r: r[1])
    start, rows = 0, []
    for d, t in sorted((r[0], r[text]) for r in mixed):
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        rows.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == rows


NAMES = "d th text_hash times rows nth size u cell score lang_pred node at target weight _th".split()


def test_stages_leave_other_columns_alone(spark):
    """Columns named like the stages' own come out as they went in."""
    from pyspark.sql import functions as F
    rows = table(spark, SF, "documents").limit(60).collect()
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    wide = store(docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in NAMES], F.lit(1).alias("a.b c")),
                 "test-wide")
    plain = docs
    for name, stage in P.STAGES[:-1]:
        wide, plain = store(stage(spark, wide, SF), "test-wide"), store(stage(spark, plain, SF), "test-plain")
        assert wide.columns == [*docs.columns, *NAMES, "a.b c"]
        got = wide.collect()
        assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in plain.collect()) and got
        assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in NAMES)


def test_empty_and_null_tables(spark):
    """No rows give no rows; rows of nulls have no language and go in the first stage."""
    schema = table(spark, SF, "documents").schema
    for rows in ([], [(None,) * len(schema)] * 3):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in P.STAGES:
            docs = store(stage(spark, docs, SF), "test-none")
            assert docs.count() == 0
