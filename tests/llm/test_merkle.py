import hashlib
import zlib

import pytest

from wordloom.llm import merkle as M


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def coded(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree(level):
    """(root, siblings with side per leaf) by plain recursion."""
    paths = [[] for _ in level]
    of = list(range(len(level)))
    while len(level) > 1:
        for i, at in enumerate(of):
            sib = level[at ^ 1] if at ^ 1 < len(level) else ""
            paths[i].append((sib, at & 1))
            of[i] = at // 2
        level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
    return level[0], paths


def brute(rows):
    leaves = {}
    for i, (doc_id, text, lang, source, n) in enumerate(rows):
        leaf = sha(coded((doc_id, source, lang, n, text)))
        leaves.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, i))
    order = sorted(leaves, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in order:
        leaves[g].sort()
        subs[g] = tree([x[2] for x in leaves[g]])
    root, tops = tree([subs[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for (_, _, leaf, i), path in zip(leaves[g], subs[g][1]):
            doc_id, text, lang, source, n = rows[i]
            acc = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n is not None:
                acc = sha(coded((doc_id, source, lang, n + 1, text)))
            for sib, left in path + top:
                acc = sha(sib + acc if left else acc + sib)
            out.append((doc_id, leaf, subs[g][0], root, sha("".join(s for s, _ in path + top)), acc, acc == root))
    return out


COLS = "doc_id long, text string, lang string, source string, n_chars long"


def manifest(spark, rows):
    d = spark.createDataFrame(rows, COLS) if not hasattr(rows, "columns") else rows
    leaves = M.store(M.document_leaves(d), "merkle-leaves")
    paths = M.merkle_paths(leaves, [M.F.asc_nulls_first("doc_id"), "leaf"], ["doc_id", "altered"])
    out = paths.withColumn("folded", M.fold(M.F.coalesce("altered", "leaf")))
    return sorted(map(repr, ((r.doc_id, r.leaf, r.subroot, r.root, sha("".join(s.sib for s in r.path)), r.folded,
                              r.folded == r.root) for r in out.collect())))


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_manifest_equals_plain_trees(spark, monkeypatch, bits):
    monkeypatch.setattr(M, "BITS", bits)
    rows = [(i, f"text {i} é\n" * (i % 4), "en", "s", 10 + i) for i in range(37)]
    rows += [(i, "x", "de", None, None) for i in range(100, 105)]
    rows += [(200, "one", "Ünd", "s", 3), (None, None, None, None, None), (7, None, None, "s", 1)]
    rows += [(3, "again", "en", "s", 1), (None, "", "en", "s", 0), (5, "text 5", "en", "s", 5), rows[5], rows[5]]
    assert manifest(spark, rows) == sorted(map(repr, brute(rows)))


def test_one_row_long_text_and_empty_table(spark):
    rows = [(14, "long " * 400_000, "en", "s", 2)]
    assert manifest(spark, rows) == sorted(map(repr, brute(rows)))
    assert manifest(spark, []) == []


def test_other_columns_change_nothing(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(5)]
    extra = spark.createDataFrame(rows, COLS)
    for c in ("g", "leaf", "p", "path", "_i", "n", "m", "levels", "altered"):
        extra = extra.withColumn(c, M.F.lit("z"))
    assert manifest(spark, extra) == manifest(spark, rows)


def test_query_equals_sql(sf_tables):
    sf_tables.check("op12_merkle_manifest", M.SQL)
