"""Benchmark decontamination on a positional inverted index.

Index: one posting ``(document, term, position)`` per training token whose term
occurs in the benchmark, written once (dictionary-coded columns).

Exact phrases, a window being 13 consecutive words of an item (a shorter item is
one window):

1. corpus counts of the terms come from the index; a window with a term that
   never occurs is dropped, every other names its two rarest terms;
2. postings of those terms, shifted by the term's place in its item, are
   alignments ``(document, item, delta)``; only alignments that two lists
   agree on go on (one list for one-word items);
3. at these, the lists of all terms of the item are intersected, and every run
   of matching places at least as long as a window is an occurrence.

Proximity: a window is near a place if every one of its terms stands there within
``slop`` words of its place in the item.  The shifted lists of its two rarest terms,
joined within that distance, name the places; the lists of all its terms verify them.
Items with a near window (an exact one is near, too) are counted as ``n_near``.

The postings also carry one marker row per document with its number of words, so that
texts are read and split once.

All of it is joins and partially aggregated groupings; there is no Python on
the path.  Benchmark-sized tables are broadcast when their counted rows fit the
gate; otherwise the same joins shuffle.  A common passage or a hot document
costs its own postings, never pairs of documents.

Rows: null or wordless texts have no words and no hits.  Items without an id or
without words are ignored; repeated items count once.  Repeated documents each
get the same result; a null doc_id is kept (the least 64-bit integer stands for it, and
counts as null).  Empty tables work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns_of, free_names, lower_ascii, measured_broadcast, store, table

WINDOW = 13
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"                    # after lower-casing
MARK = "#"                   # a break between words, so no term holds it
SLOP = 2                     # words a term of a near window may be off
NO_ID = -(1 << 63)           # stands for a null doc_id
DOC = ["d", "th"]            # a document row: its id (null: least long) and its text's hash


def _words(c) -> F.Column:
    return F.split(lower_ascii(c), _BREAKS)


def _doc_key(df: DataFrame, d: str = "d", th: str = "th") -> DataFrame:
    return df.withColumns({d: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                           th: F.xxhash64("text")})


def item_terms(items: DataFrame) -> DataFrame:
    """``(item, item_id, i, term, m)``: the words of every item with an id."""
    rows = items.where(F.col("item_id").isNotNull()).select(
        "item_id", F.filter(_words(F.col("text")), lambda w: w != "").alias("w")).distinct()
    return rows.select(F.xxhash64("item_id", "w").alias("item"), "item_id", F.size("w").alias("m"),
                       F.posexplode("w").alias("i", "term"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(d, th, pos, term)`` of every token whose term is in ``terms(term)``, and of
    every document's marker (:func:`word_counts`)."""
    words = F.coalesce(_words(F.col("text")), F.array(F.lit("")))
    tokens = _doc_key(docs.select("doc_id", "text")).select(*DOC, words.alias("w"))
    # A split's first and last piece may be empty: the marker says how many are.
    empty = (F.element_at("w", 1) == "").cast("int") + (
        (F.size("w") > 1) & (F.element_at("w", -1) == "")).cast("int")
    tokens = tokens.select(*DOC, F.posexplode(F.concat("w", F.array(F.repeat(F.lit(MARK), empty + 1)))).alias("pos", "term"))
    marks = docs.sparkSession.range(1, 4).select(F.expr(f"repeat('{MARK}', cast(id as int))").alias("term"))
    return tokens.join(measured_broadcast(terms.select("term").union(marks), 64), "term").select(*DOC, "pos", "term")


def word_counts(index: DataFrame) -> DataFrame:
    """``(d, th, n_words)``, one row per document row, from the markers."""
    return index.where(F.col("term").startswith(MARK)).select(
        *DOC, (F.col("pos") + 1 - F.length("term")).cast("long").alias("n_words"))


def rarest(terms: DataFrame, index: DataFrame) -> DataFrame:
    """Per window ``(item, s)``: the places ``i`` and terms of its two rarest
    terms, ``nth`` 1 and 2.  Windows with an absent term are left out."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    known = terms.join(counts, "term", "left").na.fill(0, ["cf"])
    size = F.least(F.col("m"), F.lit(WINDOW))
    places = known.withColumn("s", F.explode(F.sequence(
        F.greatest(F.col("i") - size + 1, F.lit(0)), F.least(F.col("i"), F.col("m") - size))))
    w = Window.partitionBy("item", "s")
    ranked = places.select("item", "item_id", "m", "s", "i", "term", "cf",
                           F.min("cf").over(w).alias("least"),
                           F.row_number().over(w.orderBy("cf", "term", "i")).alias("nth"))
    return ranked.where("least > 0 and nth <= 2").select("item", "item_id", "m", "s", "i", "term", "nth")


def alignments(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """``(d, th, item, delta)`` at which two anchor lists of an item agree."""
    lists = anchors.select("item", "m", "i", "term").distinct()
    shifted = index.join(measured_broadcast(lists, 96), "term").select(
        *DOC, "item", (F.col("pos") - F.col("i")).alias("delta"), "i", "m")
    # First and last agreeing place say whether two lists met, and combine map-side.
    met = shifted.groupBy(*DOC, "item", "delta").agg(
        F.min("i").alias("i0"), F.max("i").alias("i1"), F.first("m").alias("m"))
    return met.where("i0 < i1 or m = 1").select(*DOC, "item", "delta")


def phrase_matches(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``(d, th, item_id, pos)``: every document word inside an occurrence."""
    found = store(alignments(index, rarest(terms, index)), "alignments")
    here = index.join(measured_broadcast(found.select(*DOC).distinct(), 32), DOC).distinct()
    wanted = found.join(measured_broadcast(terms, 96), "item").withColumn("pos", F.col("delta") + F.col("i"))
    matched = wanted.join(here, [*DOC, "pos", "term"])
    at = Window.partitionBy(*DOC, "item", "delta").orderBy("i")
    runs = matched.withColumn("run", F.col("i") - F.row_number().over(at))
    whole = Window.partitionBy(*DOC, "item", "delta", "run")
    return runs.withColumn("n", F.count(F.lit(1)).over(whole)) \
        .where(F.col("n") >= F.least(F.col("m"), F.lit(WINDOW))).select(*DOC, "item_id", "pos")


def proximity_matches(index: DataFrame, terms: DataFrame, slop: int) -> DataFrame:
    """``(d, th, item_id, s, delta, gap)``: windows (from place ``s`` of their item) all of
    whose terms stand within ``slop`` words of ``delta`` plus their place in the item;
    ``delta`` is taken from the rarest term, ``gap`` is how far off the worst term is."""
    a = rarest(terms, index)
    shifted = index.join(measured_broadcast(a, 96), "term").select(
        *DOC, "item", "item_id", "s", "m", "nth", (F.col("pos") - F.col("i")).alias("delta"))
    cell = F.floor(F.col("delta") / F.lit(slop + 1))
    one = shifted.where("nth = 1").withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    two = shifted.where("nth = 2").select(*DOC, "item", "s", cell.alias("cell"), F.col("delta").alias("other"))
    here = [*DOC, "item", "item_id", "s", "m", "delta"]
    near = one.where("m > 1").join(two, [*DOC, "item", "s", "cell"]) \
        .where(F.abs(F.col("delta") - F.col("other")) <= slop).select(*here) \
        .union(shifted.where("nth = 1 and m = 1").select(*here)).distinct()
    near = store(near, "near-places")
    # The lists of all terms: an interval of 2 * slop + 1 places meets at most two cells.
    width = 2 * slop + 1
    size = F.least(F.col("m"), F.lit(WINDOW))
    wanted = near.join(measured_broadcast(terms.select("item", "i", "term").distinct(), 64), "item") \
        .where((F.col("i") >= F.col("s")) & (F.col("i") < F.col("s") + size)) \
        .withColumn("place", F.col("delta") + F.col("i")) \
        .withColumn("cell", F.explode(F.array_distinct(F.array(
            F.floor((F.col("place") - slop) / F.lit(width)), F.floor((F.col("place") + slop) / F.lit(width))))))
    lists = index.join(measured_broadcast(near.select(*DOC).distinct(), 32), DOC) \
        .select(*DOC, "pos", "term", F.floor(F.col("pos") / F.lit(width)).alias("cell")).distinct()
    off = F.abs(F.col("pos") - F.col("place"))
    each = wanted.join(lists, [*DOC, "term", "cell"], "left").groupBy(*here, "i").agg(
        F.min(F.when(off <= slop, off)).alias("off"))
    return each.groupBy(*here).agg(F.max("off").alias("gap"), F.every(F.col("off").isNotNull()).alias("whole")) \
        .where("whole").select(*DOC, "item_id", "s", "delta", "gap")


def contamination(docs: DataFrame, items: DataFrame, slop: int | None = None) -> DataFrame:
    """Per row of ``docs``: words, words hit, items that occur, and the verdict
    (``d``, ``th``: the row's key); with ``slop``, also the items that are near."""
    terms = store(item_terms(items), "item-terms")
    index = store(postings(docs, terms.select("term").distinct()), "postings")
    hits = phrase_matches(index, terms)
    per_doc = hits.groupBy(*DOC).agg(
        F.size(F.collect_set("pos")).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    out = word_counts(index).withColumn("doc_id", F.when(F.col("d") != NO_ID, F.col("d"))).join(per_doc, DOC, "left")
    near = []
    if slop is not None:
        out = out.join(proximity_matches(index, terms, slop).groupBy(*DOC).agg(
            F.countDistinct("item_id").alias("near")), DOC, "left")
        near = [F.coalesce("near", F.lit(0)).cast("long").alias("n_near")]
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), *near, *DOC)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), SLOP).drop(*DOC)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go."""
    key = free_names(docs, *DOC)
    bad = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(*DOC).distinct()
    return _doc_key(docs, *key).join(bad.toDF(*key), key, "left_anti").select(*columns_of(docs))


_SQL_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_SQL_WORDS}, []) AS w FROM documents),
iw AS (SELECT DISTINCT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT r, n, s, array_to_string(w[s : s + n - 1], ' ') AS g
          FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, sizes WHERE len(w) >= n)),
occ AS (SELECT r, s, n, item_id FROM grams JOIN win USING (n, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY r),
toks AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS term FROM dw),
cf AS (SELECT term, count(*) AS cf FROM toks GROUP BY 1),
wt AS (SELECT q, item_id, s, i, w[i] AS term FROM (
         SELECT q, item_id, w, s, unnest(range(s, s + least(len(w), 13))) AS i FROM (
           SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM (
             SELECT row_number() OVER () AS q, * FROM iw WHERE len(w) > 0)))),
rk AS (SELECT wt.*, row_number() OVER (PARTITION BY q, s ORDER BY coalesce(cf, 0), term, i) AS nth,
              count(*) OVER (PARTITION BY q, s) AS n FROM wt LEFT JOIN cf USING (term)),
pl AS (SELECT DISTINCT q, item_id, s, n, t.r, t.p - rk.i AS delta FROM rk JOIN toks t USING (term) WHERE nth = 1),
near AS (SELECT r, count(DISTINCT item_id) AS n_near FROM (
           SELECT pl.q, pl.s, pl.r, pl.delta, pl.item_id FROM pl JOIN wt ON wt.q = pl.q AND wt.s = pl.s
           JOIN toks t ON t.r = pl.r AND t.term = wt.term AND abs(t.p - wt.i - pl.delta) <= {SLOP}
           GROUP BY ALL HAVING count(DISTINCT wt.i) = any_value(pl.n)) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near
FROM dw LEFT JOIN hit USING (r) LEFT JOIN its USING (r) LEFT JOIN near USING (r)
"""
