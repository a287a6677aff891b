"""License scan by diagonal voting.

A template is a notice or a phrase in words.  All rolling word k-grams of the
documents are hashed and joined with the positions of the templates' k-grams
(k = GRAM, or the length of a shorter template).  A hit at document word ``pos``
and template word ``at`` lies on the diagonal ``pos - at``: the place where the
template would begin.  Hits vote for their diagonals; a diagonal that gets every
vote of its template is a place where its words stand consecutively.  Words put
in or left out move the rest of a notice to a diagonal close by, so each diagonal
is merged with its neighbours up to SLIP words away, and the merged span is
verified: it counts if its grams cover at least MIN_COVER of the template's words.
A hash only proposes a hit: its words are compared as text.

The text is read and split once.  Every document sends one mark of its own along
with its grams, which the join always keeps, so that one small written table
holds documents and hits.  The templates' grams are broadcast when their counted
rows fit the gate.  Only hits are shuffled, by document and template; a group is
at most one document's hits of one template.  There is no Python on the path.

Rows: null and empty texts have no words, no places and score 0.  Repeated rows
each get their result; a null doc_id is kept.  Long texts are scanned whole.  An
empty table gives no rows, an empty template list no labels.  Only doc_id and
text are read: other columns, whatever their names, change nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, measured_broadcast, store, table

GRAM = 3                        # words of a gram, of a template that has so many
SLIP = 4                        # words that a merged diagonal may be away
MIN_COVER = 0.8                 # share of a template's words that a verified span covers
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"                    # after lower-casing
ROW = ["d", "th"]               # a document: its id (null: least long) and its text's hash

# Phrases that count as places, and their labels.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
# Well-known notices in their published wording, and their labels.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def _words(c) -> F.Column:
    return F.filter(F.split(lower_ascii(c), _BREAKS), lambda w: w != "")


def template_grams(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """``(t, label, base, m, k, at, gram)``: every gram of every template ``t`` of
    ``m`` words; ``base`` marks phrases."""
    rows = [{"t": i, "label": label, "base": i < len(phrases), "text": text}
            for i, (label, text) in enumerate([*phrases, *notices])]
    # Literals of the plan: no Python rows to ship.
    got = spark.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps(rows)), "array<struct<t:int,label:string,base:boolean,text:string>>")))
    sized = got.withColumn("w", _words(F.col("text"))).withColumn("m", F.size("w")).where("m > 0") \
        .withColumn("k", F.least(F.col("m"), F.lit(GRAM)))
    return sized.select("t", "label", "base", "m", "k", F.posexplode(F.expr(
        "transform(sequence(0, m - k), i -> array_join(slice(w, i + 1, k), ' '))")).alias("at", "gram"))


def _start(k: int) -> F.Column:
    """The first k words of an exploded gram."""
    return F.substring_index("gram", " ", k)


def hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """``(doc_id, d, th, n, t, pos, at)``: one row with null ``t`` per document of
    ``n`` words, and one per gram hit."""
    w = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"),
                    F.xxhash64("text").alias("th"), F.coalesce(_words(F.col("text")), F.array().cast("array<string>"))
                    .alias("w"))
    tail = ", ".join(f"get(w, i + {j})" for j in range(1, GRAM))
    rolled = w.select("doc_id", *ROW, F.size("w").alias("n"), F.posexplode(F.expr(
        f"concat(array(''), if(size(w) = 0, cast(array() as array<string>), "
        f"transform(sequence(0, size(w) - 1), i -> concat_ws(' ', w[i], {tail}))))")).alias("pos", "gram"))
    found = F.array().cast("array<struct<t:int,at:int,k:int,gram:string>>")
    for k in sorted(r["k"] for r in grams.select("k").distinct().collect()):     # at most GRAM sizes
        places = grams.where(F.col("k") == k).groupBy(F.xxhash64("gram").alias(f"h{k}")).agg(
            F.collect_list(F.struct("t", "at", "k", "gram")).alias(f"p{k}"))
        rolled = rolled.join(measured_broadcast(places, 128), F.xxhash64(_start(k)) == F.col(f"h{k}"), "left")
        found = F.concat(found, F.coalesce(f"p{k}", F.array().cast("array<struct<t:int,at:int,k:int,gram:string>>")))
    own = F.col("pos") == 0                       # the document's own mark
    some = rolled.withColumn("found", found).where(own | (F.size("found") > 0))
    rows = some.select("doc_id", *ROW, "n", "pos", "gram", F.explode_outer("found").alias("x"))
    same = F.expr("substring_index(gram, ' ', x.k)")
    return rows.where(own | (same == F.col("x.gram"))).select(
        "doc_id", *ROW, "n", F.when(~own, F.col("x.t")).alias("t"), (F.col("pos") - 1).alias("pos"), "x.at")


def diagonals(found: DataFrame, grams: DataFrame) -> DataFrame:
    """``(d, th, t, diag, ats, label, base, m, k)``: the votes of every diagonal, a
    repeated row voting once."""
    votes = found.where("t is not null").groupBy(*ROW, "t", (F.col("pos") - F.col("at")).alias("diag")).agg(
        F.collect_set("at").alias("ats"))                    # at most the template's grams
    about = grams.select("t", "label", "base", "m", "k").distinct()
    return votes.join(measured_broadcast(about, 64), "t")


def merged_cover(votes: DataFrame) -> DataFrame:
    """``cover``: the share of the template's words that a diagonal and its
    neighbours cover."""
    near = Window.partitionBy(*ROW, "t").orderBy("diag").rangeBetween(-SLIP, SLIP)      # 2 * SLIP + 1 rows at most
    words = F.expr("size(array_distinct(flatten(transform(flatten(near), a -> sequence(a, a + k - 1)))))")
    return votes.withColumn("near", F.collect_list("ats").over(near)).withColumn(
        "cover", words / F.col("m")).drop("near")


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Places of phrases, labels and score per row of ``docs(doc_id, text)``."""
    grams = store(template_grams(docs.sparkSession, phrases, notices), "license-grams")
    found = store(hits(docs, grams), "license-hits")
    votes = diagonals(found, grams)
    whole = F.size("ats") == F.col("m") - F.col("k") + 1
    place = F.col("base") & whole
    spans = votes.where("base").where(whole).withColumn("cover", F.lit(1.0)).unionByName(
        merged_cover(votes.where("not base")).where(F.col("cover") >= MIN_COVER))
    per_doc = spans.groupBy(*ROW).agg(
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("diag"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("diag"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(place, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"))
    return found.where("t is null").join(per_doc, ROW, "left").select(
        "doc_id", F.col("n").cast("long").alias("n_words"), F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return scan(table(spark, sf_dir, "documents"))


def _sql_words(c: str) -> str:
    return (f"regexp_extract_all(translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


_SQL_TEMPLATES = ", ".join(f"({i}, '{label}', {i < len(PHRASES)}, '{text}')"
                           for i, (label, text) in enumerate([*PHRASES, *NOTICES]))

SQL = f"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_sql_words('text')}, []) AS w FROM documents),
tw AS (SELECT t, label, base, len(w) AS m, least(len(w), {GRAM}) AS k, w FROM (
  SELECT t, label, base, {_sql_words('text')} AS w FROM (VALUES {_SQL_TEMPLATES}) v(t, label, base, text))),
tg AS (SELECT t, k, j, array_to_string(w[j + 1 : j + k], ' ') AS gram
       FROM (SELECT t, k, w, unnest(range(m - k + 1)) AS j FROM tw)),
dg AS (SELECT r, k, pos, array_to_string(w[pos + 1 : pos + k], ' ') AS gram
       FROM (SELECT r, k, w, unnest(range(len(w) - k + 1)) AS pos FROM dw, (SELECT DISTINCT k FROM tg) WHERE len(w) >= k)),
hit AS (SELECT r, t, k, pos - j AS diag, j FROM dg JOIN tg USING (k, gram)),
place AS (SELECT r, t, diag, label FROM hit JOIN tw USING (t) WHERE base
          GROUP BY r, t, diag, label, m, tw.k HAVING count(*) = m - tw.k + 1),
span AS (SELECT r, label, 1.0::DOUBLE AS cover FROM place
         UNION ALL
         SELECT r, label, count(DISTINCT a2 + o) / m::DOUBLE AS cover FROM (
           SELECT x.r, x.t, x.diag, y.j AS a2, unnest(range(y.k)) AS o
           FROM (SELECT DISTINCT r, t, diag FROM hit) x JOIN hit y ON x.r = y.r AND x.t = y.t
             AND y.diag BETWEEN x.diag - {SLIP} AND x.diag + {SLIP}) JOIN tw USING (t) WHERE NOT base
         GROUP BY r, t, diag, label, m HAVING cover >= {MIN_COVER}),
based AS (SELECT r, count(*) AS n_base, min(diag) AS first_word, max(diag) AS last_word FROM place GROUP BY r),
bl AS (SELECT r, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT r, label FROM place) GROUP BY r),
al AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT r, label FROM span) GROUP BY r),
sc AS (SELECT r, max(cover) AS score FROM span GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM dw LEFT JOIN based USING (r) LEFT JOIN bl USING (r) LEFT JOIN al USING (r) LEFT JOIN sc USING (r)
"""
