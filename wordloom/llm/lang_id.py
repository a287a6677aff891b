"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

* Features: letters folded to lower case, every run of other characters one
  boundary; 1-, 2- and 3-grams of the whole text hashed into ``BUCKETS``.
* Statistics: document frequencies over *all* training rows (one vector per
  task leaves a worker), documents per language likewise.
* Training: follow-the-regularised-leader (proximal) with L1 and L2 penalties, in
  mini-batches, on a keyed sample of training rows.  The sample is the one bounded
  part: about ``TRAIN_ROWS`` rows in all, at least ``MIN_PER_LANG`` per language
  (or all there are), spread evenly over languages.
* Calibration: a temperature fitted on the fifth of the sample that training
  does not see, by golden-section search on the log loss.
* Prediction: every whole text in Arrow batches against the model (languages x
  BUCKETS floats; a language list beyond ``MAX_LANGS`` is an error).

Training rows have a non-null language and crc32(doc_id) mod 4 other than 2.
Language, source and id are never inputs of a prediction.

Rows: a null text, or one without a letter, is ``und`` with score 0.  Without any
training row every text is ``und``.  Ties go to the first language by code point.
Empty tables give empty results; repeated rows predict alike; other columns pass
through (a column named like a result is replaced).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import bounded, columns_of, free_names, table

BUCKETS = 1 << 15
ORDERS = 3
TRAIN_ROWS = 6_000
MIN_PER_LANG = 50
MAX_LANGS = 1_000
HELD_OUT = 2                 # crc32(doc_id) mod 4
EPOCHS, BATCH = 3, 16
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.001
MIN_SCORE = 0.3              # pipeline: less sure than this is rejected
CHUNK = 1 << 20              # characters folded at once: bounds memory on very long texts
UND = "und"


@lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """Code point -> its lower-case letter, 0 for anything that is no letter."""
    t = np.zeros(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            t[c] = ord(low) if len(low) == 1 else c
    return t


def ngram_buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram occurrence of the whole text; empty without a letter."""
    fold, parts, tail = _fold_table(), [], np.zeros(1, dtype=np.uint32)
    for a in range(0, len(text), CHUNK):
        cps = np.frombuffer(text[a:a + CHUNK].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        f = np.concatenate([tail, fold[cps]])
        if a + CHUNK >= len(text):
            f = np.append(f, np.uint32(0))
        keep = np.ones(len(f), dtype=bool)
        keep[1:] = (f[1:] != 0) | (f[:-1] != 0)
        f = f[keep].astype(np.uint64)
        # The last two symbols begin the next chunk's n-grams.
        parts.append((f, len(tail) if a else 0))
        tail = f[-2:].astype(np.uint32)
    out = []
    for f, seen in parts:
        if not f.any():
            continue
        g = np.zeros(len(f), dtype=np.uint64)
        for n in range(1, ORDERS + 1):
            g = f.copy() if n == 1 else g[:-1] * np.uint64(0x1F123BB5) + f[n - 1:]
            new = g[max(0, seen - n + 1):] if seen else g
            h = (new + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
            out.append((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 15))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, dtype=np.int64)


def training_row(doc_id: str = "doc_id", lang: str = "lang") -> Column:
    return F.col(lang).isNotNull() & ~held_out(doc_id)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray        # (BUCKETS, langs), the inverse document frequency folded in
    idf: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for t in texts:
            b = ngram_buckets(t) if t else ()
            if not len(b) or not self.langs:
                names.append(UND)
                scores.append(0.0)
                continue
            idx, tf = tf_vector(b)
            v = tf * self.idf[idx]
            v /= np.sqrt((v * v).sum())
            z = (v @ self.weights[idx] + self.bias) / self.temperature
            p = np.exp(z - z.max())
            best = int(np.argmax(p))
            names.append(self.langs[best])
            scores.append(float(p[best] / p.sum()))
        return names, scores


def tf_vector(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(buckets, minlength=BUCKETS)
    idx = np.flatnonzero(n)
    return idx, 1.0 + np.log(n[idx])


def _df_of_task(batches):
    df = np.zeros(BUCKETS, dtype=np.int64)
    for b in bounded(batches, 0):
        for t in b.column(0).to_pylist():
            if t:
                df[np.unique(ngram_buckets(t))] += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["bucket", "n"])


def _sample_features(batches):
    for b in bounded(batches, 2):
        rows = [tf_vector(ngram_buckets(t)) if t else ((), ()) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).cast(pa.string()), b.column(1),
             pa.array([r[0] for r in rows], pa.list_(pa.int64())),
             pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["key", "lang", "idx", "tf"])


def train_ftrl(X: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS, k) and bias (k).  ``X``: (bucket indexes, values) per row."""
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def weights(zs, ns):
        w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2)
        return np.where(np.abs(zs) <= L1, 0.0, w)

    order = np.random.default_rng(5)
    for _ in range(EPOCHS):
        turn = order.permutation(len(X))
        for a in range(0, len(turn), BATCH):
            rows = turn[a:a + BATCH]
            idx = np.concatenate([np.append(X[r][0], BUCKETS) for r in rows])
            val = np.concatenate([np.append(X[r][1], 1.0) for r in rows])
            of = np.repeat(np.arange(len(rows)), [len(X[r][0]) + 1 for r in rows])
            used, place = np.unique(idx, return_inverse=True)
            w = weights(z[used], n[used])
            logit = np.zeros((len(rows), k))
            contrib = val[:, None] * w[place]
            for c in range(k):
                logit[:, c] = np.bincount(of, contrib[:, c], minlength=len(rows))
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1.0
            g = np.empty((len(used), k))
            for c in range(k):
                g[:, c] = np.bincount(place, val * p[of, c], minlength=len(used))
            sigma = (np.sqrt(n[used] + g * g) - np.sqrt(n[used])) / ALPHA
            z[used] += g - sigma * w
            n[used] += g * g
    w = weights(z, n)
    return w[:BUCKETS], w[BUCKETS]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm.

    Targets are smoothed by one row per other language, so that a sample without
    an error still has a finite best temperature.
    """
    n, k = logits.shape
    if not n or k < 2:
        return 1.0
    target = np.full((n, k), 1.0 / (n + k))
    target[np.arange(n), y] = 1 - (k - 1) / (n + k)

    def loss(log_t):
        s = logits / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - (target * s).sum(axis=1)).mean())

    g, lo, hi = (5 ** 0.5 - 1) / 2, -3.0, 3.0
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _fit_task(langs: list[str], idf: np.ndarray):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf["idx"].map(len) > 0].sort_values(["key", "lang"], kind="stable").reset_index(drop=True)
        y = pdf["lang"].map({l: i for i, l in enumerate(langs)}).to_numpy(dtype=np.int64)
        X = []
        for i, tf in zip(pdf["idx"], pdf["tf"]):
            v = np.asarray(tf) * idf[np.asarray(i)]
            X.append((np.asarray(i), v / np.sqrt((v * v).sum())))
        calib = np.arange(len(X)) % 5 == 4
        own = np.flatnonzero(~calib)
        w, bias = train_ftrl([X[r] for r in own], y[own], len(langs)) if len(own) else \
            (np.zeros((BUCKETS, len(langs))), np.zeros(len(langs)))
        rest = np.flatnonzero(calib)
        logits = np.array([X[r][1] @ w[X[r][0]] + bias for r in rest]).reshape(len(rest), len(langs))
        at, of = np.nonzero(w)
        out = pd.DataFrame({"bucket": at, "lang": of, "weight": w[at, of]})
        extra = pd.DataFrame({"bucket": [-1] * len(langs) + [-2], "lang": [*range(len(langs)), 0],
                              "weight": [*bias, fit_temperature(logits, y[rest])]})
        return pd.concat([out, extra], ignore_index=True)
    return run


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, max_langs: int = MAX_LANGS) -> Model:
    """Fit on the training rows of ``docs(doc_id, text, lang)``."""
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").where(training_row())
    # Languages are a bounded list: more than max_langs of them is an error.
    per = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(max_langs + 1).collect()
    if len(per) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs, n_docs = [r["lang"] for r in per], sum(r["n"] for r in per)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.ones(BUCKETS), np.zeros(0), 1.0)
    df = np.zeros(BUCKETS)
    for r in rows.select("text").mapInArrow(_df_of_task, "bucket long, n long").groupBy("bucket") \
            .agg(F.sum("n").alias("n")).collect():          # at most BUCKETS rows
        df[r["bucket"]] = r["n"]
    idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0
    each = max(MIN_PER_LANG, train_rows // len(langs))
    rate = F.create_map(*[x for r in per for x in (F.lit(r["lang"]), F.lit(min(1.0, each / r["n"])))])
    dice = F.pmod(F.xxhash64(F.lit(99), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(dice < F.element_at(rate, F.col("lang"))).select("doc_id", "lang", "text") \
        .mapInArrow(_sample_features, "key string, lang string, idx array<long>, tf array<double>")
    got = sample.groupBy(F.lit(1).alias("one")).applyInPandas(
        _fit_task(langs, idf), "bucket long, lang long, weight double").collect()
    w, bias, temperature = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs)), 1.0
    for r in got:                                            # at most BUCKETS * langs rows
        if r["bucket"] >= 0:
            w[r["bucket"], r["lang"]] = r["weight"]
        elif r["bucket"] == -1:
            bias[r["lang"]] = r["weight"]
        else:
            temperature = r["weight"]
    return Model(langs, w, idf, bias, temperature)


def predict(docs: DataFrame, model: Model, text_col: str = "text", pred: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``docs`` with the columns ``pred`` and ``score`` added (or put in place of its own)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(pred, score)
    rest, at = rows.columns, rows.columns.index(text_col)
    # Plain names on the way through Arrow, whatever the table's are.
    plain = [f"c{i}" for i in range(len(rest))]
    rows = rows.toDF(*plain)

    def run(batches):
        for b in bounded(batches, at):
            names, scores = held.value.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*plain, "pred", "score"])
    schema = StructType([*rows.schema.fields, StructField("pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema).toDF(*rest, pred, score)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without a language, or with an unsure one, go."""
    pred, score = free_names(docs, "lang_pred", "score")
    return predict(docs, train(docs), pred=pred, score=score).where(
        (F.col(pred) != UND) & (F.col(score) >= MIN_SCORE)).select(*columns_of(docs))
