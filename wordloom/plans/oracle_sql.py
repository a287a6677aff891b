"""DuckDB SQL for each registered query (same parameters as catalog.py).

Written independently of the Spark code: tokens by regex, vocabulary by
row_number, ranges by window sums, windows by band self-joins, model math by
unnesting vectors into one row per dimension.
"""

from __future__ import annotations

from ..functions.rng import uniform_sql
from . import catalog as Q

R6 = "(CAST(floor(CAST({x} AS DOUBLE) * 1000000.0 + 0.5) AS DOUBLE) / 1000000.0)"


def r6(x: str) -> str:
    return R6.format(x=x)


LINES = r"""
lines AS (
  SELECT doc_id,
         CAST(unnest(generate_series(0, len(arr) - 1)) AS INTEGER) AS line_no,
         unnest(arr) AS line
  FROM (SELECT doc_id,
               CASE WHEN len(a) > 0 AND a[-1] = '' THEN a[1:len(a) - 1] ELSE a END AS arr
        FROM (SELECT doc_id, string_split_regex(text, '\r?\n') AS a FROM documents))
)"""

CONV_LINES = r"""
conv_lines AS (
  SELECT doc_id,
         CAST(unnest(generate_series(0, len(arr) - 1)) AS INTEGER) AS line_no,
         unnest(arr) AS line
  FROM (SELECT doc_id,
               CASE WHEN len(a) > 0 AND a[-1] = '' THEN a[1:len(a) - 1] ELSE a END AS arr
        FROM (SELECT conv_id * 1048576 + turn AS doc_id,
                     string_split_regex(text, '\r?\n') AS a FROM conversations))
)"""

SPLIT_WS = r"list_filter(string_split_regex({x}, '[\t-\r \x{{85}}\p{{Z}}]+'), lambda w: w <> '')"


def split_ws(x: str) -> str:
    return SPLIT_WS.format(x=x)


TOKENS = f"""
tokens AS (
  SELECT doc_id, line_no,
         CAST(unnest(generate_series(0, len(t) - 1)) AS INTEGER) AS pos,
         unnest(t) AS word
  FROM (SELECT doc_id, line_no, {split_ws('line')} AS t FROM lines)
)"""


def vocab_cte(min_count: int, name: str = "vocab") -> str:
    return f"""
{name} AS (
  SELECT CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS BIGINT) AS idx, word, cnt
  FROM (SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM tokens GROUP BY word)
  WHERE cnt >= {int(min_count)}
)"""


def dist_cte(vocab: str = "vocab") -> str:
    return f"""
pw AS (SELECT idx, pow(CAST(cnt AS DOUBLE), 0.75) AS w FROM {vocab}),
cum AS (SELECT idx, w,
               sum(w) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ci
        FROM pw),
tw AS (SELECT max(ci) AS t FROM cum),
dist AS MATERIALIZED (SELECT idx, w / t AS p,
                coalesce(lag(ci) OVER (ORDER BY idx), 0.0) / t AS lo,
                ci / t AS hi
         FROM cum, tw)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


MC = Q.CHECK_MIN_COUNT


def _noise_table_sql(shifted: bool) -> str:
    word = "d.idx" if not shifted else "least(d.idx + 1, (SELECT count(*) FROM vocab) - 1)"
    return with_(LINES, TOKENS, vocab_cte(MC), dist_cte()) + f""",
slots AS (SELECT CAST(range AS BIGINT) AS slot, CAST(range + 1 AS DOUBLE) / 1000000.0 AS th
          FROM range(1000000)),
tab AS (SELECT s.slot, CAST({word} AS BIGINT) AS idx
        FROM slots s JOIN dist d ON s.th > d.lo AND s.th <= d.hi)
SELECT idx, CAST(count(*) AS BIGINT) AS slots, min(slot) AS first_slot FROM tab GROUP BY idx"""


ORACLES = {
    "corpus_lines": with_(LINES) + " SELECT doc_id, line_no, line FROM lines",
    "tokenize": with_(LINES, TOKENS) + " SELECT doc_id, line_no, pos, word FROM tokens",
    "nonblank_lines": with_(LINES) + f" SELECT doc_id, line_no, line FROM lines WHERE len({split_ws('line')}) > 0",
    "word_count": with_(LINES, TOKENS) + " SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM tokens GROUP BY word",
    "vocab": with_(LINES, TOKENS, vocab_cte(1)) + " SELECT idx, word, cnt FROM vocab",
    "vocab_min_count": with_(LINES, TOKENS, vocab_cte(MC)) + " SELECT idx, word, cnt FROM vocab",
    "vocab_stats": with_(LINES, TOKENS, vocab_cte(MC)) +
        " SELECT CAST(count(*) AS BIGINT) AS vocab_size, CAST(coalesce(sum(cnt), 0) AS BIGINT) AS total_tokens FROM vocab",
    "word_count_lookup": with_(LINES, TOKENS, vocab_cte(1), CONV_LINES) + f""",
asked AS (SELECT DISTINCT unnest({split_ws('line')}) AS word FROM conv_lines)
SELECT a.word, CAST(coalesce(v.cnt, 0) AS BIGINT) AS cnt FROM asked a LEFT JOIN vocab v ON a.word = v.word""",
    "words": with_(LINES, TOKENS, vocab_cte(MC)) + " SELECT word FROM vocab",
    "top_frequent_words": with_(LINES, TOKENS, vocab_cte(1)) + " SELECT idx, word, cnt FROM vocab WHERE idx < 50",
    "keep_probability": with_(LINES, TOKENS, vocab_cte(MC)) + f""",
tot AS (SELECT CAST(sum(cnt) AS DOUBLE) AS n FROM vocab)
SELECT idx, word, {r6(f"least(1.0, sqrt({Q.CHECK_SUBSAMPLE!r} / (cnt / n)) + {Q.CHECK_SUBSAMPLE!r} / (cnt / n))")} AS keep
FROM vocab, tot""",
    "noise_distribution": with_(LINES, TOKENS, vocab_cte(MC), dist_cte()) +
        f" SELECT idx, {r6('p')} AS p, {r6('lo')} AS lo, {r6('hi')} AS hi FROM dist",
    "noise_table": _noise_table_sql(False),
    "noise_table_shifted": _noise_table_sql(True),
}


# ---------------------------------------------------------------- slice 3

SEED, EPOCH, WIN, K = Q.CHECK_SEED, Q.CHECK_EPOCH, Q.CHECK_WINDOW, Q.CHECK_NEGATIVES
TH = repr(Q.CHECK_SUBSAMPLE)


def u(purpose: str, *keys: str) -> str:
    return uniform_sql(purpose, SEED, EPOCH, *keys)


ENC = """
enc AS MATERIALIZED (SELECT t.doc_id, t.line_no, t.pos, v.idx, v.cnt FROM tokens t JOIN vocab v ON t.word = v.word),
tot AS (SELECT CAST(sum(cnt) AS DOUBLE) AS n FROM vocab)"""

SUB = f"""
sub AS (SELECT e.doc_id, e.line_no, e.pos, e.idx FROM enc e, tot
        WHERE {u('sub', 'e.doc_id', 'e.line_no', 'e.pos')}
              < least(1.0, sqrt({TH} / (CAST(e.cnt AS DOUBLE) / tot.n)) + {TH} / (CAST(e.cnt AS DOUBLE) / tot.n))),
ren AS (SELECT doc_id, line_no, idx,
               CAST(row_number() OVER (PARTITION BY doc_id, line_no ORDER BY pos) - 1 AS INTEGER) AS p,
               count(*) OVER (PARTITION BY doc_id, line_no) AS n
        FROM sub),
sent AS MATERIALIZED (SELECT doc_id, line_no, idx, p, n FROM ren WHERE n >= 2)"""

WINS = f"""
win AS MATERIALIZED (SELECT doc_id, line_no, p, idx AS center,
               CAST(1 + floor({u('win', 'doc_id', 'line_no', 'p')} * {WIN}) AS INTEGER) AS win
        FROM sent),
pairs AS MATERIALIZED (SELECT w.doc_id, w.line_no, w.p, w.center, s.p AS q, s.idx AS context
          FROM win w JOIN sent s ON s.doc_id = w.doc_id AND s.line_no = w.line_no
           AND s.p BETWEEN w.p - w.win AND w.p + w.win AND s.p <> w.p)"""

NEGS = f"""
draws AS (SELECT w.doc_id, w.line_no, w.p, CAST(s.slot AS INTEGER) AS slot,
                 {u('neg', 'w.doc_id', 'w.line_no', 'w.p', 's.slot')} AS u
          FROM win w, (SELECT range AS slot FROM range({K})) s),
negs AS MATERIALIZED (SELECT d.doc_id, d.line_no, d.p, d.slot, x.idx AS neg
         FROM draws d JOIN dist x ON d.u >= x.lo AND d.u < x.hi)"""

BASE3 = with_(LINES, TOKENS, vocab_cte(MC), ENC)

EST = """
est AS (SELECT CAST(coalesce(sum(greatest(c - 1, 0)), 0) * 10 AS BIGINT) AS estimate
        FROM (SELECT doc_id, line_no, count(*) AS c FROM enc GROUP BY doc_id, line_no))"""

LR0, LRMIN = Q.CHECK_LR, 0.0001

ORACLES.update({
    "encode_tokens": BASE3 + " SELECT doc_id, line_no, pos, idx FROM enc",
    "subsample": BASE3 + "," + SUB + " SELECT doc_id, line_no, pos, idx FROM sub",
    "encoded_sentences": BASE3 + "," + SUB + """
SELECT doc_id, line_no, CAST(count(*) AS BIGINT) AS n, string_agg(CAST(idx AS VARCHAR), ' ' ORDER BY p) AS t
FROM sent GROUP BY doc_id, line_no""",
    "dynamic_windows": BASE3 + "," + SUB + "," + WINS + " SELECT doc_id, line_no, p, center, win FROM win",
    "context_pairs": BASE3 + "," + SUB + "," + WINS + """
SELECT doc_id, line_no, p, center,
       CAST(row_number() OVER (PARTITION BY doc_id, line_no, p ORDER BY q) - 1 AS INTEGER) AS ci, context
FROM pairs""",
    "negative_samples": BASE3 + "," + SUB + "," + WINS + "," + dist_cte() + "," + NEGS +
        " SELECT doc_id, line_no, p, slot, neg FROM negs",
    "training_examples": BASE3 + "," + SUB + "," + WINS + "," + dist_cte() + "," + NEGS + """,
ctx AS (SELECT doc_id, line_no, p, any_value(center) AS center,
               string_agg(CAST(context AS VARCHAR), ' ' ORDER BY q) AS context
        FROM pairs GROUP BY doc_id, line_no, p),
ng AS (SELECT doc_id, line_no, p, string_agg(CAST(neg AS VARCHAR), ' ' ORDER BY slot) AS negatives
       FROM negs GROUP BY doc_id, line_no, p)
SELECT c.doc_id, c.line_no, c.p, c.center, c.context, n.negatives
FROM ctx c JOIN ng n USING (doc_id, line_no, p)""",
    "estimate_pairs": BASE3 + "," + EST + " SELECT estimate FROM est",
    "lr_schedule": BASE3 + "," + SUB + "," + WINS + "," + EST + f""",
ordd AS (SELECT doc_id, line_no, p,
                CAST(row_number() OVER (ORDER BY {u('shuf', 'doc_id', 'line_no')}, doc_id, line_no, p) - 1 AS BIGINT) AS step
         FROM win)
SELECT doc_id, line_no, p, step,
       {r6(f"greatest({LRMIN!r}, {LR0!r} - {(LR0 - LRMIN)!r} * (CAST(step AS DOUBLE) / CAST((SELECT estimate FROM est) * {Q.CHECK_EPOCHS} AS DOUBLE)))")} AS lr
FROM ordd""",
    "epoch_shuffle": with_(LINES) + f"""
SELECT doc_id, line_no,
       CAST(row_number() OVER (ORDER BY {u('shuf', 'doc_id', 'line_no')}, doc_id, line_no) - 1 AS BIGINT) AS ord
FROM lines WHERE len({split_ws('line')}) > 0""",
})


# ---------------------------------------------------------------- slice 4

EMB = """
emb AS (SELECT CAST(vec_id AS BIGINT) AS idx, CAST(vec_id AS VARCHAR) AS word,
               CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"""


def cos_sql(a: str, b: str) -> str:
    na = f"sqrt(list_dot_product({a}, {a}))"
    nb = f"sqrt(list_dot_product({b}, {b}))"
    return (f"(CASE WHEN {na} < 1e-8 OR {nb} < 1e-8 THEN 0.0 "
            f"ELSE greatest(-1.0, least(1.0, list_dot_product({a}, {b}) / ({na} * {nb}))) END)")


def norm_vec_sql(v: str) -> str:
    n = f"sqrt(list_dot_product({v}, {v}))"
    return f"(CASE WHEN {n} < 1e-8 THEN {v} ELSE list_transform({v}, lambda x: x / {n}) END)"


LONG = """
SELECT {keys}, CAST(j AS INTEGER) AS j, {val} AS val
FROM (SELECT *, unnest(generate_series(0, len({vec}) - 1)) AS j FROM {src})"""


def _topk_sql(queries: str, k: int, q_cols: str) -> str:
    """queries CTE must give (qkey cols..., qvec, e1, e2, e3) with e* excluded ids."""
    return f"""
sc AS (SELECT {q_cols}, e.word, e.idx, {cos_sql('q.qvec', 'e.vec')} AS sim
       FROM {queries} q JOIN emb e ON e.idx <> q.e1 AND e.idx <> q.e2 AND e.idx <> q.e3),
rk AS (SELECT *, row_number() OVER (PARTITION BY {q_cols.replace('q.', '')} ORDER BY sim DESC, idx) AS rank FROM sc)"""


ORACLES.update({
    "embedding_stats": with_(EMB) +
        " SELECT CAST(count(*) AS BIGINT) AS vocab_size, CAST(max(len(vec)) AS INTEGER) AS embedding_dim FROM emb",
    "get_vectors": with_(EMB) + f""",
asked AS (SELECT CAST(idx + 1 AS VARCHAR) AS word FROM emb),
got AS (SELECT a.word, e.vec FROM asked a LEFT JOIN emb e ON a.word = e.word)
SELECT word, true AS found, CAST(j AS INTEGER) AS j, {r6('vec[j + 1]')} AS val
FROM (SELECT word, vec, unnest(generate_series(0, len(vec) - 1)) AS j FROM got WHERE vec IS NOT NULL)
UNION ALL
SELECT word, false AS found, CAST(NULL AS INTEGER) AS j, CAST(NULL AS DOUBLE) AS val FROM got WHERE vec IS NULL""",
    "vector_norms": with_(EMB) + f" SELECT idx, word, {r6('sqrt(list_dot_product(vec, vec))')} AS norm FROM emb",
    "normalize_vectors": with_(EMB) + f""",
nv AS (SELECT idx, {norm_vec_sql('vec')} AS vec FROM emb)
SELECT idx, CAST(j AS INTEGER) AS j, {r6('vec[j + 1]')} AS val
FROM (SELECT idx, vec, unnest(generate_series(0, len(vec) - 1)) AS j FROM nv)""",
    "pair_similarity": with_(EMB) + f""",
pairs AS (SELECT word AS word_a, CAST(idx + 1 AS VARCHAR) AS word_b FROM emb)
SELECT p.word_a, p.word_b,
       CASE WHEN a.vec IS NULL OR b.vec IS NULL THEN NULL ELSE {r6(cos_sql('a.vec', 'b.vec'))} END AS similarity,
       (a.vec IS NULL OR b.vec IS NULL) AS is_oov
FROM pairs p LEFT JOIN emb a ON p.word_a = a.word LEFT JOIN emb b ON p.word_b = b.word""",
    "most_similar": with_(EMB) + """,
qs AS (SELECT word AS query, vec AS qvec, idx AS e1, idx AS e2, idx AS e3 FROM emb),""" +
        _topk_sql("qs", Q.CHECK_TOP_K, "q.query") + f"""
SELECT query, word, {r6('sim')} AS similarity, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= {Q.CHECK_TOP_K}""",
    "analogy": with_(EMB) + f""",
tr AS (SELECT a.word AS pos_a, b.word AS neg_a, c.word AS pos_b,
              {norm_vec_sql('list_transform(list_zip(a.vec, b.vec, c.vec), lambda t: t[1] - t[2] + t[3])')} AS qvec,
              a.idx AS e1, b.idx AS e2, c.idx AS e3
       FROM emb a JOIN emb b ON b.idx = a.idx + 1 JOIN emb c ON c.idx = a.idx + 2),""" +
        _topk_sql("tr", 5, "q.pos_a, q.neg_a, q.pos_b") + f"""
SELECT pos_a, neg_a, pos_b, word, {r6('sim')} AS similarity, CAST(rank AS INTEGER) AS rank, false AS is_oov
FROM rk WHERE rank <= 5
UNION ALL
SELECT CAST(a.idx AS VARCHAR), CAST(a.idx + 1 AS VARCHAR), CAST(a.idx + 2 AS VARCHAR), NULL, NULL, NULL, true
FROM emb a LEFT JOIN emb b ON b.idx = a.idx + 1 LEFT JOIN emb c ON c.idx = a.idx + 2
WHERE b.idx IS NULL OR c.idx IS NULL""",
    "neighbor_sample": with_(EMB) + """,
qs AS (SELECT word AS query, vec AS qvec, idx AS e1, idx AS e2, idx AS e3 FROM emb ORDER BY word LIMIT 5),""" +
        _topk_sql("qs", 5, "q.query") + f"""
SELECT query, word, {r6('sim')} AS similarity, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 5""",
    "vector_means": with_(EMB) + f"""
SELECT CAST(j AS INTEGER) AS j, {r6('avg(vec[j + 1])')} AS mean
FROM (SELECT vec, unnest(generate_series(0, len(vec) - 1)) AS j FROM emb) GROUP BY j""",
    "centered_vectors": with_(EMB) + f""",
lf AS (SELECT idx, j, vec[j + 1] AS x FROM (SELECT idx, vec, unnest(generate_series(0, len(vec) - 1)) AS j FROM emb)),
mn AS (SELECT j, avg(x) AS m FROM lf GROUP BY j)
SELECT idx, CAST(lf.j AS INTEGER) AS j, {r6('x - m')} AS val FROM lf JOIN mn USING (j)""",
    "text_vectors": with_(EMB) + f"""
SELECT CAST(0 AS BIGINT) AS line_no, CAST(count(*) AS VARCHAR) || ' ' || '64' AS line FROM emb
UNION ALL
SELECT CAST(idx + 1 AS BIGINT) AS line_no,
       word || ' ' || array_to_string(list_transform(vec, lambda x: printf('%.6f', x)), ' ') AS line
FROM emb""",
})


# ---------------------------------------------------------------- slice 5

import math  # noqa: E402

DIM = Q.CHECK_DIM
R_INIT = repr(math.sqrt(6.0 / DIM))
R5 = "(CAST(floor(CAST({x} AS DOUBLE) * 100000.0 + 0.5) AS DOUBLE) / 100000.0)"


def r5(x: str) -> str:
    return R5.format(x=x)


def init_u(purpose: str) -> str:
    return uniform_sql(purpose, SEED, "v.idx", "r.j")


def weights_cte(out_hash: bool) -> str:
    wo = (f"CAST((2.0 * {init_u('init_out')} - 1.0) * {R_INIT} AS FLOAT)" if out_hash
          else "CAST(0.0 AS FLOAT)")
    return f"""
wl AS (SELECT v.idx, CAST(r.j AS INTEGER) AS j,
              CAST((2.0 * {init_u('init')} - 1.0) * {R_INIT} AS FLOAT) AS wi, {wo} AS wo
       FROM vocab v, (SELECT range AS j FROM range({DIM})) r),
w AS MATERIALIZED (SELECT idx, list(CAST(wi AS DOUBLE) ORDER BY j) AS w_in, list(CAST(wo AS DOUBLE) ORDER BY j) AS w_out
      FROM wl GROUP BY idx)"""


def closs(score: str, label: str) -> str:
    sp_pos = f"(greatest(-({score}), 0.0) + ln(1.0 + exp(-abs({score}))))"
    sp_neg = f"(greatest({score}, 0.0) + ln(1.0 + exp(-abs({score}))))"
    return f"(CASE WHEN {label} = 1 THEN least(30.0, {sp_pos}) ELSE least(30.0, {sp_neg}) END)"


STEP_BASE = (BASE3 + "," + SUB + "," + WINS + "," + dist_cte() + "," + NEGS + "," + weights_cte(True))

SG = f""",
tg AS (SELECT doc_id, line_no, p, center, q, context AS target, 1 AS label FROM pairs
       UNION ALL
       SELECT pr.doc_id, pr.line_no, pr.p, pr.center, pr.q, n.neg AS target, 0 AS label
       FROM pairs pr JOIN negs n ON n.doc_id = pr.doc_id AND n.line_no = pr.line_no AND n.p = pr.p
       WHERE n.neg <> pr.context),
sc AS (SELECT t.*, list_dot_product(a.w_in, b.w_out) AS score, a.w_in AS v_c, b.w_out AS v_t
       FROM tg t JOIN w a ON a.idx = t.center JOIN w b ON b.idx = t.target),
sc2 AS MATERIALIZED (SELECT *, 1.0 / (1.0 + exp(-score)) - label AS g, {closs('score', 'label')} AS loss FROM sc)"""

SG_GRADS = """,
gr AS (SELECT 'in' AS matrix, center AS idx, CAST(r.j AS INTEGER) AS j, sum(g * v_t[r.j + 1]) AS grad
       FROM sc2, (SELECT range AS j FROM range({dim})) r GROUP BY center, r.j
       UNION ALL
       SELECT 'out' AS matrix, target AS idx, CAST(r.j AS INTEGER) AS j, sum(g * v_c[r.j + 1]) AS grad
       FROM sc2, (SELECT range AS j FROM range({dim})) r GROUP BY target, r.j)""".format(dim=DIM)

LR = Q.CHECK_LR
APPLY = f""",
nw AS (SELECT l.idx, l.j,
              CASE WHEN gi.grad IS NULL THEN l.wi ELSE CAST(l.wi + ({-LR!r}) * gi.grad AS FLOAT) END AS w_in,
              CASE WHEN go.grad IS NULL THEN l.wo ELSE CAST(l.wo + ({-LR!r}) * go.grad AS FLOAT) END AS w_out
       FROM wl l
       LEFT JOIN gr gi ON gi.matrix = 'in' AND gi.idx = l.idx AND gi.j = l.j
       LEFT JOIN gr go ON go.matrix = 'out' AND go.idx = l.idx AND go.j = l.j)
SELECT idx, j, {r5('w_in')} AS w_in, {r5('w_out')} AS w_out FROM nw"""

CB = f""",
hl AS (SELECT pr.doc_id, pr.line_no, pr.p, CAST(r.j AS INTEGER) AS j, avg(w.w_in[r.j + 1]) AS h,
              count(*) AS n_ctx
       FROM pairs pr JOIN w ON w.idx = pr.context, (SELECT range AS j FROM range({DIM})) r
       GROUP BY pr.doc_id, pr.line_no, pr.p, r.j),
hv AS (SELECT doc_id, line_no, p, any_value(n_ctx) AS n_ctx, list(h ORDER BY j) AS h
       FROM hl GROUP BY doc_id, line_no, p),
tg AS (SELECT doc_id, line_no, p, center, center AS target, 1 AS label FROM win
       UNION ALL
       SELECT x.doc_id, x.line_no, x.p, x.center, n.neg AS target, 0 AS label
       FROM win x JOIN negs n ON n.doc_id = x.doc_id AND n.line_no = x.line_no AND n.p = x.p
       WHERE n.neg <> x.center),
sc AS (SELECT t.*, hv.h, hv.n_ctx, list_dot_product(hv.h, b.w_out) AS score, b.w_out AS v_t
       FROM tg t JOIN hv ON hv.doc_id = t.doc_id AND hv.line_no = t.line_no AND hv.p = t.p
       JOIN w b ON b.idx = t.target),
sc2 AS MATERIALIZED (SELECT *, 1.0 / (1.0 + exp(-score)) - label AS g, {closs('score', 'label')} AS loss FROM sc)"""

CB_GRADS = f""",
ghl AS (SELECT doc_id, line_no, p, any_value(n_ctx) AS n_ctx, CAST(r.j AS INTEGER) AS j, sum(g * v_t[r.j + 1]) AS gh
        FROM sc2, (SELECT range AS j FROM range({DIM})) r GROUP BY doc_id, line_no, p, r.j),
gr AS (SELECT 'out' AS matrix, target AS idx, CAST(r.j AS INTEGER) AS j, sum(g * h[r.j + 1]) AS grad
       FROM sc2, (SELECT range AS j FROM range({DIM})) r GROUP BY target, r.j
       UNION ALL
       SELECT 'in' AS matrix, pr.context AS idx, gl.j, sum((1.0 / CAST(gl.n_ctx AS DOUBLE)) * gl.gh) AS grad
       FROM pairs pr JOIN ghl gl ON gl.doc_id = pr.doc_id AND gl.line_no = pr.line_no AND gl.p = pr.p
       GROUP BY pr.context, gl.j)"""

ORACLES.update({
    "init_weights": with_(LINES, TOKENS, vocab_cte(MC)) + "," + weights_cte(False) +
        f" SELECT idx, j, {r6('wi')} AS w_in, {r6('wo')} AS w_out FROM wl",
    "sgns_pair_loss": STEP_BASE + SG + f"""
SELECT doc_id, line_no, p, {r6('sum(loss)')} AS loss, CAST(count(*) AS BIGINT) AS n_targets
FROM sc2 GROUP BY doc_id, line_no, p""",
    "sgns_gradient": STEP_BASE + SG + SG_GRADS + f" SELECT matrix, idx, j, {r5('grad')} AS grad FROM gr",
    "sgns_step": STEP_BASE + SG + SG_GRADS + APPLY,
    "epoch_loss": STEP_BASE + SG + f""",
el AS (SELECT doc_id, line_no, p, sum(loss) AS loss FROM sc2 GROUP BY doc_id, line_no, p)
SELECT CAST(count(*) AS BIGINT) AS centers,
       {r5('CASE WHEN count(*) = 0 THEN 0.0 ELSE sum(loss) / count(*) END')} AS avg_loss FROM el""",
    "cbow_context_mean": STEP_BASE + CB + f"""
SELECT doc_id, line_no, p, CAST(n_ctx AS BIGINT) AS n_ctx, j, {r6('h')} AS h FROM hl""",
    "cbow_loss": STEP_BASE + CB + f"""
SELECT doc_id, line_no, p, {r6('sum(loss)')} AS loss, CAST(count(*) AS BIGINT) AS n_targets
FROM sc2 GROUP BY doc_id, line_no, p""",
    "cbow_gradient": STEP_BASE + CB + CB_GRADS + f" SELECT matrix, idx, j, {r5('grad')} AS grad FROM gr",
    "cbow_step": STEP_BASE + CB + CB_GRADS + APPLY,
})

ORACLES["noise_distribution_shifted"] = with_(LINES, TOKENS, vocab_cte(MC), dist_cte()) + f"""
SELECT d.idx,
       {r6("CASE WHEN d.idx = 0 THEN 0.0 WHEN d.idx = (SELECT max(idx) FROM dist) THEN q.p + d.p ELSE q.p END")} AS p
FROM dist d LEFT JOIN dist q ON q.idx = d.idx - 1"""

ORACLES["conversation_lines"] = with_(CONV_LINES) + " SELECT doc_id, line_no, line FROM conv_lines"


# ------------------------------------------------ slice 6-7: training and PCA

import re  # noqa: E402

CAP, EPOCHS = Q.TRAIN_CFG.merge_cap, Q.TRAIN_EPOCHS
R3 = "(CAST(floor(CAST({x} AS DOUBLE) * 1000.0 + 0.5) AS DOUBLE) / 1000.0)"

# Updates per row of a matrix in one round.
SG_COUNTS = """,
gn AS (SELECT 'in' AS matrix, center AS idx, sum(label) AS n FROM sc2 GROUP BY center
       UNION ALL SELECT 'out', target, count(*) FROM sc2 GROUP BY target)"""
CB_COUNTS = """,
gn AS (SELECT 'in' AS matrix, context AS idx, count(*) AS n FROM pairs GROUP BY context
       UNION ALL SELECT 'out', target, count(*) FROM sc2 GROUP BY target)"""


def r3(x: str) -> str:
    return R3.format(x=x)


def epoch_ctes(cbow: bool, e: int) -> str:
    """One batch round: this epoch's examples, scores against the weights left by
    the round before, capped gradient sums, new weights."""
    text = "," + SUB + "," + WINS + "," + NEGS
    text = text.replace(f"{SEED}, {EPOCH},", f"{SEED}, {e},")
    model = (CB + CB_GRADS + CB_COUNTS) if cbow else (SG + SG_GRADS + SG_COUNTS)
    text += re.sub(r"\bw\b", f"w_{e}", model)
    names = "sub|ren|sent|win|pairs|draws|negs|tg|sc|sc2|gr|gn|hl|hv|ghl"
    text = re.sub(rf"(?<!')\b({names})\b(?!')", rf"\1_{e}", text)
    done = " + ".join(["0", *(f"(SELECT count(*) FROM win_{i})" for i in range(e))])
    rate = (f"greatest({LRMIN!r}, {LR!r} - {(LR - LRMIN)!r} * (CAST({done} AS DOUBLE)"
            f" / CAST((SELECT estimate FROM est) * {EPOCHS} AS DOUBLE)))")
    new = [f"""CASE WHEN g{m}.grad IS NULL THEN l.w{m[0]}
                ELSE CAST(l.w{m[0]} - lr * (g{m}.grad * least(1.0, {CAP!r} / greatest(n{m}.n, 1))) AS FLOAT) END AS w{m[0]}"""
           for m in ("in", "out")]
    joins = " ".join(f"""LEFT JOIN gr_{e} g{m} ON g{m}.matrix = '{m}' AND g{m}.idx = l.idx AND g{m}.j = l.j
        LEFT JOIN gn_{e} n{m} ON n{m}.matrix = '{m}' AND n{m}.idx = l.idx""" for m in ("in", "out"))
    return text + f""",
rate_{e} AS (SELECT {rate} AS lr),
wl_{e + 1} AS MATERIALIZED (SELECT l.idx, l.j, {new[0]}, {new[1]} FROM wl_{e} l {joins}, rate_{e}),
w_{e + 1} AS MATERIALIZED (SELECT idx, list(CAST(wi AS DOUBLE) ORDER BY j) AS w_in,
  list(CAST(wo AS DOUBLE) ORDER BY j) AS w_out FROM wl_{e + 1} GROUP BY idx)"""


def trained(cbow: bool) -> str:
    start = weights_cte(False).replace("wl AS (", "wl_0 AS MATERIALIZED (").replace("w AS M", "w_0 AS M") \
        .replace("FROM wl ", "FROM wl_0 ")
    return (BASE3 + "," + EST + "," + dist_cte() + "," + start
            + "".join(epoch_ctes(cbow, e) for e in range(EPOCHS)))


def vectors_of(cbow: bool) -> str:
    return trained(cbow) + f"""
SELECT v.idx, v.word, v.cnt, l.j, {r3('l.wi')} AS val FROM vocab v JOIN wl_{EPOCHS} l ON l.idx = v.idx"""


HISTORY = ",hist AS (" + " UNION ALL ".join(
    f"""SELECT CAST({e + 1} AS INTEGER) AS epoch, sum(loss) / (SELECT count(*) FROM win_{e}) AS avg_loss,
  {max(LR - (LR - LRMIN) * (e + 1) / EPOCHS, LRMIN)!r} AS learning_rate,
  (SELECT count(*) FROM win_{e}) AS pairs_processed, (SELECT lr FROM rate_{e}) AS lr_last FROM sc2_{e}"""
    for e in range(EPOCHS)) + ")"

PCA = """WITH RECURSIVE
emb AS (SELECT CAST(vec_id AS BIGINT) AS idx, CAST(vec_id AS VARCHAR) AS word,
               CAST(embedding AS DOUBLE[]) AS vec FROM embeddings {some}),
lf AS (SELECT idx, word, j, vec[j] AS x FROM (SELECT *, unnest(generate_series(1, len(vec))) AS j FROM emb)),
mn AS (SELECT j, avg(x) AS m FROM lf GROUP BY j),
c AS MATERIALIZED (SELECT idx, word, lf.j, x - m AS x FROM lf JOIN mn ON lf.j = mn.j),
cv AS MATERIALIZED (SELECT idx, word, list(x ORDER BY j) AS v, row_number() OVER (ORDER BY idx) AS r FROM c GROUP BY idx, word),
g AS (SELECT a.j AS i, b.j AS j, sum(a.x * b.x) AS g FROM c a JOIN c b ON a.idx = b.idx GROUP BY a.j, b.j),
gm AS MATERIALIZED (SELECT list(row ORDER BY i) AS m FROM (SELECT i, list(g ORDER BY j) AS row FROM g GROUP BY i)),
p1 AS (SELECT 0 AS k, {start} AS v FROM (SELECT v AS u FROM cv WHERE r = 1)
       UNION ALL SELECT k + 1, {start} FROM (
         SELECT k, list_transform(m, lambda row: list_dot_product(row, v)) AS u FROM p1, gm WHERE k < 30)),
e1 AS MATERIALIZED (SELECT v AS p FROM p1 WHERE k = 30),
gp AS (SELECT p, list_transform(m, lambda row: list_dot_product(row, p)) AS q, m FROM e1, gm),
g2 AS MATERIALIZED (SELECT list_transform(range(1, len(p) + 1), lambda i: list_transform(range(1, len(p) + 1),
         lambda j: m[i][j] - p[i] * q[j] - q[i] * p[j] + s * p[i] * p[j])) AS m
       FROM (SELECT *, list_dot_product(p, q) AS s FROM gp)),
p2 AS (SELECT 0 AS k, {start} AS v FROM (
         SELECT list_transform(list_zip(v, p), lambda t: t[1] - t[2] * d) AS u
         FROM (SELECT v, p, list_dot_product(v, p) AS d FROM cv, e1 WHERE r = 2))
       UNION ALL SELECT k + 1, {start} FROM (
         SELECT k, list_transform(m, lambda row: list_dot_product(row, v)) AS u FROM p2, g2 WHERE k < 30)),
xy AS (SELECT idx, word, list_dot_product(cv.v, e1.p) AS pc1, list_dot_product(cv.v, b.v) AS pc2
       FROM cv, e1, (SELECT v FROM p2 WHERE k = 30) b)"""


def pca(some: str = "") -> str:
    unit = ("CASE WHEN sqrt(list_dot_product(u, u)) > 1e-10"
            " THEN list_transform(u, lambda x: x / sqrt(list_dot_product(u, u))) ELSE u END")
    return PCA.format(some=some, start=unit)


_XY = f" SELECT idx, word, {r5('pc1')} AS pc1, {r5('pc2')} AS pc2 FROM xy"
_PAD = "greatest(max({c}) - min({c}), 0.1) * 0.15"

ORACLES.update({
    "train_skipgram": vectors_of(False),
    "train_cbow": vectors_of(True),
    "model_roundtrip": vectors_of(False),
    "training_history": trained(False) + HISTORY + f"""
SELECT epoch, {r3('avg_loss')} AS avg_loss, {r6('CAST(learning_rate AS FLOAT)')} AS learning_rate,
       pairs_processed, {r6('lr_last')} AS lr_last, CAST(1 AS INTEGER) AS rounds FROM hist""",
    "loss_curve_points": trained(False) + HISTORY + f""",
pad AS (SELECT min(avg_loss) AS lo, max(avg_loss) AS hi, greatest(max(avg_loss) - min(avg_loss), 0.1) * 0.1 AS pad FROM hist)
SELECT epoch, {r3('avg_loss')} AS avg_loss, {r3('lo - pad')} AS y_min, {r3('hi + pad')} AS y_max FROM hist, pad""",
    "pca_2d": pca() + _XY,
    "pca_top50": pca("WHERE vec_id < 50") + _XY,
    "pca_ranges": pca() + " SELECT " + ", ".join(
        f"{r5('min(' + c + ') - ' + _PAD.format(c=c))} AS {a}_min, {r5('max(' + c + ') + ' + _PAD.format(c=c))} AS {a}_max"
        for c, a in (("pc1", "x"), ("pc2", "y"))) + " FROM xy",
})
