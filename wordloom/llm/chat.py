"""Chat formatting in budgeted, turn-aligned windows.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn.  Inside roles and texts a
backslash is doubled and every control string (``<|``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``) gets a backslash after its first character, so control strings in a
formatted window are the template's own; :func:`unescape` reverses it exactly.

Windows: a turn's tokens are its words plus its markers, or a column of the caller's
own counts.  With running sums of tokens per conversation, a turn belongs to window
``floor(before / stride)``, ``stride = (budget - history - room) / 2``, where ``room`` is
the conversation's own system turn, or ``system`` if that is more.  So a window whose
other turns are at most ``stride`` long keeps the budget, whatever the length of the
system turn; a longer turn is never cut but stands in a window that exceeds it.  A system
turn that leaves no room (``stride`` would be below one) gives every turn a window of its
own, all of which exceed the budget.  A window begins with the conversation's system turn
(if its first turn is one), then repeats the turns that start at most ``history``
tokens before the window's own, then has its own turns.  Loss spans (code points
of the formatted string) cover the assistant texts of the window's own turns
only, so each is under loss exactly once.

Running sums are taken inside blocks of ``TURN_BLOCK`` turn numbers and blocks are
summed after, so a conversation of any length spreads over tasks; a window is
as large as its budget.  DataFrame functions only.

Rows: ordered by (turn, role, text); a null turn comes first; null roles and texts
are empty; repeated rows are repeated turns.  A null conv_id is a conversation of
its own.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import store, table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
BUDGET, HISTORY, SYSTEM = 1024, 256, 128
TURN_BLOCK = 256
MARKERS = 3                   # tokens a turn's markers count for
NO_ID = -(1 << 63)            # stands for a null conv_id while windows are built

_CONTROL = r"<(?=\||/?s>)|\[(?=/?INST\])"


def escape(c: Column) -> Column:
    doubled = F.regexp_replace(c, r"\\", r"\\\\")
    return F.regexp_replace(doubled, rf"({_CONTROL})", r"$1\\")


def unescape(c: Column) -> Column:
    opened = F.regexp_replace(c, r"([<\[])\\(?!\\)", "$1")
    return F.regexp_replace(opened, r"\\\\", r"\\")


def _tokens(text: str, role: str) -> Column:
    words = F.lit(r"[^\x20\x09-\x0D]+")
    return F.regexp_count(text, words) + F.regexp_count(role, words) + MARKERS


def _stride(first: Column, budget: int, history: int, system: int) -> Column:
    """Tokens between window starts, from the conversation's first (turn, role, -tokens)."""
    room = F.greatest(F.lit(system), F.when(first["role"] == "system", -first["col3"]).otherwise(0))
    return F.greatest(F.floor((F.lit(budget - history) - room) / F.lit(2)), F.lit(1))


def format_windows(conv: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                   system: int = SYSTEM, tokens: str | None = None) -> DataFrame:
    """``(conv_id, window, formatted, n_repeated, loss, n_tokens)``: ``loss`` holds
    ``(start, length)`` spans, ``n_repeated`` how many leading turns are repeats.
    ``tokens`` names a column of token counts (markers included; null: 0)."""
    if (budget - history - system) // 2 < 1:
        raise ValueError("the budget must exceed history and system by two tokens")
    t = conv.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("c"),
        F.coalesce(F.col("turn").cast("long"), F.lit(NO_ID)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        (F.lit(None).cast("long") if tokens is None else F.coalesce(F.col(tokens).cast("long"), F.lit(0))).alias("tok")) \
        .withColumn("blk", F.floor(F.col("turn") / F.lit(TURN_BLOCK)))
    if tokens is None:
        t = t.withColumn("tok", _tokens("text", "role").cast("long"))
    inside = Window.partitionBy("c", "blk").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, -1)
    before = Window.partitionBy("c").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = t.groupBy("c", "blk").agg(F.sum("tok").alias("bt"), F.count(F.lit(1)).alias("bn"),
                                   F.min(F.struct("turn", "role", -F.col("tok"))).alias("f")).select(
        "c", "blk", _stride(F.min("f").over(Window.partitionBy("c")), budget, history, system).alias("stride"), F.coalesce(F.sum("bt").over(before), F.lit(0)).alias("t0"),
        F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("n0"))
    rows = t.select("*", F.coalesce(F.sum("tok").over(inside), F.lit(0)).alias("ti"),
                    F.count(F.lit(1)).over(inside).alias("ni")).join(blocks, ["c", "blk"])
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    rows = store(rows.select(
        "c", "stride", (F.col("n0") + F.col("ni")).alias("pos"), (F.col("t0") + F.col("ti")).alias("at"), "tok", "role",
        head.alias("head"), escape(F.col("text")).alias("body")) \
        .withColumn("own", F.floor(F.col("at") / F.col("stride"))), "turns")
    retained = (F.col("pos") == 0) & (F.col("role") == "system")
    # Own window, and every later one that this turn may be history of.
    last = F.floor((F.col("at") + F.lit(history)) / F.col("stride"))
    placed = rows.withColumn("keep", retained).withColumn("w", F.explode(F.when(
        retained, F.array("own")).otherwise(F.sequence("own", last))))
    starts = rows.groupBy("c", "own").agg(F.min("at").alias("start")).withColumnRenamed("own", "w")
    placed = placed.join(starts, ["c", "w"]).where((F.col("w") == F.col("own")) | (
        F.col("start") - F.col("at") <= history))
    system_turn = rows.where(retained).select("c", F.lit(-1).cast("long").alias("pos"), "tok", "head", "body")
    repeated = starts.where("w > 0").join(system_turn, "c").select(
        "c", "w", "pos", "tok", "head", "body", F.lit(True).alias("again"), F.lit(False).alias("learn"))
    again = F.col("w") != F.col("own")
    parts = placed.select("c", "w", "pos", "tok", "head", "body", again.alias("again"),
                          (~again & (F.col("role") == "assistant")).alias("learn")).unionByName(repeated)
    got = parts.groupBy("c", "w").agg(
        F.array_sort(F.collect_list(F.struct("pos", "head", "body", "learn"))).alias("p"),
        F.sum(F.col("again").cast("int")).alias("n_repeated"), F.sum("tok").alias("n_tokens"))
    spans = F.aggregate(
        "p", F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("s")),
        lambda a, x: F.struct(
            (a["at"] + F.char_length(x["head"]) + F.char_length(x["body"]) + len(END)).alias("at"),
            F.when(x["learn"], F.concat(a["s"], F.array(F.struct(
                (a["at"] + F.char_length(x["head"])).alias("start"),
                F.char_length(x["body"]).alias("length"))))).otherwise(a["s"]).alias("s")))
    return got.select(
        F.when(F.col("c") != NO_ID, F.col("c")).alias("conv_id"), F.col("w").alias("window"),
        F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "").alias("formatted"),
        "n_repeated", spans["s"].alias("loss"), "n_tokens")


def read_turns(windows: DataFrame) -> DataFrame:
    """``(conv_id, window, turns, learned, chars)``: the window's own turns as
    ``(role, text)`` and the texts under loss, parsed from the formatted string."""
    parts = F.slice(F.split("formatted", r"<\|turn\|>"), F.col("n_repeated") + 2, F.lit(1 << 30))

    def turn(s):
        cut = F.split(F.substring_index(s, END, 1), r"<\|text\|>")
        return F.struct(unescape(cut[0]).alias("role"), unescape(cut[1]).alias("text"))
    learned = F.transform("loss", lambda x: unescape(F.substring(
        F.col("formatted"), x["start"] + 1, x["length"])))
    return windows.select("conv_id", "window", F.transform(parts, turn).alias("turns"),
                          learned.alias("learned"), F.char_length("formatted").alias("chars"))


def digests(windows: DataFrame) -> DataFrame:
    """One row per conversation.  Its SHA-256 needs its text in one row: the digest
    is as long as the conversation, the windows it is read from are not."""
    turns = F.array_join(F.transform("turns", lambda x: F.concat(
        x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    per = read_turns(windows).select(
        "conv_id", "chars", F.size("turns").alias("n"),
        F.struct("window", turns.alias("t"), F.array_join("learned", "").alias("l")).alias("x"))
    whole = per.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.array_sort(F.collect_list("x")).alias("x"))

    def joined(field):
        return F.array_join(F.transform("x", lambda v: v[field]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined("t").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(joined("l")).cast("long").alias("loss_chars"),
        F.sha2(joined("l").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"""SELECT * FROM VALUES (-1L, 0L, 'user', '{probe}'), (-1L, 1L, 'assistant', '{probe}')
                          AS t(conv_id, turn, role, text)""")
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_windows(conv.unionByName(extra)))


_W = r"'[^\x20\x09-\x0D]+'"


def _grown(c: str) -> str:
    """Code points of an escaped string, by counting what is inserted."""
    marks = " + ".join(f"(length({c}) - length(replace({c}, '{s}', ''))) // {len(s)}"
                       for s in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "\\"))
    return f"(length({c}) + {marks})"


SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT *, len(regexp_extract_all(text, {_W})) + len(regexp_extract_all(role, {_W})) + {MARKERS} AS tok,
             {len(TURN + TEXT + END)} + {_grown('role')} + {_grown('text')} AS chars,
             row_number() OVER o - 1 AS pos
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
r AS (SELECT *, coalesce(sum(tok) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING
             AND 1 PRECEDING), 0)::BIGINT AS pre, pos = 0 AND role = 'system' AS keep,
             min({{'t': turn, 'r': role, 'k': -tok}}) OVER (PARTITION BY conv_id) AS f FROM t),
o AS (SELECT *, pre // greatest(({BUDGET - HISTORY} - greatest({SYSTEM}, CASE WHEN f.r = 'system' THEN -f.k ELSE 0 END))
                                // 2, 1) AS own FROM r),
s AS (SELECT conv_id, own AS w, min(pre) AS start FROM o GROUP BY ALL),
f AS (SELECT o.conv_id, sum(chars)::BIGINT AS formatted_chars FROM o JOIN s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
        AND (s.w = o.own OR s.w > o.own AND (o.keep OR s.start - o.pre <= {HISTORY})) GROUP BY 1)
SELECT o.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       any_value(formatted_chars) AS formatted_chars
FROM o JOIN f ON f.conv_id IS NOT DISTINCT FROM o.conv_id GROUP BY o.conv_id
"""
