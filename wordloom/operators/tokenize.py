"""Tokenisation: split a line on Unicode white space, drop empty pieces.

No case folding and no punctuation handling; UTF-8 is kept as is.  Java's
``\\s`` is ASCII-only, so the Unicode flag ``(?U)`` is required to split on
all 25 white-space characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the white-space class used to split sentences.
WHITESPACE = r"(?U)\s+"


def token_array(line_col="line") -> Column:
    c = F.col(line_col) if isinstance(line_col, str) else line_col
    return F.array_remove(F.split(c, WHITESPACE, -1), F.lit(""))


def nonblank_lines(lines: DataFrame) -> DataFrame:
    """Lines that hold at least one token (the reference drops blank ones)."""
    return lines.where(F.size(token_array("line")) > 0)


def tokenize(lines: DataFrame) -> DataFrame:
    """corpus(doc_id, line_no, line) -> tokens(doc_id, line_no, pos, word).

    Row-local (explode), so it stays inside one codegen stage with the scan.
    """
    return lines.select(
        "doc_id", "line_no",
        F.posexplode(token_array("line")).alias("pos", "word"),
    ).select("doc_id", "line_no", F.col("pos").cast("int").alias("pos"), "word")


def tokenized_lines(lines: DataFrame) -> DataFrame:
    """corpus -> (doc_id, line_no, tokens ARRAY<STRING>), blank lines dropped."""
    return (lines.select("doc_id", "line_no", token_array("line").alias("tokens"))
            .where(F.size("tokens") > 0))
