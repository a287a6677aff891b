"""Keyed uniform draws.

Every random choice (subsampling dice, window width, negative draws, weight
init, epoch shuffle) is a pure function of a purpose tag, the seed and the
row's natural key.  Results therefore do not depend on partitioning, task
retries or executor loss, and the same numbers can be produced in SQL:

    md5(concat_ws('|', purpose, seed, k1, k2, ...)) -> first 12 hex digits
    -> integer in [0, 2^48) -> / 2^48
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_48 = float(2 ** 48)


def _as_col(k) -> Column:
    if isinstance(k, Column):
        return k.cast("string")
    if isinstance(k, str):
        return F.col(k).cast("string")
    return F.lit(str(k))


def keyed_uniform(purpose: str, seed, *keys) -> Column:
    """Uniform double in [0, 1) keyed by (purpose, seed, keys...).

    ``keys`` are column names, Columns or Python ints.
    """
    parts = [F.lit(purpose), _as_col(seed)] + [_as_col(k) for k in keys]
    h = F.md5(F.concat_ws("|", *parts))
    u = F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(TWO_POW_48)
    # Never null (12 hex digits always parse); saying so lets the optimizer
    # drop inferred IS NOT NULL filters that would hash the key again.
    return F.coalesce(u, F.lit(0.0))


def uniform_sql(purpose: str, seed, *keys: str) -> str:
    """The same draw written for DuckDB (used by the SQL oracles)."""
    parts = ", ".join([f"'{purpose}'", str(seed)] + [str(k) for k in keys])
    return (f"(('0x' || substr(md5(concat_ws('|', {parts})), 1, 12))::BIGINT::DOUBLE"
            f" / 281474976710656.0)")


def keyed_uniform_np(purpose: str, seed, keys_matrix) -> "list[float]":
    """Python form for small driver-side checks in tests."""
    import hashlib
    out = []
    for row in keys_matrix:
        s = "|".join([purpose, str(seed)] + [str(k) for k in row])
        out.append(int(hashlib.md5(s.encode()).hexdigest()[:12], 16) / TWO_POW_48)
    return out
