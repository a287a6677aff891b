"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fits_broadcast, write_table

__all__ = ["bounded", "columns_of", "free_names", "lower_ascii", "measured_broadcast", "sorted_groups", "store", "table"]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write into the shared checkpoint folder and read back: cuts lineage,
    survives lost executors, and runs the plan above it once."""
    return write_table(df, name)


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (nor each other)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


SLICE_BYTES = 4 << 20


def bounded(batches, column: int, most: int = SLICE_BYTES):
    """The rows of Arrow batches in slices of at most ``most`` bytes of text in
    ``column`` (one longer text is a slice of its own)."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy().astype(np.int64) + 64)
        a = 0
        while a < b.num_rows:
            done = ends[a - 1] if a else 0
            z = max(a + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield b.slice(a, z - a)
            a = z


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, _UPPER, _UPPER.lower())


def measured_broadcast(small: DataFrame, row_bytes: int) -> DataFrame:
    """``small`` with a broadcast hint if its counted rows fit the size gate;
    otherwise without one, so that the join shuffles and AQE splits hot keys."""
    return F.broadcast(small) if fits_broadcast(small.count(), row_bytes) else small


def sorted_groups(batches, keys: list[str]):
    """Pandas frames of equal consecutive ``keys`` from Arrow batches whose rows
    are sorted by them; only the group under way is held across batches."""
    import numpy as np
    import pandas as pd

    held = []
    for b in batches:
        df = b.to_pandas()
        if not len(df):
            continue
        new = (df[keys] != df[keys].shift()).any(axis=1).to_numpy()
        if held and (held[-1][keys].iloc[-1] == df[keys].iloc[0]).all():
            new[0] = False
        cuts = np.flatnonzero(new).tolist()
        for a, z in zip([0, *cuts], [*cuts, len(df)]):
            if a == z:
                continue
            if new[a] and held:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(df.iloc[a:z])
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
