"""Token-id files: frequency-ranked ids in a byte-aligned code.

Writing
  1. documents are range-partitioned by the order key and sorted inside each
     partition, so parts follow each other in ascending order;
  2. texts are encoded whole and the ids written once into the shared folder,
     every task adding one row with its own counts of ids;
  3. these rows are summed per id and ranked: the most frequent id gets rank 0;
  4. ranks are packed in blocks: per rank a two-bit length code in a control
     stream (four codes a byte) and one to four little-endian bytes in a data
     stream kept apart from it.
The files are Parquet tables written by Spark, one row per block, so a lost
executor's task is simply written again and any store Spark writes to works:
``<path>/blocks`` (part, block, doc_ids, lens, control, data), ``<path>/vocab``
(rank, id, n).  A part is one sorted range; a document never spans blocks.

Reading
  One table lookup per control byte gives the byte length of its four codes
  and where each of their bytes stands; numpy gathers all ranks of a block at
  once and maps them to ids.  Starts come from the parts' totals (one row each).

Null and empty texts hold only the end id.  Rows that share a key keep an order
by text; null keys come first; an empty table gives empty files.  A vocabulary of
more than MAX_VOCAB ids is an error.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_table, scratch_path
from .common import bounded, store, table
from .tokenizer import DEFAULT_VOCAB, encoder

BLOCK_IDS = 1 << 18
SLICE_BYTES = 8 << 20        # text encoded at once
MAX_VOCAB = 1 << 20          # ids a vocabulary may have: bounds the rank table
RAW = "part int, seq long, doc_id long, ids binary"
SUM_TASKS = 16
COUNTS = -1                  # seq of a task's row of counts
BLOCKS = "part int, block long, doc_ids array<long>, lens array<int>, control binary, data binary"


def _control_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per control byte: bytes used by its four codes, and the place of each of
    the 16 output bytes in them (-1: zero)."""
    codes = (np.arange(256)[:, None] >> (2 * np.arange(4))) & 3
    size = codes + 1
    start = np.cumsum(size, axis=1) - size
    byte = np.arange(4)
    place = np.where(byte < size[:, :, None], start[:, :, None] + byte, -1)
    return size.sum(axis=1).astype(np.int64), place.reshape(256, 16).astype(np.int64)


CTRL_BYTES, CTRL_PLACE = _control_tables()


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit ranks."""
    r = np.ascontiguousarray(ranks, dtype="<u4")
    code = (r >= 1 << 8).astype(np.uint8) + (r >= 1 << 16) + (r >= 1 << 24)
    padded = np.zeros(-(-len(r) // 4) * 4, dtype=np.uint8)
    padded[:len(r)] = code
    quad = padded.reshape(-1, 4)
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first ``n`` ranks of a (control, data) pair, by table lookup."""
    if n == 0:
        return np.zeros(0, dtype="<u4")
    c = np.frombuffer(control, dtype=np.uint8)
    size = CTRL_BYTES[c]
    at = np.cumsum(size) - size
    place = CTRL_PLACE[c]
    # Padding codes of the last byte may point past the data: they read zero.
    buf = np.frombuffer(data + bytes(16), dtype=np.uint8)
    got = np.where(place >= 0, buf[at[:, None] + np.maximum(place, 0)], 0).astype(np.uint8)
    return got.reshape(-1).view("<u4")[:n]


def _binary(flat: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary value per text."""
    ends = (cuts * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def _encode_sorted(vocab: str, end_id: int):
    def rows(part, seq, docs, ids):
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int32()), pa.array(seq, pa.int64()), docs, ids], ["part", "seq", "doc_id", "ids"])

    def run(batches):
        enc = encoder(vocab)
        part, seq = TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=enc.type).tobytes()
        total = np.zeros(enc.tok.get_vocab_size(), dtype=np.int64)
        for b in bounded(batches, 1, SLICE_BYTES):
            # One array per slice, the end ids in it, serves the counts and the rows.
            flat, cuts = enc.encode_column(b.column(1), end)
            got = np.bincount(flat)
            if len(got) > len(total):                    # an end id outside the vocabulary
                total = np.append(total, np.zeros(len(got) - len(total), dtype=np.int64))
            total[:len(got)] += got
            yield rows(part, range(seq, seq + b.num_rows), b.column(0).cast(pa.int64()), _binary(flat, cuts))
            seq += b.num_rows
        at = np.flatnonzero(total)
        if len(at):
            counts = np.stack([at, total[at]], axis=1).astype("<i8").tobytes()
            yield rows(part, [COUNTS], pa.array([None], pa.int64()), pa.array([counts], pa.binary()))
    return run


def _ids_of(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{width}")


def _summed(batches):
    """One row per id for all count rows of a task."""
    total = np.zeros(0, dtype=np.int64)
    for b in batches:
        for raw in b.column(0).to_pylist():
            at, n = np.frombuffer(raw, "<i8").reshape(-1, 2).T
            if at[-1] >= len(total):
                total = np.append(total, np.zeros(int(at[-1]) + 1 - len(total), dtype=np.int64))
            total[at] += n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])


def _write_blocks(rank_of: np.ndarray, width: int):
    def close(part, block, ids, docs, lens):
        control, data = pack_ranks(rank_of[np.concatenate(ids)])
        return pa.RecordBatch.from_pylist(
            [{"part": part, "block": block, "doc_ids": docs, "lens": lens, "control": control, "data": data}],
            schema=pa.schema([("part", pa.int32()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                              ("lens", pa.list_(pa.int32())), ("control", pa.binary()), ("data", pa.binary())]))

    def run(batches):
        # Rows arrive in (part, seq) order; a block holds documents of one part.
        # A task may hold several splits of a file: a gap in seq ends a block too.
        ids, docs, lens, held, part, first = [], [], [], 0, None, 0
        for b in batches:
            for p, seq, d, raw in zip(*(b.column(i).to_pylist() for i in range(4))):
                if ids and (p != part or seq != first + len(ids) or held >= BLOCK_IDS):
                    yield close(part, first, ids, docs, lens)
                    ids, docs, lens, held = [], [], [], 0
                if not ids:
                    part, first = p, seq
                ids.append(_ids_of(raw, width))
                docs.append(d)
                lens.append(len(ids[-1]))
                held += lens[-1]
        if ids:
            yield close(part, first, ids, docs, lens)
    return run


def _checked(vocab: str):
    enc = encoder(vocab)
    if enc.tok.get_vocab_size() > MAX_VOCAB:
        raise ValueError(f"{vocab}: {enc.tok.get_vocab_size()} ids, at most {MAX_VOCAB} can be ranked")
    return enc


def write_token_files(docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text",
                      vocab: str = DEFAULT_VOCAB, end_id: int = 0) -> None:
    """Encode ``docs`` in ascending ``key_col`` order into files under ``path``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows that share a key go on by the text's hash, so that a hot key spreads over ranges.
    rows = rows.withColumn("_h", F.xxhash64("text"))
    ordered = rows.repartitionByRange(parts, "doc_id", "_h") \
        .sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    width = _checked(vocab).width
    raw = store(ordered.mapInArrow(_encode_sorted(vocab, end_id), RAW), "token-ids")
    # A count row per writing task goes to SUM_TASKS tasks, so their sums hold at most so many rows per id.
    counts = raw.where(F.col("seq") == COUNTS).select("ids").repartition(SUM_TASKS) \
        .mapInArrow(_summed, "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n"))
    # One row per vocabulary id: bounded by the tokenizer, never by the corpus.
    top = counts.orderBy(F.desc("n"), "id").collect()
    id_of = np.array([r["id"] for r in top], dtype=np.int64)
    rank_of = np.zeros(int(id_of.max()) + 1 if len(id_of) else 1, dtype="<u4")
    rank_of[id_of] = np.arange(len(id_of))
    spark.createDataFrame([(i, int(r["id"]), int(r["n"])) for i, r in enumerate(top)],
                          "rank long, id long, n long").coalesce(1).write.parquet(f"{path}/vocab")
    ranked = spark.sparkContext.broadcast(rank_of)       # at most MAX_VOCAB * 4 bytes

    def blocks(batches):
        yield from _write_blocks(ranked.value, width)(batches)
    # Each scratch file is one sorted part; a split of it is still in order.
    raw.where(F.col("seq") != COUNTS).mapInArrow(blocks, BLOCKS) \
        .write.option("compression", "zstd").parquet(f"{path}/blocks")
    drop_table(raw)


def read_token_files(spark: SparkSession, path: str, fn, schema: str) -> DataFrame:
    """Apply ``fn(doc_ids, lens, ids) -> RecordBatch`` to every block's decoded ids."""
    id_of = np.array([r["id"] for r in spark.read.parquet(f"{path}/vocab").orderBy("rank").collect()], dtype="<u4")
    ids = spark.sparkContext.broadcast(id_of)

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                lens = np.array(row["lens"], dtype=np.int64)
                ranks = unpack_ranks(row["control"], row["data"], int(lens.sum()))
                yield fn(row["part"], row["block"], row["doc_ids"], lens, ids.value[ranks])
    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, schema)


def _digest(part, block, doc_ids, lens, ids):
    end = np.cumsum(lens)
    raw, cut = ids.astype("<u4").tobytes(), [0, *(end * 4).tolist()]
    crc = [zlib.crc32(raw[a:z]) for a, z in zip(cut, cut[1:])]
    n = len(lens)
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int64()), pa.array(doc_ids, pa.int64()),
         pa.array(end - lens, pa.int64()), pa.array(lens, pa.int64()), pa.array(crc, pa.int64())],
        ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` read back from the files."""
    # Block totals come from the block table; offsets of blocks inside a part,
    # then of parts, each a small table (one row per block, one per part).
    sizes = spark.read.parquet(f"{path}/blocks").select(
        "part", "block", F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("pn")).select(
        "part", F.coalesce(F.sum("pn").over(over), F.lit(0)).alias("p0"))
    offs = sizes.select("part", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("b0")) \
        .join(F.broadcast(parts), "part").select("part", "block", (F.col("p0") + F.col("b0")).alias("base"))
    rows = read_token_files(spark, path, _digest,
                            "part int, block long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(offs, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token files of all documents and return what they hold."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return token_index(spark, path)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the same for the rows that reached it."""
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path)
    return token_index(spark, path)
