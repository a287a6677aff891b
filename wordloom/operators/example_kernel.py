"""Keyed draws and windows of a task's sentences (inside ``mapInArrow``).

The same numbers as the Column forms (:func:`keyed_uniform`): a draw is the first 48
bits of the MD5 of its key.  A batch is worked through as flat arrays, and no dice are
thrown for a token that is kept for certain.  Kernels follow each other in one task
(:func:`chain`), so no row between them passes through the JVM.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ..functions.draws import uniforms, uniforms_at

SENT_KEY = ["doc_id", "line_no"]
SLICE = 1 << 16               # tokens worked through at once


def chain(*kernels):
    """The kernels one after the other, each on the batches of the one before."""
    def run(batches):
        for k in kernels:
            batches = k(batches)
        return batches
    return run


def columns(names):
    def run(batches):
        return (b.select(names) for b in batches)
    return run


def heads(purpose: str, seed, epoch, columns) -> list[bytes]:
    """``purpose|seed|epoch|keys..|`` per row; as in ``concat_ws`` a null is left out."""
    lead = f"{purpose}|{seed}|{epoch}|"
    rows = zip(*[c.to_pylist() for c in columns])
    if any(c.null_count for c in columns):
        return ["".join([lead, *[f"{x}|" for x in row if x is not None]]).encode() for row in rows]
    return [f"{lead}{'|'.join(map(str, row))}|".encode() for row in rows]


def lists(sizes: np.ndarray, values) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)


def sample(seed: int, epoch: int, min_len: int, carry: tuple[str, ...] = ()):
    """Sentences ``t`` of the tokens that their dice keep; columns ``carry`` go along."""
    def run(batches):
        for b in batches:
            size = np.diff(b.column("toks").offsets.to_numpy())
            pos, idx, keep = (x.to_numpy() for x in b.column("toks").flatten().flatten())
            row = np.repeat(np.arange(len(size)), size)
            kept = keep >= 1.0
            dice = np.flatnonzero(~kept)
            if len(dice):
                head = heads("sub", seed, epoch, [b.column(c) for c in SENT_KEY])
                kept[dice] = uniforms_at(head, row[dice], pos[dice])[:, 0] < keep[dice]
            left = np.bincount(row[kept], minlength=len(size))
            some = left >= min_len
            t = idx[kept & some[row]]
            own = [*SENT_KEY, *carry]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).filter(pa.array(some)) for c in own], lists(left[some], pa.array(t))], [*own, "t"])
    return run


def lengths(seed: int, epoch: int):
    """Per sentence its tokens and those that their dice keep."""
    thrown = sample(seed, epoch, 0)

    def run(batches):
        for b in batches:
            t = next(iter(thrown([b]))).column("t")
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in SENT_KEY],
                 *[pa.array(np.diff(x.offsets.to_numpy()).astype(np.int64)) for x in (b.column("toks"), t)]],
                [*SENT_KEY, "n_all", "n_kept"])
    return run


def _cuts(size: np.ndarray):
    """Slices of rows of about SLICE tokens."""
    part = np.cumsum(size) // SLICE
    at = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    return list(zip(at[:-1], at[1:]))


def windows(window: int, seed: int, epoch: int, carry: tuple[str, ...] = ()):
    """One row per centre with its window width and context; columns ``carry`` go along."""
    own = [*SENT_KEY, *carry]

    def run(batches):
        for whole in batches:
            for a, z in _cuts(np.diff(whole.column("t").offsets.to_numpy())):
                b = whole.slice(a, z - a)
                size = np.diff(b.column("t").offsets.to_numpy())
                t = b.column("t").flatten().to_numpy()
                row = np.repeat(np.arange(len(size)), size)
                p = np.arange(len(t)) - (np.cumsum(size) - size)[row]
                head = heads("win", seed, epoch, [b.column(c) for c in SENT_KEY])
                win = 1 + np.floor(uniforms_at(head, row, p)[:, 0] * window).astype(np.int64)
                left, right = np.minimum(p, win), np.minimum(size[row] - 1 - p, win)
                n = left + right
                of = np.repeat(np.arange(len(t)), n)
                off = np.arange(len(of)) - (np.cumsum(n) - n)[of]
                context = t[of - left[of] + off + (off >= left[of])]
                some = n > 0
                keys = pa.array(row[some])
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).take(keys) for c in own], pa.array(p[some].astype(np.int32)), pa.array(t[some]),
                     pa.array(win[some].astype(np.int32)), lists(n[some], pa.array(context))],
                    [*own, "p", "center", "win", "context"])
    return run


def _lookup(upper: np.ndarray):
    """``searchsorted(upper, u, side="right")`` from a table of the first id per bucket."""
    n = 1 << max(len(upper) - 1, 1).bit_length()
    first = np.searchsorted(upper, np.arange(n) / n, side="right")

    def find(u):
        ids = first[(u * n).astype(np.int64)]
        left = np.flatnonzero(upper[ids] <= u)
        while len(left):
            ids[left] += 1
            left = left[upper[ids[left]] <= u[left]]
        return ids
    return find


def _same_key(b: pa.RecordBatch) -> np.ndarray:
    """Per row the number of its run of equal sentence keys."""
    new = np.zeros(b.num_rows, dtype=bool)
    for c in SENT_KEY:
        for x in (b.column(c).fill_null(0), b.column(c).is_null()):
            new[1:] |= np.diff(x.to_numpy(zero_copy_only=False)) != 0
    return np.cumsum(new)


def draws(runs, k: int, seed: int, epoch: int, vocab_size: int, shifted: bool):
    """Adds ``negatives``: the ids of a centre's k keyed draws, looked up in the noise
    ranges."""
    slots = [b"%d" % s for s in range(k)]

    def run(batches):
        find = _lookup(runs.upper())
        for b in batches:
            if not b.num_rows:
                continue
            if b.column("p").null_count:
                head = heads("neg", seed, epoch, [b.column(c) for c in (*SENT_KEY, "p")])
                u = uniforms(h + s for h in head for s in slots)
            else:
                row = _same_key(b)
                one = pa.array(np.flatnonzero(np.diff(row, prepend=-1)))
                head = heads("neg", seed, epoch, [b.column(c).take(one) for c in SENT_KEY])
                u = uniforms_at(head, row, b.column("p").to_numpy(), [b"|" + s for s in slots]).reshape(-1)
            ids = find(u).astype(np.int64)
            if shifted:
                ids = np.minimum(ids + 1, vocab_size - 1)
            yield b.append_column("negatives", lists(np.full(b.num_rows, k), pa.array(ids)))
    return run
