"""Word shingles and MinHash minima of whole texts, as numpy kernels.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only, which
is exactly what ``bytes.lower().split()`` does on UTF-8.  A word is hashed by
a polynomial over a random byte table (one cumulative sum for the whole text),
then finalised; a shingle mixes the hashes of its words with one odd
multiplier per position and is finalised again.  All arithmetic is modulo
2^64, so the same text gives the same set on every machine.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15          # odd polynomial base
_CHUNK = 1 << 22                    # bytes hashed at once: bounds memory on very long texts


def fmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: two rounds of xor-shift and odd multiplication."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(29))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(32))


def keyed_words(n: int, key: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit words from a counter and a key."""
    return fmix(np.arange(1, n + 1, dtype=U64) * U64(_BASE) + fmix(np.array([key], dtype=U64)))


_BYTE = keyed_words(256, 11)
_POS = keyed_words(64, 12) | U64(1)


class _Powers:
    """Powers of the base and of its inverse, grown when a longer chunk needs them."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=U64)
        self.down = np.ones(1, dtype=U64)
        self.inv = U64(pow(_BASE, -1, 1 << 64))

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 2 * len(self.up), 1 << 14)
            up = np.full(m, U64(_BASE), dtype=U64)
            down = np.full(m, self.inv, dtype=U64)
            up[0] = down[0] = 1
            self.up = np.multiply.accumulate(up)
            self.down = np.multiply.accumulate(down)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _hash_words(words: list[bytes]) -> np.ndarray:
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    buf = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum(lens)
    starts = ends - lens
    up, down = _POWERS.get(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=U64)
    np.cumsum(_BYTE[buf] * up[:-1], out=total[1:])
    return fmix((total[ends] - total[starts]) * down[starts] + lens.astype(U64))


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word of the whole text, in order."""
    if not text:
        return np.zeros(0, dtype=U64)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=U64)
    parts, batch, size = [], [], 0
    for w in words if len(text) > _CHUNK else ():
        batch.append(w)
        size += len(w)
        if size >= _CHUNK:
            parts.append(_hash_words(batch))
            batch, size = [], 0
    if len(text) <= _CHUNK:
        batch = words
    if batch:
        parts.append(_hash_words(batch))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending.

    Fewer words than ``width``: the whole sequence is the one shingle.
    No words (null, empty, white space only): the empty set.
    """
    h = word_hashes(text)
    if len(h) == 0:
        return h
    w = min(width, len(h))
    acc = np.zeros(len(h) - w + 1, dtype=U64)
    with np.errstate(over="ignore"):
        for j in range(w):
            acc += h[j:j + len(acc)] * _POS[j]
        return np.unique(fmix(acc + U64(w)))


def minima_of_sets(sets: list[np.ndarray], mult: np.ndarray, add: np.ndarray,
                   chunk: int = 1 << 15) -> np.ndarray:
    """One row of minima per set (all ones for an empty set).

    Sets are laid end to end and cut into chunks that stay in the CPU cache;
    one multiply, one add and one segmented minimum serve a whole chunk.
    """
    out = np.full((len(sets), len(mult)), np.iinfo(np.uint64).max, dtype=U64)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat = np.concatenate([sets[i] for i in full])
    bounds = np.concatenate([[0], np.cumsum(sizes[full])])
    with np.errstate(over="ignore"):
        for a in range(0, len(flat), chunk):
            z = min(a + chunk, len(flat))
            lo = int(np.searchsorted(bounds, a, side="right")) - 1
            hi = int(np.searchsorted(bounds, z, side="left"))
            starts = np.maximum(bounds[lo:hi], a) - a
            rows, part = full[lo:hi], flat[a:z]
            low = np.empty((len(rows), len(mult)), dtype=U64)
            for i in range(len(mult)):
                low[:, i] = np.minimum.reduceat(part * mult[i] + add[i], starts)
            out[rows] = np.minimum(out[rows], low)
    return out


def set_fingerprint(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set, as signed integers."""
    with np.errstate(over="ignore"):
        a = fmix(s ^ U64(0x51ED270B35A4C6F1)).sum(dtype=U64)
        b = fmix(s + U64(0x2545F4914F6CDD1D)).sum(dtype=U64)
    return int(a.view(np.int64)), int(b.view(np.int64))
