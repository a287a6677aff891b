"""The keyed uniforms of :mod:`.rng` for arrays of keys (inside a task).

A key is ``head`` + decimal ``p`` + optional ``tail``: short enough for one block of
MD5 (55 bytes), so the blocks of many keys are hashed side by side in numpy.  Longer
keys go through hashlib one by one.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np

from .rng import TWO_POW_48

LANES = 1 << 13               # keys hashed side by side: the block's words stay in cache
_ONE_BLOCK = 55
_U32 = np.uint32
_K = [_U32(int(abs(np.sin(i + 1)) * 2 ** 32)) for i in range(64)]
_TURN = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_PLACE = [lambda i: i, lambda i: 5 * i + 1, lambda i: 3 * i + 5, lambda i: 7 * i]
_START = [_U32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]


def _first_words(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the digests of single-block messages ``w`` (16, n)."""
    n = w.shape[1]
    used = w.any(axis=1)
    a, b, c, d = (np.full(n, x) for x in _START)
    f, r = np.empty(n, dtype=_U32), np.empty(n, dtype=_U32)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif kind == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        g = _PLACE[kind](i) % 16
        if used[g]:
            f += w[g]
        f += _K[i]
        f += a
        s = _TURN[kind][i % 4]
        np.right_shift(f, _U32(32 - s), out=r)
        f <<= _U32(s)
        f |= r
        f += b
        a, b, c, d, f = d, f, b, c, a
    return a + _START[0], b + _START[1]


def _hashed(blocks: np.ndarray, out: np.ndarray) -> None:
    words = blocks.view("<u4")
    for a in range(0, len(words), LANES):
        x, y = _first_words(np.ascontiguousarray(words[a:a + LANES].T, dtype=_U32))
        high = x.byteswap().astype(np.uint64) << np.uint64(16)
        out[a:a + LANES] = (high | (y & _U32(0xFFFF)).astype(np.uint16).byteswap()).astype(np.float64) / TWO_POW_48


def uniforms(keys) -> np.ndarray:
    """The keyed uniforms of an iterable of keys (bytes)."""
    raw = b"".join([md5(k).digest() for k in keys])
    return (np.frombuffer(raw, dtype=">u8")[::2] >> np.uint64(16)).astype(np.float64) / TWO_POW_48


def uniforms_at(heads: list[bytes], row: np.ndarray, p: np.ndarray, tails: list[bytes] = (b"",)) -> np.ndarray:
    """(n, tails) uniforms of the keys ``heads[row] + p + tail``."""
    n = len(row)
    out = np.empty((len(tails), n), dtype=np.float64)
    if not n:
        return out.T
    size = np.array([len(h) for h in heads], dtype=np.int64)
    digits = len(str(int(p.max())))
    if p.min() < 0 or size.max() + digits + max(map(len, tails)) > _ONE_BLOCK:
        for k, tail in enumerate(tails):
            out[k] = uniforms(heads[r] + b"%d" % x + tail for r, x in zip(row.tolist(), p.tolist()))
        return out.T
    lead = np.array(heads, dtype="S64").view(np.uint8).reshape(-1, 64)
    for a in range(0, n, 4 * LANES):
        z = min(a + 4 * LANES, n)
        blocks, at = lead[row[a:z]], size[row[a:z]]
        flat, base, num = blocks.reshape(-1), np.arange(z - a) * 64, p[a:z]
        length = np.ones(z - a, dtype=np.int64)
        for d in range(1, digits):
            length += num >= 10 ** d
        for d in range(digits):
            some = np.flatnonzero(length > d)
            flat[(base + at + length - 1 - d)[some]] = 48 + num[some] // 10 ** d % 10
        end = base + at + length
        for k, tail in enumerate(tails):
            for j, byte in enumerate(tail):
                flat[end + j] = byte
            flat[end + len(tail)] = 0x80
            for j in range(len(tail) + 1, max(map(len, tails[:k]), default=0) + 1):
                flat[end + j] = 0                 # left by a longer tail
            bits = (end - base + len(tail)) * 8
            flat[base + 56], flat[base + 57] = bits & 255, bits >> 8
            _hashed(blocks, out[k, a:z])
    return out.T
