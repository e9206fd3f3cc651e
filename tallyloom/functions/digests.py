"""MD5 of many short texts at once, in numpy."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
START = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
# longest text that is one block with its padding
ONE_BLOCK = 55


def digest_heads(words: np.ndarray) -> np.ndarray:
    """First 48 bits of the digest of one-block messages; `words` holds message word i of all of them in row i."""
    n = words.shape[1]
    a, b, c, d = (np.full(n, x) for x in START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            g = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            g = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            g = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            g = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        for more in (a, SINES[i], words[g]):
            np.add(f, more, out=f)
        np.left_shift(f, np.uint32(TURNS[i]), out=t)
        np.right_shift(f, np.uint32(32 - TURNS[i]), out=f)
        np.bitwise_or(f, t, out=f)
        np.add(f, b, out=a)
        a, b, c, d = d, a, b, c
    high, low = ((x + s).astype(np.uint32).byteswap().astype(np.int64) for x, s in ((a, START[0]), (b, START[1])))
    return high << 16 | low >> 16


def unit_hashes(texts: pa.Array, endings: Sequence[str]) -> list[np.ndarray]:
    """The first 48 bits of md5(text + ending) as numbers in [0, 1), one array for each ending."""
    n = len(texts)
    raw = texts.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + n + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    order = np.argsort(np.diff(ends), kind="stable")
    size = np.diff(ends)[order]
    cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), n] if n else []
    # the texts of one length lie next to each other
    parts = [(int(size[lo]), lo, hi) for lo, hi in zip(cuts, cuts[1:])]
    most = max((s for s, _, _ in parts if s <= ONE_BLOCK), default=0)
    short = int(np.searchsorted(size, most, side="right"))
    base = np.zeros((short, 64), np.uint8)
    for s, lo, hi in parts:
        if hi <= short:
            base[lo:hi, :s] = data[ends[order[lo:hi], None] + np.arange(s)]
    out = []
    for ending in map(str.encode, endings):
        heads, block, tail = np.zeros(n, np.int64), base.copy(), np.frombuffer(ending, np.uint8)
        upto = 0
        for s, lo, hi in parts:
            m = s + len(tail)
            if m > ONE_BLOCK:
                heads[lo:hi] = [int(hashlib.md5(data[ends[i]:ends[i + 1]].tobytes() + ending).hexdigest()[:12], 16) for i in order[lo:hi]]
                continue
            block[lo:hi, s:m] = tail
            block[lo:hi, m] = 0x80
            block[lo:hi, 56:58] = 8 * m % 256, 8 * m // 256
            upto = hi
        if upto:
            heads[:upto] = digest_heads(np.ascontiguousarray(block[:upto].view("<u4").T))
        values = np.empty(n)
        values[order] = heads / float(16 ** 12)
        out.append(values)
    return out
