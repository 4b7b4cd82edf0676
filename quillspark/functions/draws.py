"""The numbers of ``text.uniform`` for whole arrays of keys: MD5 of short messages in numpy, one block each."""

from __future__ import annotations

from hashlib import md5
from math import floor, sin

import numpy as np

# Constants of RFC 1321.
_SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_SINES = [np.uint32(floor(abs(sin(i + 1)) * 2**32)) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: Messages worked on at once: their arrays stay in a processor's cache.
CHUNK = 16384
#: Bytes of a message that fits one block.
SHORT = 55


def _first_words(words: list[np.ndarray | None]) -> np.ndarray:
    """The first four bytes of the digests as big-endian numbers; of 16 words of every block None stands for zeros."""
    n = len(words[14])
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(61):  # the last three steps do not reach the first word
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            word = words[i]
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            word = words[(5 * i + 1) % 16]
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            word = words[(3 * i + 5) % 16]
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            word = words[7 * i % 16]
        f += a
        f += _SINES[i]
        if word is not None:
            f += word
        np.left_shift(f, _SHIFTS[i], out=t)
        f >>= 32 - _SHIFTS[i]
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    b += np.uint32(_START[0])
    return b.byteswap()


def place_draws(heads: list[bytes], sizes: np.ndarray, slot: bytes) -> np.ndarray:
    """A number in [0, 1) for every place 0, 1, ... of every list: of the MD5 of its head, the place in digits, and ``slot``."""
    out = np.empty(int(sizes.sum()))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(out)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lengths = np.array([len(h) for h in heads], np.int64)
    for size in np.unique(lengths[sizes > 0]).tolist():
        many = np.flatnonzero(lengths == size)
        row = np.zeros(len(heads), np.int64)
        row[many] = np.arange(len(many))
        bytes_of = np.frombuffer(b"".join(heads[i] for i in many.tolist()), np.uint8).reshape(len(many), size)
        of_size = np.flatnonzero(lengths[owner] == size)
        for digits in range(1, len(str(int(place[of_size].max()))) + 1):
            low, high = 10 ** (digits - 1) if digits > 1 else 0, 10**digits
            some = of_size[(place[of_size] >= low) & (place[of_size] < high)]
            end = size + digits + len(slot)
            if end > SHORT:
                out[some] = [int.from_bytes(md5(b"%b%d%b" % (heads[o], p, slot)).digest()[:4], "big") for o, p in zip(owner[some].tolist(), place[some].tolist())]
                continue
            used = end // 4 + 1
            blocks = np.zeros((len(many), used * 4), np.uint8)
            blocks[:, :size] = bytes_of
            blocks[:, size + digits : end] = np.frombuffer(slot, np.uint8)
            blocks[:, end] = 0x80
            templates = np.ascontiguousarray(blocks.view("<u4").T)
            for at in range(0, len(some), CHUNK):
                part = some[at : at + CHUNK]
                rows, p = row[owner[part]], place[part].astype(np.uint32)
                words: list[np.ndarray | None] = [templates[j][rows] for j in range(used)] + [None] * (16 - used)
                words[14] = np.full(len(part), end * 8, np.uint32)
                for j in range(size + digits - 1, size - 1, -1):
                    p, digit = np.divmod(p, np.uint32(10))
                    words[j // 4] |= (digit + np.uint32(48)) << np.uint32(8 * (j % 4))
                out[part] = _first_words(words)
    return out / 4294967296.0
