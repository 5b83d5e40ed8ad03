"""Word positions and hashes of whole texts, computed over byte arrays.

Words are ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes (all separators are
ASCII, so bytes and characters cut alike).  A word's hash is the sum of a
random number per byte value times the powers of an odd number modulo 2**64:
a prefix sum over the bytes gives the hashes of all words at once.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


_BYTES = mix(mix(np.arange(1, 257, dtype=np.uint64) * _ODD))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the odd number, and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        inverse = pow(int(_ODD), -1, 1 << 64)
        for name, base in (("up", int(_ODD)), ("down", inverse)):
            p = np.full(size, _U(base))
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of each word, number of its text)`` in order."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    white = _WHITE[data]
    edge = np.flatnonzero(np.diff(white, prepend=True))
    start, end = edge[::2], edge[1::2]
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up, dtype=np.uint64, out=total[1:])
    h = mix((total[end] - total[start]) * down[start])
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return h, np.searchsorted(bounds, start, side="right")


def gram_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """The hash of the ``width`` words from each word on (whole grams only)."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    g = np.zeros(n, np.uint64)
    for j in range(width):
        g = mix(g * _ODD + h[j:j + n])
    return g
