"""Word shingles of a text as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))   # A-Z alone
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
_S = np.uint64(32)
_KNOWN = 200_000   # words remembered by a worker


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case."""
    return text.encode().translate(_LOWER).split()   # bytes.split() parts at exactly these signs


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _S)) * _B
    x = (x ^ (x >> _S)) * _C
    return x ^ (x >> _S)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


_hashes = _Hashes()


def shingle_set(text: str | None, n: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; of the whole sequence if
    the text has fewer words; empty without words."""
    found = words(text) if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix(out * _A + h[i:len(h) - n + 1 + i])
    return np.unique(out)
