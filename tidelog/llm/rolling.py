"""Vectorised rolling fingerprints and winnowed anchors over a batch of texts (numpy, inside tasks).

A *symbol* is a word (its 64-bit fingerprint) or a byte.  A batch of texts is one flat array of
symbols plus the index of each text's first symbol, so every step below is one numpy pass over the
batch instead of a loop over texts.

Fingerprints are polynomials modulo 2**64 over randomised symbol values, finished with a bijective
mixer.  They only depend on the symbols, never on the batch, task or machine.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}
#: Powers of each kind that stay when a task is over.
KEPT = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift / multiply), in place on a fresh array."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD6E8FEB86659FD93))


def _pow(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else 2 * len(have))
        p = np.full(size, _BASE if kind == "up" else _BASE_INV, dtype=np.uint64)
        p[0] = U(1)
        have = _powers[kind] = np.cumprod(p, dtype=np.uint64)
    return have[:n]


def forget() -> None:
    """Lets go of the powers beyond ``KEPT``: those of one long text would stay with an idle worker for good."""
    for kind, have in _powers.items():
        if len(have) > KEPT:
            _powers[kind] = have[:KEPT].copy()


class Prefix:
    """Prefix sums of ``value[i] * base**i``: the fingerprint of any range in O(1)."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.n = n
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _pow("up", n), out=self.sums[1:], dtype=np.uint64)
        self.inv = _pow("down", n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed fingerprints of ``[start, end)``, the length included."""
        raw = (self.sums[end] - self.sums[start]) * self.inv[start]
        return mix(raw ^ ((end - start).astype(np.uint64) * U(0xA0761D6478BD642F)))

    def windows(self, width: int) -> np.ndarray:
        """Mixed fingerprints of all ``n - width + 1`` windows of one width."""
        m = self.n - width + 1
        if m <= 0:
            return np.zeros(0, dtype=np.uint64)
        raw = (self.sums[width:] - self.sums[:m]) * self.inv[:m]
        return mix(raw ^ U((width * 0xA0761D6478BD642F) & 0xFFFFFFFFFFFFFFFF))


def word_bounds(buf: np.ndarray, text_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of concatenated UTF-8 texts: byte start and end of each word, and
    for every text (plus one closing entry) the index of its first word.  ``text_start`` has the byte
    index of each text and the total length at its end.  Words never cross texts."""
    n = len(buf)
    is_word = np.ones(n + 2, dtype=bool)
    is_word[0] = is_word[-1] = False
    is_word[1:-1] = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    begins = is_word[1:-1] & ~is_word[:-2]
    ends = is_word[1:-1] & ~is_word[2:]
    # a text's first byte begins a word even when the previous text ended inside one
    firsts = text_start[:-1][text_start[:-1] < text_start[1:]]
    firsts = firsts[is_word[firsts + 1]]
    begins[firsts] = True
    inner = firsts[firsts > 0]
    ends[inner[is_word[inner]] - 1] = True
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, text_start)


def word_prints(buf: np.ndarray, start: np.ndarray, end: np.ndarray, limit: int = 1 << 18) -> np.ndarray:
    """64-bit fingerprint of every word ``buf[start:end]``, about ``limit`` bytes at a time."""
    out = np.zeros(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + limit, side="right")))
        lo = int(start[i])
        prefix = Prefix(BYTE_VALUES[buf[lo:int(end[j - 1])]])
        out[i:j] = prefix.ranges(start[i:j] - lo, end[i:j] - lo)
        i = j
    return out


def fold_ascii(buf: np.ndarray) -> np.ndarray:
    """Lower-case A-Z only."""
    out = buf.copy()
    upper = (buf >= 65) & (buf <= 90)
    out[upper] += 32
    return out


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest gram in each run of ``width`` consecutive grams (leftmost of equals).

    The 40 high bits decide and the index in the low 24 bits breaks ties, so the choice only depends
    on the grams seen.  Batches must stay under 2**24 grams.
    """
    m = len(grams) - width + 1
    if m <= 0:
        return np.zeros(0, dtype=np.int64)
    if len(grams) >= 1 << 24:
        raise ValueError("a batch must have fewer than 2**24 symbols")
    low = (grams & U(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:m], low[width - span:width - span + m])
    return (low & U(0xFFFFFF)).astype(np.int64)
