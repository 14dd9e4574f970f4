"""64-bit hashes of words and of runs of words, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

#: An odd multiplier for bytes, one for words, and the constants of a well-known 64-bit mixer.
BYTE, WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well-spread function of 64-bit numbers, one to one."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    x ^= x >> np.uint64(30)
    x *= MIX[0]
    x ^= x >> np.uint64(27)
    x *= MIX[1]
    x ^= x >> np.uint64(31)
    return x


#: What each byte adds to its word's hash, before the powers.
VALUES = mix(LOWER.astype(np.uint64), 1)
#: Powers that a task keeps of each base, at most; longer rows of them are worked out anew.
KEPT = 1 << 22
_kept: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base squared and so on, n of them."""
    known = _kept.get(int(base))
    if known is None or len(known) < n:
        out = np.full(max(n, 1 << 18), base, dtype=np.uint64)
        out[:1] = 1
        known = np.multiply.accumulate(out)
        if len(known) <= KEPT:
            _kept[int(base)] = known
    return known[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end, each word's first byte, its end), A-Z lower-cased.

    A word's hash is a polynomial of its bytes, mixed. Bytes are counted in the texts put together
    with a blank after each.
    """
    flat = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    space = np.concatenate([[True], SPACE[flat], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    begin, end = edges[0::2], edges[1::2]
    stops = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(begin, stops)
    if not len(begin):
        return np.zeros(0, np.uint64), first, begin, end
    # Horner's rule backwards: the sum of byte * base**place, divided by base**begin through its inverse
    powers = _powers(BYTE, len(flat))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[flat] * powers)])
    inverse = np.uint64(pow(int(BYTE), -1, 2**64))
    values = (sums[end] - sums[begin]) * _powers(inverse, len(flat))[begin]
    return mix(values + (end - begin).astype(np.uint64)), first, begin, end


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n words in a row from each word on that has so many, across all texts."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total *= WORD
        total += words[i : len(words) - n + 1 + i]
    return mix(total, n)


def long_runs(words: np.ndarray, n: int) -> np.ndarray:
    """As ``runs``, at a cost that does not grow with n, for many words in a row."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    powers, inverse = _powers(WORD, len(words)), np.uint64(pow(int(WORD), -1, 2**64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    return mix((sums[n:] - sums[:-n]) * _powers(inverse, len(words) - n + 1), n)


def shingle_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """Of each text, the distinct hashes of n words in a row, sorted; of fewer words, of all as one; of none, nothing."""
    words, first, _, _ = word_hashes(texts)
    all_runs = runs(words, n)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(all_runs[a : b - n + 1]))
        else:
            out.append(runs(words[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return out
