"""Words and word shingles of many texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

PRIME = np.uint64(0x100000001B3)
INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(48, 58), *range(97, 123), 95, *range(128, 256)]] = True
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[32, *range(9, 14)]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    values = np.full(n, base, dtype=np.uint64)
    if n:
        values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


def hashed_runs(texts: list[bytes], inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of bytes that are ``inside`` in a row, where each begins and ends in its text, and where each
    text's runs begin, with the end last."""
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    within = inside[data]
    edges = np.flatnonzero(within[1:] != within[:-1]) + 1
    start, end = edges[::2], edges[1::2]
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((data + np.uint64(1)) * powers(PRIME, len(data)), dtype=np.uint64)))
    value = (sums[end] - sums[start]) * powers(INVERSE, len(data))[start] + (end - start).astype(np.uint64)
    begins = np.cumsum([1] + [len(t) + 1 for t in texts])
    first = np.searchsorted(start, begins)
    offset = np.repeat(begins[:-1], np.diff(first))
    return mixed(value), start - offset, end - offset, first


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts in a row, and where each text's words begin, with the end last.
    A word is a run of letters, digits, underscores and characters beyond ASCII."""
    value, _, _, first = hashed_runs([(t or "").lower().encode("utf-8") for t in texts], IN_WORD)
    return value, first


def shingle_hashes(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The hashes of each text's runs of ``n`` words, repeats included; of a shorter text one hash for all its words."""
    words, begins = word_hashes(texts)
    found = []
    scale = powers(np.uint64(0x9E3779B97F4A7C15), n + 1)[1:]
    whole = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for i in range(n if len(whole) else 0):
        whole += words[i : i + len(whole)] * scale[i]
    whole = mixed(whole)
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        if b - a >= n:
            found.append(whole[a : b - n + 1])
        elif b > a:
            found.append(mixed((words[a:b] * scale[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            found.append(np.zeros(0, dtype=np.uint64))
    return found
