"""Hashed n-gram counts of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 500_000  # bytes of text that are counted at a time; numpy needs some 70 times as much for them


def _codes(kind: str) -> np.ndarray:
    """What a byte is counted as. letters: ASCII letters in lower case and bytes beyond ASCII, all else is a blank.
    raw: itself. shape: A, a, 0, blank, or the mark itself."""
    code = np.arange(256, dtype=np.uint8)
    upper, lower = slice(65, 91), slice(97, 123)
    if kind == "letters":
        code[:128] = 32
        code[lower] = np.arange(97, 123)
        code[upper] = np.arange(97, 123)
    elif kind == "shape":
        code[upper], code[lower], code[48:58], code[128:] = 65, 97, 48, 97
        code[[9, 10, 13]] = 32
    return code


CODES = {kind: _codes(kind) for kind in ("letters", "raw", "shape")}


def spread(values: np.ndarray, size: int) -> np.ndarray:
    """A multiplicative hash below ``size``, a power of two."""
    return ((values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (size.bit_length() - 1))).astype(
        np.int64
    )


def ngram_counts(texts: list[bytes], kind: str, n: int, size: int) -> np.ndarray:
    """A row of n-gram counts, hashed to ``size`` columns, for each text; blanks stand around each text. Of the shape,
    runs of equal codes count once."""
    lengths = np.array([len(t) + 2 for t in texts], dtype=np.int64)
    data = CODES[kind][np.frombuffer(b" " + b"  ".join(texts) + b" ", dtype=np.uint8)]
    doc = np.repeat(np.arange(len(texts)), lengths)
    if kind in ("shape", "letters"):
        keep = np.ones(len(data), dtype=bool)
        same = (data[1:] == data[:-1]) & (doc[1:] == doc[:-1])
        keep[1:] = ~(same if kind == "shape" else same & (data[1:] == 32))
        data, doc = data[keep], doc[keep]
    if len(data) < n:
        return np.zeros((len(texts), size), dtype=np.float32)
    last = len(data) - n + 1
    gram = np.zeros(last, dtype=np.uint64)
    for i in range(n):
        gram = (gram << np.uint64(8)) | data[i : i + last]
    own = doc[:last] == doc[n - 1 :]
    cell = (doc[:last] * size + spread(gram, size))[own]
    return np.bincount(cell, minlength=len(texts) * size).reshape(len(texts), size).astype(np.float32)


def pieces(texts: list[bytes], most_rows: int = 64) -> Iterator[slice]:
    """Consecutive slices of the texts with a bounded number of rows and bytes; one long text makes a slice alone."""
    start, used = 0, 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= most_rows or used + len(text) > PIECE):
            yield slice(start, i)
            start, used = i, 0
        used += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)
