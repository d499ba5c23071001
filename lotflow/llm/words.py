"""Words of whole texts as 64-bit hashes, a batch of texts at a time.

The hash of a word is the sum of ``value(byte) * base ** place`` modulo 2**64,
with random values, then mixed. Two words of different bytes share a hash with a
chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: Odd factors of the places of a word in a run of words.
_FACTORS = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def byte_values(separators: bytes) -> np.ndarray:
    """Hash value of each byte: 0 for those that end a word, A-Z as a-z."""
    values = _VALUES.copy()
    for c in range(65, 91):
        values[c] = values[c + 32]
    values[np.frombuffer(separators, np.uint8)] = 0
    return values


#: Words without blanks and the control characters 9 to 13.
BLANK_CUT = byte_values(bytes([32, *range(9, 14)]))
#: Words of digits, letters a-z and all characters above ASCII.
SIGN_CUT = byte_values(bytes(c for c in range(128) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123)))

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def hash_words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``data[offsets[i]:offsets[i + 1]]``, and where each text's words begin."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    value = values[data]
    inside = value != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    power, inverse = _power(n)
    value *= power[:n]
    return mix(np.add.reduceat(value, starts) * inverse[starts]), bounds


def word_chunks(texts: pa.Array, values: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text, word hashes and word bounds of consecutive chunks of a text column; null counts as empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1)
        part = offsets[begin : end + 1]
        hashes, bounds = hash_words(data[part[0] : part[-1]], part - part[0], values)
        yield begin, hashes, bounds
        begin = end


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; the last ``n - 1`` places have none."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for i in range(n):
        total += hashes[i : i + count] * _FACTORS[i]
    return mix(total)
