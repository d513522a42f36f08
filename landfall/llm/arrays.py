"""Numpy helpers that the tasks of several operators share: words, hashes, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANKS = b"\t\n\x0b\x0c\r "
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(BLANKS)] = False
_BASE = 0x9E3779B97F4A7C15 | 1
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (in a new array)."""
    out = values ^ (values >> np.uint64(33))
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(33)
    return out


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(max(count, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLE = 1 << 18
_POWERS = powers(_BASE, _TABLE)
_INVERSES = powers(pow(_BASE, -1, 2**64), _TABLE)


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words ``[^\\x20\\x09-\\x0D]+`` of a byte array start and end."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _IS_WORD[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, of its bytes alone."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    if len(raw) < _TABLE:  # sums up to each byte, brought back to the word's own start
        terms = raw.astype(np.uint64)
        terms += np.uint64(1)
        terms *= _POWERS[:len(raw)]
        upto = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(terms, out=upto[1:])
        sums = (upto[ends] - upto[starts]) * _INVERSES[starts]
    else:  # the same sums, by the place of each byte in its word
        table = _POWERS if (longest := int(lengths.max())) <= _TABLE else powers(_BASE, longest)
        offsets = np.cumsum(lengths) - lengths
        terms = raw[_IS_WORD[raw]].astype(np.uint64)
        terms += np.uint64(1)
        terms *= table[np.arange(len(terms)) - np.repeat(offsets, lengths)]
        sums = np.add.reduceat(terms, offsets)
    sums += lengths.astype(np.uint64) << np.uint64(56)
    return mix(sums)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, in order; none if there are fewer."""
    count = len(words) - size + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    out = words[:count].copy()
    for k in range(1, size):
        out *= np.uint64(_BASE)
        out += words[k:k + count]
    return mix(out)


def byte_gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` bytes, built by doubling; none if there are fewer."""
    if len(raw) < size:
        return np.zeros(0, np.uint64)
    power = raw.astype(np.uint64) + np.uint64(1)
    out, done, width, scale = None, 0, 1, _BASE
    while True:
        if size & width:
            if out is None:
                out, done = power, width
            else:
                scale_out = np.uint64(pow(_BASE, width, 2**64))
                keep = len(raw) - done - width + 1
                out = out[:keep] * scale_out + power[done:done + keep]
                done += width
        if done == size:
            return mix(out)
        keep = len(power) - width
        power = power[:keep] * np.uint64(scale) + power[width:width + keep]
        scale, width = scale * scale % 2**64, width * 2


def raw_texts(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes."""
    return (value.as_buffer().to_pybytes() if value.is_valid else None for value in column)


def pieces(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``most`` bytes, or one longer text."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > most:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)
