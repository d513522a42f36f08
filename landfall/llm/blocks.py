"""Texts as blocks of word numbers: what the operators on word sequences join and count.

A block is one row that holds the words of some texts in order, as numbers into its own list
of distinct words. Blocks are cut at texts, so a block holds about ``most`` bytes or one longer
text, whatever the table holds. Counting over all texts then moves a block's distinct
words instead of its words, and what is found out about them comes back block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext

from landfall.llm.arrays import LOWER, word_hashes

BLOCK_BYTES = 4 << 20
HASHED_AT_ONCE = 1 << 17
WORD, BLANK, BREAK = 0, 1, 2


def byte_classes(blanks: bytes, breaks: bytes) -> np.ndarray:
    """What each byte is: of a word, a blank between words, or the end of a piece."""
    classes = np.full(256, WORD, np.uint8)
    classes[list(blanks)] = BLANK
    classes[list(breaks)] = BREAK
    return classes


def cut_words(texts: list[bytes], classes: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The lower-cased words of texts as a dictionary array, the text of each, and its piece.

    Pieces are numbered through and no piece reaches over two texts.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends_of_texts = np.cumsum(lengths + 1)
    raw = np.frombuffer(b"\x00".join([*texts, b""]).translate(LOWER), np.uint8)
    kinds = classes[raw]
    if len(raw):
        kinds[ends_of_texts - 1] = BREAK
    inside = np.zeros(len(raw) + 1, bool)
    inside[1:] = kinds == WORD
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    # The byte after each text is a break, so every word that starts also ends.
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = raw[inside[1:]]
    words = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    of_text = np.searchsorted(ends_of_texts, starts, "right")
    piece = np.cumsum(kinds == BREAK, dtype=np.int64)[starts]
    return words.dictionary_encode(), of_text, piece


def block_number(made: int) -> int:
    """A number no other block of the table has; stable once the table is written."""
    return TaskContext.get().partitionId() << 32 | made


def gathered(
    batches: Iterator[pa.RecordBatch], text: str, group: str | None, most: int = BLOCK_BYTES
) -> Iterator[tuple[object, list[tuple[dict, bytes]]]]:
    """Rows of a task gathered by group until a group's texts, or all of them, are many."""
    held: dict[object, list] = {}
    sizes: dict[object, int] = {}
    for batch in batches:
        others = batch.drop_columns([text]).to_pylist()
        for row, value in zip(others, batch.column(text), strict=True):
            key = row[group] if group else None
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            held.setdefault(key, []).append((row, raw))
            sizes[key] = sizes.get(key, 0) + len(raw) + 64
            while sizes and (sizes.get(key, 0) >= most or sum(sizes.values()) >= 4 * most):
                full = key if sizes.get(key, 0) >= most else max(sizes, key=sizes.__getitem__)
                sizes.pop(full)
                yield full, held.pop(full)
    yield from held.items()


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes: small ones cost little."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.dtype.itemsize).T
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(value: bytes, kind: type = np.int32) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_words(words: pa.Array) -> bytes:
    """Distinct words, none of which holds a line feed, as one compressed value."""
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()),
                                                    pc.cast(words, pa.string())), "\n")[0].as_py()
    return zstandard.ZstdCompressor(1).compress(f"{lines}\n".encode() if len(words) else b"")


def unpack_words(value: bytes) -> tuple[np.ndarray, pa.Array]:
    """The bytes of the words, end to end, and the words over them."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.uint8)
    breaks = np.flatnonzero(raw == 10)
    offsets = np.zeros(len(breaks) + 1, np.int32)
    offsets[1:] = breaks - np.arange(len(breaks))
    letters = raw[raw != 10]
    return letters, pa.Array.from_buffers(
        pa.string(), len(breaks), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])


def text_hashes(letters: np.ndarray, words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word or phrase, of its bytes alone."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[:len(words) + 1]
    out = np.zeros(len(words), np.uint64)
    start = 0
    while start < len(words):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + HASHED_AT_ONCE, "right")) - 1)
        low, high = offsets[start], offsets[stop]
        if high - low > HASHED_AT_ONCE:  # one very long word
            out[start] = xxhash.xxh64_intdigest(letters[low:high].tobytes())
        else:
            spans = offsets[start:stop + 1] - low
            out[start:stop] = word_hashes(letters[low:high], spans[:-1], spans[1:])
        start = stop
    return out
