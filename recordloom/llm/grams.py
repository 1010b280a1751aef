"""Hashes of words and shingles for batches of texts, with numpy inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Texts are hashed in pieces of about this many bytes, so that memory does not follow the batch.
PIECE_BYTES = 512 * 1024

_numbers = np.random.default_rng(7)
BYTE = _numbers.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
SOLID = np.ones(256, dtype=bool)
SOLID[[32, 9, 10, 11, 12, 13]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
STEP = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts of about ``limit`` bytes; null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and where each text's words begin (one entry more than texts)."""
    if not len(data):
        return np.empty(0, U), np.zeros(len(offsets), np.int64)
    solid = SOLID[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    opens[starts] = solid[starts]
    first = np.flatnonzero(opens)
    if not len(first):
        return np.empty(0, U), np.zeros(len(offsets), np.int64)
    word = np.cumsum(opens)[solid] - 1
    lengths = np.bincount(word, minlength=len(first))
    heads = np.cumsum(lengths) - lengths
    place = np.arange(len(word)) - heads[word]
    powers = np.cumprod(np.full(int(lengths.max()), STEP))
    values = BYTE[FOLD[data[solid]]] * powers[place]
    return mix(np.add.reduceat(values, heads) + lengths.astype(U)), np.searchsorted(first, offsets)


def fold(h: np.ndarray, count: int, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbours, ``count`` of them."""
    out = h[:count]
    for j in range(1, width):
        out = mix(out * STEP + h[j : j + count])
    return out


def shingle_lists(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """(row, shingle hashes in text order, words) of every text.

    A text with fewer words than ``width`` has its whole sequence as one shingle; without words it has none.
    """
    for row, data, offsets in pieces(column):
        h, bounds = word_hashes(data, offsets)
        runs = fold(h, len(h) - width + 1, width) if len(h) >= width else h[:0]
        for i in range(len(offsets) - 1):
            a, b = int(bounds[i]), int(bounds[i + 1])
            n = b - a
            if n >= width:
                yield row + i, runs[a : b - width + 1], n
            elif n:
                # the tag keeps short sequences apart from runs of full width
                yield row + i, mix(fold(h[a:b], 1, n) + U(n)), n
            else:
                yield row + i, h[:0], 0
