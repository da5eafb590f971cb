"""Content-defined chunking with a gear rolling hash, in numpy.

The hash of a place depends on the bytes just before it only, so equal passages are cut alike
wherever they stand, and an insertion moves no cut beyond its own surroundings.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def gear_table(bits: int, seed: int = 5) -> np.ndarray:
    """A random number per byte; all white space counts as the same byte."""
    table = np.random.default_rng([seed, bits]).integers(0, 1 << bits, 256, dtype=np.uint64)
    table[_SPACE] = table[32]
    return table.astype(np.uint16)


_GEAR = gear_table(16)


def rolling(data: np.ndarray) -> np.ndarray:
    """``h[i]`` of the 16 bytes that end at ``i``: the sum of their gear numbers, each shifted by its distance.

    The sum over a window is doubled in length by one shifted addition.
    """
    h, width = _GEAR[data], 1
    while width < 16:
        wider = h.copy()
        wider[width:] += h[:-width] << h.dtype.type(width)
        h, width = wider, 2 * width
    return h


def word_starts(data: np.ndarray) -> np.ndarray:
    space = _SPACE[data]
    return np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))


def run_starts(data: np.ndarray) -> np.ndarray:
    """Places where white space begins after something else."""
    space = _SPACE[data]
    return np.flatnonzero(space[1:] & ~space[:-1]) + 1


def word_chunks(data: np.ndarray, zero_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of chunks at word starts, and all word starts.

    A chunk begins where the top ``zero_bits`` of the 16-bit hash are zero, on average after
    ``2 ** zero_bits`` words, and at the first word.
    """
    words = word_starts(data)
    if not len(words):
        return words, words
    h = rolling(data)
    cut = h[words - 1] < 1 << (16 - zero_bits)
    cut[0] = True
    return words[cut], words


def byte_chunks(data: np.ndarray, zero_bits: int) -> np.ndarray:
    """Starts of chunks of about ``2 ** zero_bits`` bytes, never inside a UTF-8 sequence."""
    if not len(data):
        return np.empty(0, dtype=np.int64)
    cut = np.flatnonzero(rolling(data)[:-1] < 1 << (16 - zero_bits)) + 1
    return np.concatenate([[0], cut[(data[cut] & 0xC0) != 0x80]])
