"""Fill-in-middle transformation with unit ends found eight bytes at a time.

The texts of a batch lie one after another as UTF-8 and are read as 64-bit words.

1. Arithmetic on a word marks, in the high bit of each byte, white space, the bytes that end a unit
   and the bytes that begin a code point.
2. The marks of a word are counted by its bits; running sums over the words turn "the k-th unit end
   of this text" into a search for one word.
3. Inside the word the lowest marks are cleared until the wanted one is left.

All three steps are numpy operations over the whole batch; only the output texts are put together
one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .shared import fresh

SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Bytes of text that are worked on at once; a longer text is worked on alone.
BYTES_AT_ONCE = 4 << 20
FIELDS = ["n", "form", "prefix_chars", "middle_chars", "output"]

_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_ONE = np.uint64(1)


def _bytes_of(value: int) -> np.uint64:
    return np.uint64(value * 0x0101010101010101)


def space_marks(words: np.ndarray) -> np.ndarray:
    """High bits of the bytes 0x20 and 0x09 to 0x0D."""
    low = words & _LOW7
    other = words ^ _bytes_of(0x20)
    blank = ~(((other & _LOW7) + _LOW7) | other)
    control = (low + _bytes_of(0x80 - 0x09)) & ~(low + _bytes_of(0x80 - 0x0E)) & ~words
    return (blank | control) & _HIGH


def char_marks(words: np.ndarray) -> np.ndarray:
    """High bits of the bytes that begin a code point: all but 10xxxxxx."""
    return ~(words & ~(words << _ONE)) & _HIGH


class Marks:
    """Marked bytes with counts up to any byte and the place of any mark."""

    def __init__(self, words: np.ndarray):
        # One word more, so that the end of the data has one as well.
        self.words = np.append(words, np.uint64(0))
        self.until = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def before(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before ``at``."""
        word = at >> 3
        part = self.words[word]
        below = (_ONE << ((at & 7) << 3).astype(np.uint64)) - _ONE
        return self.until[word] - np.bitwise_count(part).astype(np.int64) + np.bitwise_count(part & below).astype(np.int64)

    def place(self, k: np.ndarray) -> np.ndarray:
        """Byte of the ``k``-th mark, from 1."""
        word = np.searchsorted(self.until, k, "left")
        left = self.words[word]
        skip = k - (self.until[word] - np.bitwise_count(left).astype(np.int64)) - 1
        for step in range(7):
            left = np.where(skip > step, left & (left - _ONE), left)
        lowest = left & (~left + _ONE)
        return (word << 3) + (np.bitwise_count(lowest - _ONE).astype(np.int64) >> 3)


def words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian words, the last one filled up with zeros."""
    out = np.zeros(-(-len(data) // 8) * 8, dtype=np.uint8)
    out[: len(data)] = data
    return out.view("<u8").astype(np.uint64, copy=False)


def unit_ends(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Marks of the bytes that end a unit; ``last`` are the last bytes of the texts.

    A unit ends where white space follows something else, and with the text.
    """
    space = space_marks(words)
    following = (space >> np.uint64(8)) | (np.append(space[1:], np.uint64(0)) << np.uint64(56))
    ends = ~space & following
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7) << 3).astype(np.uint64))
    return ends


def split_units(texts: pa.Array) -> tuple[memoryview, np.ndarray, Marks, Marks]:
    """Bytes of all texts, the bounds of each (one more than texts), unit ends and code points."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    view = memoryview(buffer)[int(offsets[0]) : int(offsets[-1])] if buffer is not None and len(offsets) else memoryview(b"")
    bounds = offsets - offsets[0]
    words = words_of(np.frombuffer(view, dtype=np.uint8))
    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    return view, bounds, Marks(unit_ends(words, last)), Marks(char_marks(words))


def cut(texts: pa.Array, h: list[np.ndarray], fim_percent: int, spm_percent: int) -> pa.StructArray:
    """The fields of the result for a batch of texts without nulls and their four hash numbers."""
    view, bounds, ends, chars = split_units(texts)
    start, stop = bounds[:-1], bounds[1:]
    before = ends.before(start)
    n = ends.before(stop) - before
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    plain = (n == 0) | (h[2] % 100 >= fim_percent)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(texts, marker).to_numpy(zero_copy_only=False)
    spm = h[3] % 100 < spm_percent

    def byte_after(units):
        at = start.copy()
        some = units > 0
        at[some] = ends.place((before + units)[some]) + 1
        return at

    first, second = byte_after(np.minimum(a, b)), byte_after(np.maximum(a, b))
    lengths = [chars.before(y) - chars.before(x) for x, y in ((start, first), (first, second))]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    output = []
    for kept, turned, i, j, k, end in zip(plain.tolist(), spm.tolist(), start.tolist(), first.tolist(), second.tolist(), stop.tolist()):
        if kept:
            output.append(view[i:end])
        elif turned:
            output.append(b"".join((s, view[k:end], p, view[i:j], m, view[j:k])))
        else:
            output.append(b"".join((p, view[i:j], s, view[k:end], m, view[j:k])))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    arrays = [pa.array(n), pa.array(form.tolist(), pa.string()), *(pa.array(x, mask=plain) for x in lengths), pa.array(output, pa.binary()).cast(pa.string())]
    return pa.StructArray.from_arrays(arrays, names=FIELDS)


def cut_in_parts(texts: pa.Array, h: list[np.ndarray], *percents: int) -> pa.Array:
    """``cut`` of some rows at a time, whatever the size of the batch."""
    part = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // BYTES_AT_ONCE
    at = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return pa.concat_arrays([cut(texts.slice(a, b - a), [x[a:b] for x in h], *percents) for a, b in zip(at, at[1:])])


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
    fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns n, form, prefix_chars, middle_chars and output, and their names in the result.

    A unit is a word with the white space before it; white space at the end of a text is one too.
    Two cuts between units, the form and whether a text is turned at all come from the digest of
    ``seed:key``, so a run, a lost executor and another partitioning give the same result.  Empty
    texts and those that hold a marker stay plain, with null lengths.  A null text counts as empty;
    a null key enters the digest as an empty string; rows that repeat a key have the same draw.  Other
    columns pass through, and the new ones are named apart from them; no rows give no rows.
    """
    names = dict(zip(FIELDS, fresh(docs, *FIELDS)))
    made = fresh(docs, "__fim")[0]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]

    @F.arrow_udf("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    def cut_batch(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        return cut_in_parts(texts, [h.to_numpy(zero_copy_only=False) for h in (h1, h2, h3, h4)], fim_percent, spm_percent)

    out = docs.withColumn(made, cut_batch.asNondeterministic()(F.coalesce(F.col(text), F.lit("")), *numbers))
    return out.select(*docs.columns, *[F.col(made)[f].alias(names[f]) for f in FIELDS]), names


def restore(output: str, form: str) -> Column:
    """The text behind an output; no text holds a marker unless it is plain."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    at = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    turned = {f: F.concat(*[F.get(parts, F.lit(i)) for i in order]) for f, order in at.items()}
    return F.when(F.col(form) == "psm", turned["psm"]).when(F.col(form) == "spm", turned["spm"]).otherwise(F.col(output))
