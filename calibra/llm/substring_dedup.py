"""Substring deduplication on windows of words.

A window of ``min_words`` words is repeated when a document with a smaller key holds the same words
in a row, or when they stood earlier in the same document without overlapping it.  Every word in a
repeated window is cut, so whatever is cut stands together, in that order, in one other place, and
periodic text is treated like any other.  Words are what white space separates; digests are 64 bits.

Shuffling every window would cost a row a word.  Each window is therefore stood for by the smallest
digest of the shorter shingles in it, which neighbouring windows mostly have in common (about a row
for five words) and which equal windows share wherever they stand, so no repeat is lost.  These
sketches are counted by digest; only windows whose sketch several documents hold are shuffled
themselves, counted before the shuffle, and come back to the documents by key, where no passage is
hot.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .chunks import word_starts
from .shared import fresh, row_key, store

MIN_WORDS = 16
_LAST = (1 << 63) - 1
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WORDS_AT_ONCE = 1 << 16


def _word_digests(data: bytes, words: np.ndarray) -> np.ndarray:
    out, at = np.empty(len(words), dtype=np.uint64), [*words[::_WORDS_AT_ONCE].tolist(), len(data)]
    for i, (a, b) in enumerate(zip(at, at[1:])):
        part = data[a:b].split()
        first = i * _WORDS_AT_ONCE
        out[first : first + len(part)] = np.fromiter(map(xxhash.xxh3_64_intdigest, part), dtype=np.uint64, count=len(part))
    return out


def _in_a_row(digests: np.ndarray, n: int) -> np.ndarray:
    """A digest of every ``n`` neighbours."""
    size = len(digests) - n + 1
    out = digests[:size].copy()
    for k in range(1, n):
        out *= _FACTOR
        out += digests[k : k + size]
    return out


def chunk_digests(data: bytes, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the words of a text; sketches and digests of its windows, one that begins at each word as long as they last."""
    words = word_starts(np.frombuffer(data, dtype=np.uint8)) if data else np.empty(0, dtype=np.int64)
    if len(words) < min_words:
        return words, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    digests = _word_digests(data, words)
    short = max(min_words // 2, 1)
    shingles, size = _in_a_row(digests, short), len(words) - min_words + 1
    sketches = shingles[:size].copy()
    for k in range(1, min_words - short + 1):
        np.minimum(sketches, shingles[k : k + size], out=sketches)
    return words, sketches.view(np.int64), _in_a_row(digests, min_words).view(np.int64)


def repeated_spans(
    data: bytes, foreign: dict[int, int], min_words: int = MIN_WORDS
) -> list[tuple[int, int, int | None]]:
    """Byte spans ``(start, end, key)`` to cut: ``key`` of the document that keeps most windows of the run, None for this one."""
    words, _, windows = chunk_digests(data, min_words)
    if not len(windows):
        return []
    _, first, same = np.unique(windows, return_index=True, return_inverse=True)
    again = np.arange(len(windows)) - first[same] >= min_words
    if foreign:
        again |= np.isin(windows, np.fromiter(foreign, dtype=np.int64, count=len(foreign)))
    marks = np.flatnonzero(again)
    if not len(marks):
        return []
    # Windows that overlap or touch are one run.
    breaks = np.flatnonzero(np.diff(marks) > min_words) + 1
    limits = np.append(words, len(data))

    def keeper(run):
        owners = Counter(foreign.get(d, _LAST) for d in windows[run].tolist())
        most = min(owners, key=lambda o: (-owners[o], o))
        return None if most == _LAST else most

    return [(int(limits[r[0]]), int(limits[r[-1] + min_words]), keeper(r)) for r in np.split(marks, breaks)]


def cut_out(data: bytes, spans: list[tuple[int, int, int | None]]) -> str:
    kept, at = [], 0
    for start, end, _ in spans:
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")


def dedup_substrings(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with their texts cut, and the column ``spans`` under the name given back.

    ``spans`` lists what was cut: byte start and end in the old text, and the key of the document
    that keeps most of the passage (the row's own key for a repeat within the text).  The document with the
    smallest key keeps a passage; rows without key come last, and rows that repeat a key are one
    document that cuts nothing of its own.  Null texts stay null, empty ones empty; no rows give no
    rows.
    """
    names = dict(zip(("spans",), fresh(docs, "spans")))
    k1, k2, cut = fresh(docs, "__k1", "__k2", "__cut")
    id_, hash_ = row_key(key, text)
    id_ = F.when(F.col(key).isNull(), F.lit(_LAST)).otherwise(id_)

    @F.pandas_udf("array<bigint>")
    def sketches(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(chunk_digests((t or "").encode("utf-8", "replace"), min_words)[1]) for t in texts])

    @F.pandas_udf("array<bigint>")
    def windows(texts: pd.Series, shared: pd.Series) -> pd.Series:
        out = []
        for value, held in zip(texts, shared):
            _, sketch, window = chunk_digests(value.encode("utf-8", "replace"), min_words)
            out.append(np.unique(window[np.isin(sketch, held)]))
        return pd.Series(out)

    def several(held, name):
        """Digests that rows of several keys hold, with the smallest key."""
        shared = held.groupBy("digest").agg(F.min("k1").alias("owner"), F.max("k1").alias("other"))
        return store(shared.where("owner < other").select("digest", "owner"), name)

    keyed = docs.select(id_.alias("k1"), hash_.alias("k2"), F.col(text).alias("t"))
    held = keyed.select("k1", "k2", F.explode(sketches.asNondeterministic()(F.col("t"))).alias("digest"))
    likely = held.join(several(held, "shared-sketches"), "digest").groupBy("k1", "k2")
    likely = store(likely.agg(F.collect_set("digest").alias("s")), "likely")
    held = keyed.join(likely, ["k1", "k2"])
    held = held.select("k1", "k2", F.explode(windows.asNondeterministic()(F.col("t"), F.col("s"))).alias("digest"))
    # Read twice below, and each time the texts would be joined again.
    held = store(held, "windows")
    foreign = held.join(several(held, "shared-windows"), "digest").where("owner <> k1").groupBy("k1", "k2")
    foreign = foreign.agg(F.collect_set(F.struct("digest", "owner")).alias("f"))
    lists = store(
        foreign.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("f.digest").alias("d"), F.col("f.owner").alias("o")),
        "foreign-windows",
    )

    @F.pandas_udf("text string, start array<bigint>, end array<bigint>, owner array<bigint>")
    def clean(texts: pd.Series, d: pd.Series, o: pd.Series) -> pd.DataFrame:
        out, none = [], np.empty(0, dtype=np.int64)
        for value, ds, os in zip(texts, d, o):
            if not value:
                out.append((value, none, none, none))
                continue
            data = value.encode("utf-8", "replace")
            lookup = dict(zip(ds.tolist(), os.tolist())) if ds is not None else {}
            spans = repeated_spans(data, lookup, min_words)
            starts, ends, owners = ([s[i] for s in spans] for i in range(3))
            owners = [_LAST if o is None else o for o in owners]
            out.append((cut_out(data, spans) if spans else value, starts, ends, owners))
        return pd.DataFrame(out, columns=["text", "start", "end", "owner"])

    whole = docs.withColumns({k1: id_, k2: hash_}).join(lists, [k1, k2], "left")
    whole = whole.withColumn(cut, clean.asNondeterministic()(F.col(text), F.col("d"), F.col("o")))
    spans = F.transform(
        F.arrays_zip(F.col(cut)["start"], F.col(cut)["end"], F.col(cut)["owner"]),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.when(s["owner"] == _LAST, F.col(key).cast("bigint")).otherwise(s["owner"]).alias("kept_in"),
        ),
    )
    columns = [F.col(cut)["text"].alias(c) if c == text else F.col(c) for c in docs.columns]
    return whole.select(*columns, spans.alias(names["spans"])), names
