"""Token counts of fields and sections from one encoding of the whole document.

A document is encoded once.  The tokens' byte spans follow from the vocabulary, and each span is
matched with the sections by binary search in their starts.  A token that crosses a boundary is
allocated by rule: to the section with most of its bytes (the earlier one if equal), or to that of
its first byte, or to that of its last byte.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
RULES = ("most", "first", "last")
COLUMNS = ["start_byte", "end_byte", "n_tokens", "n_crossing"]


@lru_cache(maxsize=2)
def encoder(path: str | None = None, pattern: str | None = None):
    """Encoding and byte length of every token; by default the public byte-level vocabulary."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("spans", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    lengths[list(ranks.values())] = [len(t) for t in ranks]
    return encoding, lengths


def line_sections(data: bytes) -> np.ndarray:
    """Starts of the lines that hold something; a line break belongs to the line before it."""
    at = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    at = at[at < len(data)]
    return np.concatenate([[0], at]) if data else np.empty(0, dtype=np.int64)


def allocate(ends: np.ndarray, starts: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens per section: ``ends`` of the tokens, ``starts`` of the sections."""
    begin = np.concatenate([[0], ends[:-1]])
    first, last = np.searchsorted(starts, begin, "right") - 1, np.searchsorted(starts, ends - 1, "right") - 1
    own = last if rule == "last" else first
    if rule == "most":
        own, limits = first.copy(), np.append(starts, size)
        for t in np.flatnonzero(first != last):
            sections = np.arange(first[t], last[t] + 1)
            held = np.minimum(limits[sections + 1], ends[t]) - np.maximum(limits[sections], begin[t])
            own[t] = sections[np.argmax(held)]
    return np.bincount(own, minlength=len(starts)), np.bincount(own[first != last], minlength=len(starts))


def section_tokens(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rule: str = "most", path: str | None = None,
    pattern: str | None = None, sections=line_sections, every: bool = False,
) -> DataFrame:
    """``(key, section, start_byte, end_byte, n_tokens, n_crossing)`` for every section of every document.

    ``sections`` gives the byte starts of the sections of a text in UTF-8 (the first is 0); by
    default its lines.  The tokens of a document's sections add up to those of the whole document.
    Null and empty texts have no section, or with ``every`` section 0 from byte 0 to 0 without tokens;
    rows that repeat a key are counted each.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    @F.pandas_udf("start_byte array<bigint>, end_byte array<bigint>, n_tokens array<bigint>, n_crossing array<bigint>")
    def count(texts: pd.Series) -> pd.DataFrame:
        encoding, lengths = encoder(path, pattern)
        out, none = [], np.zeros(int(every), dtype=np.int64)
        for value in texts:
            data = (value or "").encode("utf-8", "replace")
            if not data:
                out.append((none, none, none, none))
                continue
            ends = np.cumsum(lengths[encoding.encode_to_numpy(data.decode("utf-8"), disallowed_special=())])
            starts = sections(data)
            out.append((starts, np.append(starts[1:], len(data)), *allocate(ends, starts, len(data), rule)))
        return pd.DataFrame(out, columns=COLUMNS)

    # Never evaluated twice by a filter that moves below the projection.
    counted = docs.select(F.col(key).alias("key"), count.asNondeterministic()(F.col(text)).alias("c"))
    zipped = F.arrays_zip(*[F.col("c")[c].alias(c) for c in COLUMNS])
    parts = counted.select("key", F.posexplode(zipped).alias("section", "s"))
    return parts.select(F.col("key").alias(key), "section", *[f"s.{c}" for c in COLUMNS])


def document_tokens(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tokens per document from those of its sections."""
    return sections.groupBy(key).agg(F.sum("n_tokens").alias("n_tokens"), F.max("section").alias("last_section"))
