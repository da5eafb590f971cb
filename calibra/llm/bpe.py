"""BPE encoding with reuse of content-defined chunks, and decoding.

1. A rolling hash cuts every text into chunks; digests that several documents hold are *shared*,
   and the smallest row key that holds one *owns* it.
2. Every shared chunk is encoded once, by its owner: its core, from the first to the last start of
   white space in it.  The rims belong to the text between cores, so every join is encoded again
   together with its surroundings.
3. Documents that hold shared chunks get the ids of the cores by digest; what lies between them is
   encoded as one run.  At each end of a core the piece before and after it are encoded apart and
   together.  Where the ids do not agree exactly the chunk gives up its core and joins the run, so
   the run grows until they do.
4. Documents without shared chunks are encoded in place and never shuffled, as long as the list of
   those that have some is small enough to broadcast.

Cores begin and end where white space starts, which no token of a vocabulary that splits texts at
white space crosses; the agreement is checked all the same.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from hashlib import blake2b
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .chunks import byte_chunks, run_starts
from .shared import give_back, row_key, slices, store

VOCABULARY = "word_bpe_49k.json"
ZERO_BITS = 9
# So many row numbers of 8 bytes may be broadcast.
BROADCAST_ROWS = 2_000_000
_BATCH_CHARS, _RUN_BYTES = 1_000_000, 250_000
# The table of pieces in a worker: bytes it may take, what an entry takes beside its piece and ids, longest piece kept.
_KNOWN_BYTES, _ENTRY_BYTES, _LONG = 64 << 20, 200, 64
_PIECE = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


@lru_cache(maxsize=2)
def tokenizer(path: str | None = None):
    """The tokenizer of a file, without truncation and padding; by default the public word vocabulary."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=2)
def splits_at_space(path: str | None = None) -> bool:
    """Whether pieces that begin where white space starts have the same ids apart as in one text.

    Tried on a text of words, numbers, marks and all kinds of white space.
    """
    words = ["The", "cat's", "1234", "a1b2", "x,y.", "...", "É", "ßü", "日本", "don't", "<|x|>", "!!", "'s", "_", "-"]
    spaces = [" ", "  ", "\n", "\n\n", "\t", " \n ", "\r\n"]
    text = "".join(s + w + t + v for s in spaces for t in spaces for w, v in zip(words, words[3:] + words[:3]))
    whole, *parts = tokenizer(path).encode_batch_fast([text, *_PIECE.findall(text)], add_special_tokens=False)
    return whole.ids == [i for e in parts for i in e.ids]


class _Pieces(dict):
    """Packed ids of pieces that this worker has encoded, and the bytes they take."""

    size = 0

    def learn(self, pieces: list[str], ids: list[bytes]) -> None:
        self.update(zip(pieces, ids))
        self.size += sum(map(len, pieces)) + sum(map(len, ids)) + _ENTRY_BYTES * len(pieces)

    def clear(self) -> None:
        super().clear()
        self.size = 0


@lru_cache(maxsize=2)
def _known(path: str | None) -> _Pieces:
    return _Pieces()


@lru_cache(maxsize=2)
def _known_words(path: str | None) -> _Pieces:
    """The same for the words of pieces, which other pieces share."""
    return _Pieces()


def _end_of_task(path: str | None) -> None:
    """The worker lives on, and the next task has other texts."""
    _known(path).clear()
    _known_words(path).clear()
    give_back()


def _encode(texts: list[str], path: str | None) -> list[bytes]:
    # An unsigned int has 4 bytes; numpy takes care of machines with another byte order.
    found, at, t = [], 0, tokenizer(path)
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _BATCH_CHARS):
            size += len(texts[end])
            end += 1
        encoded = t.encode_batch_fast(texts[at:end], add_special_tokens=False)
        found += [np.frombuffer(array("I", e.ids), dtype="=u4").astype("<u4", copy=False).tobytes() for e in encoded]
        at = end
    return found


# The steps of a vocabulary that lowers text and drops white space, and what its pattern cuts
# out of a lower-case piece of printable ASCII.
_LOWERING = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_BLANK = " \t\n\x0b\x0c\r"


@lru_cache(maxsize=2)
def _lowers(path: str | None) -> bool:
    """Whether the tokenizer of a file has just the steps that ``_ASCII_WORDS`` stands for."""
    spec = json.loads(tokenizer(path).to_str())
    first, second = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    steps = first.get("normalizers", [])
    cuts = second.get("pretokenizers", [])
    return (
        [n["type"] for n in steps] == _LOWERING
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["pattern"], cuts[0]["behavior"], cuts[0]["invert"]) == ({"Regex": _PATTERN}, "Removed", True)
        and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
    )


def _words_of(pieces: list[str], t, lowers: bool) -> list[list[str]]:
    """What the tokenizer's model is given for each piece, by its own steps or the same in short."""
    normal = t.normalizer.normalize_str if t.normalizer is not None else str
    cut = t.pre_tokenizer.pre_tokenize_str if t.pre_tokenizer is not None else lambda p: [(p, None)]
    out = []
    for piece in pieces:
        bare = piece.strip(_BLANK)
        if lowers and bare.isascii() and bare.isprintable():
            out.append(_ASCII_WORDS.findall(bare.lower()))
        else:
            out.append([w for w, _ in cut(normal(piece))])
    return out


def _encode_pieces(pieces: list[str], path: str | None) -> list[bytes]:
    """Packed ids of short pieces: each word in them goes through the model once.

    Pieces that hold an added token, which is cut out before any other step, are left to the library.
    """
    t, known = tokenizer(path), _known_words(path)
    text, added = "\n".join(pieces), [a.content for a in t.get_added_tokens_decoder().values()]
    if any(a in text for a in added):
        apart = [any(a in p for a in added) for p in pieces]
        rest = iter(_encode_pieces([p for p, x in zip(pieces, apart) if not x], path))
        whole = iter(_encode([p for p, x in zip(pieces, apart) if x], path))
        return [next(whole if x else rest) for x in apart]
    if known.size > _KNOWN_BYTES:
        known.clear()
    words, tokenize = _words_of(pieces, t, _lowers(path)), t.model.tokenize
    new = [w for w in dict.fromkeys(chain.from_iterable(words)) if w not in known]
    known.learn(new, [np.array([k.id for k in tokenize(w)], dtype="<u4").tobytes() for w in new])
    out = [b"".join(map(known.__getitem__, w)) for w in words]
    for w in new:
        if len(w) > _LONG:
            del known[w]
    return out


def encode_all(texts: list[str], path: str | None = None) -> list[bytes]:
    """Packed ids of every text.

    Where the vocabulary splits texts at white space, a piece between two starts of it is encoded
    once for all its occurrences in a worker.
    """
    if not splits_at_space(path):
        return _encode(texts, path)
    known, out, at = _known(path), [], 0
    while at < len(texts):
        pieces, size = [], 0
        while at < len(texts) and (not pieces or size + len(texts[at]) <= _BATCH_CHARS):
            size += len(texts[at])
            pieces.append(_PIECE.findall(texts[at]))
            at += 1
        if known.size > _KNOWN_BYTES:
            known.clear()
        new = [p for p in dict.fromkeys(chain.from_iterable(pieces)) if p not in known]
        known.learn(new, _encode_pieces(new, path))
        out += [b"".join(map(known.__getitem__, p)) for p in pieces]
        for p in new:
            if len(p) > _LONG:
                del known[p]
    return out


def digest_of(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


def chunk_spans(data: bytes, zero_bits: int) -> list[tuple[int, int]]:
    at = [*byte_chunks(np.frombuffer(data, dtype=np.uint8), zero_bits).tolist(), len(data)]
    return list(zip(at, at[1:]))


def _agree(left: str, right: str, path: str | None) -> bool:
    a, b, both = (e.ids for e in tokenizer(path).encode_batch_fast([left, right, left + right], add_special_tokens=False))
    return a + b == both


@lru_cache(maxsize=100_000)
def _agreed(left: str, right: str, path: str | None) -> bool:
    return _agree(left, right, path)


def agrees(left: str, right: str, path: str | None) -> bool:
    """Whether two pieces have the same ids apart and together; remembered for short ones."""
    return (_agreed if len(left) + len(right) <= 2 * _LONG else _agree)(left, right, path)


def segments(
    data: bytes, shared: set[bytes], zero_bits: int, path: str | None
) -> tuple[list[tuple[bytes | None, int, int]], dict[bytes, tuple[int, int]]]:
    """Spans of ``data`` to encode apart, ``(digest, start, end)`` with None between cores; and every core."""
    cores = []
    if shared:
        for start, end in chunk_spans(data, zero_bits):
            digest = digest_of(data[start:end])
            if digest in shared:
                cuts = run_starts(np.frombuffer(data[start:end], dtype=np.uint8))
                if len(cuts) > 1:
                    cores.append((digest, start + int(cuts[0]), start + int(cuts[-1])))
    named = {digest: (start, end) for digest, start, end in cores}
    if not cores and len(data) <= _RUN_BYTES:
        return [(None, 0, len(data))], named
    out, at = [], 0
    breaks = run_starts(np.frombuffer(data, dtype=np.uint8))

    def joined(place):
        """Whether the pieces around a place, each up to the next start of white space, agree."""
        i = int(np.searchsorted(breaks, place))
        before = int(breaks[i - 1]) if i else 0
        after = int(breaks[i + 1]) if i + 1 < len(breaks) else len(data)
        return agrees(data[before:place].decode(), data[place:after].decode(), path)

    def run(start, end):
        """A run between cores; very long ones are cut in the same way."""
        while end - start > _RUN_BYTES:
            places = breaks[np.searchsorted(breaks, start + _RUN_BYTES) :]
            place = next((int(p) for p in places if p >= end or joined(p)), end)
            if place >= end:
                break
            out.append((None, start, place))
            start = place
        if start < end:
            out.append((None, start, end))

    for digest, start, end in cores:
        if joined(start) and joined(end):
            run(at, start)
            out.append((digest, start, end))
            at = end
    run(at, len(data))
    return out, named


@lru_cache(maxsize=2)
def _token_texts(path: str | None) -> np.ndarray | None:
    """The text of every id, for a vocabulary without a decoder: there a text is its tokens with blanks between."""
    t = tokenizer(path)
    if t.decoder is not None:
        return None
    out = np.full(max(t.get_vocab().values()) + 1, "", dtype=object)
    for token, i in t.get_vocab().items():
        out[i] = token
    return out


def _decode(ids: bytes, path: str | None) -> str:
    """What the library's ``decode`` gives with special tokens kept."""
    texts, numbers = _token_texts(path), np.frombuffer(ids, dtype="<u4")
    if texts is None:
        return tokenizer(path).decode(numbers.tolist(), skip_special_tokens=False)
    return " ".join(texts[numbers].tolist())


def encode(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    zero_bits: int = ZERO_BITS,
    decoded: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(key, n_tokens, ids)`` for every row, and ``decoded`` text if asked for.

    ``ids`` are the ids of the whole text as little-endian unsigned 32-bit integers, the same as
    the tokenizer gives for the text without special tokens added.  A null text counts as empty and
    has no ids.  Rows that repeat key and text have equal results; a missing key stays missing.
    Other columns are not read; no rows give no rows.
    """
    id_, hash_ = row_key(key, text)
    rows = docs.select(F.col(key).cast("string").alias("key"), id_.alias("k1"), hash_.alias("k2"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # One number stands for the row; if two rows had the same, both would encode the chunk.
    rows = rows.withColumn("row", F.xxhash64("k1", "k2"))

    @F.pandas_udf("array<binary>")
    def digests(texts: pd.Series) -> pd.Series:
        out = []
        for value in texts:
            data = value.encode("utf-8", "replace")
            out.append(list({digest_of(data[a:b]) for a, b in chunk_spans(data, zero_bits)}))
        return pd.Series(out)

    held = store(rows.select("k1", "k2", "row", F.explode(digests.asNondeterministic()(F.col("text"))).alias("digest")), "chunks")
    shared = held.groupBy("digest").agg(F.min("row").alias("owner"), F.max("row").alias("other")).where("owner <> other")
    shared = store(shared.select("digest", "owner"), "shared-chunks")
    uses = held.join(shared, "digest").groupBy("k1", "k2", "row")
    uses = uses.agg(F.collect_set(F.struct("digest", (F.col("row") == F.col("owner")).alias("own"))).alias("u"))
    uses = store(uses, "uses")
    users = uses.select(F.col("row").alias("user"))
    if uses.count() <= broadcast_rows:
        users = F.broadcast(users)
        plain, sharing = (rows.join(users, F.col("row") == F.col("user"), how) for how in ("left_anti", "left_semi"))
    else:
        plain, sharing = None, rows

    def encode_cores(frames):
        for frame in slices(frames, "text"):
            names, texts = [], []
            for value, owned in zip(frame["text"], frame["owned"]):
                data = value.encode("utf-8", "replace")
                for digest, (start, end) in segments(data, {bytes(d) for d in owned}, zero_bits, path)[1].items():
                    names.append(digest)
                    texts.append(data[start:end].decode())
            yield pd.DataFrame({"digest": names, "ids": encode_all(texts, path)})
        _end_of_task(path)

    own = uses.select("k1", "k2", F.expr("transform(filter(u, c -> c.own), c -> c.digest)").alias("owned"))
    cores = sharing.join(own.where(F.size("owned") > 0), ["k1", "k2"]).select("text", "owned")
    cores = cores.mapInPandas(encode_cores, "digest binary, ids binary")
    # Rows alike in id and text both encode what they own.
    cores = store(cores.dropDuplicates(["digest"]), "cores")
    got = uses.select("k1", "k2", F.explode("u.digest").alias("digest")).join(cores, "digest").groupBy("k1", "k2")
    got = got.agg(F.collect_list(F.struct("digest", "ids")).alias("got"))
    got = got.select("k1", "k2", F.col("got.digest").alias("names"), F.col("got.ids").alias("cores"))

    def complete(frames):
        for frame in slices(frames, "text"):
            plan, texts = [], []
            for value, names, ids in zip(frame["text"], frame["names"], frame["cores"]):
                if names is None and len(value) <= _RUN_BYTES // 4:
                    plan.append([len(texts)])
                    texts.append(value)
                    continue
                data = value.encode("utf-8", "replace")
                known = {bytes(n): bytes(v) for n, v in zip(names, ids)} if names is not None else {}
                parts = []
                for digest, start, end in segments(data, set(known), zero_bits, path)[0]:
                    if digest is None:
                        parts.append(len(texts))
                        texts.append(data[start:end].decode())
                    else:
                        parts.append(known[digest])
                plan.append(parts)
            ids = encode_all(texts, path)
            whole = [b"".join(ids[p] if isinstance(p, int) else p for p in parts) for parts in plan]
            out = pd.DataFrame({"key": frame["key"].to_numpy(), "n_tokens": [len(v) // 4 for v in whole], "ids": whole})
            yield out.assign(decoded=[_decode(v, path) for v in whole]) if decoded else out
        _end_of_task(path)

    schema = "key string, n_tokens bigint, ids binary" + (", decoded string" if decoded else "")
    columns = ["key", "text", "names", "cores"]
    out = sharing.join(got, ["k1", "k2"], "left").select(*columns).mapInPandas(complete, schema)
    if plain is not None:
        none = [F.lit(None).cast("array<binary>").alias(c) for c in columns[2:]]
        out = plain.select(*columns[:2], *none).mapInPandas(complete, schema).unionByName(out)
    return out.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of its ids, special tokens kept; no ids give none."""

    @F.pandas_udf("string")
    def text(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else _decode(v, path) for v in values])

    return encoded.withColumn("decoded", text.asNondeterministic()(F.col(ids)))
