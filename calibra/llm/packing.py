"""Packing documents into sequences: bin completion on the histogram of lengths.

1. Every document is encoded once and cut into pieces of at most ``capacity`` tokens.
2. Pieces are counted by length.  At most ``capacity`` counts, whatever the corpus, describe the
   packing problem; the search works on them and fills many sequences alike at a time.
3. The search (``complete``) starts from best-fit decreasing as its incumbent.  It takes the longest
   piece left, lists the undominated fillings of the room beside it, least waste first, and goes on
   with what remains; branches whose waste cannot beat the incumbent are cut.  It ends at the lower
   bound, or after ``nodes`` steps with the best solution so far.
4. Pieces of one length are interchangeable: the r-th of them has its place by arithmetic on the
   patterns.  Ranks come from counts per (length, part) and a window inside a part, so a length that
   a third of all pieces share is spread over all parts.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.sizing import bounded_rows
from .shared import fresh, slices, store

VOCABULARY = "byte_bpe_50k.json"
CAPACITY, END_ID = 2048, 0
NODES, FILLINGS, STEPS = 4000, 24, 400


# --- pieces -------------------------------------------------------------------------------------


def _symbols() -> dict[str, int]:
    """The byte behind each symbol of a byte-level vocabulary: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str | None = None):
    """A function from a text to the ids that the tokenizers library gives it without special tokens added.

    Where the file is a plain byte-level vocabulary whose merges stand in the order of their ids,
    tiktoken runs it (the same ids in a quarter of the time); every other file is left to tokenizers.
    """
    import public_tokenizers
    import tiktoken

    from .bpe import tokenizer

    path = path or public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    vocabulary, symbols = model.get("vocab"), _symbols()
    special = {a["content"]: a["id"] for a in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or []]
    merged = [vocabulary.get("".join(p), -1) for p in pairs] if isinstance(vocabulary, dict) else []
    plain = (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex")
        and not before.get("add_prefix_space")
        and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and all(a["special"] and not (a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"]) for a in added)
        and merged == sorted(set(merged))
        and len(vocabulary) == 256 + len(merged) + sum(s in vocabulary for s in special)
    )
    if not plain:
        whole = tokenizer(path)
        return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
    ranks = {bytes(symbols[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    encoding = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: whole capacities behind a first piece that may be shorter."""
    first = n - (-(-n // capacity) - 1) * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """``(key, piece, start, length, ids)``: every document's ids and one ``end_id``, cut to ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers.  A null or empty text has the one end id; rows
    that repeat a key are documents of their own; a null key stays null.  Other columns are not
    read; no rows give no rows.
    """

    def encode(frames):
        ids_of = encoder(path)
        for frame in slices(frames, "text"):
            out = {"key": [], "piece": [], "start": [], "length": [], "ids": []}
            for k, value in zip(frame["key"], frame["text"]):
                ids = np.append(ids_of(value), np.uint32(end_id)).astype("<u4", copy=False)
                for i, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    for name, v in zip(out, (k, i, start, length, ids[start : start + length].tobytes())):
                        out[name].append(v)
            yield pd.DataFrame(out)

    rows = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    out = rows.mapInPandas(encode, "key string, piece int, start bigint, length bigint, ids binary")
    return out.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


# --- the packing problem, on counts by length ---------------------------------------------------


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing needs fewer sequences.

    For each k: pieces over capacity - k stand without any of those of k or more; pieces over half
    stand one to a sequence; those from k to a half fill what is left beside them (the bound of
    Martello and Toth on waste).  Of pieces over a third of the capacity two fit at most, and so on.
    """
    length = np.arange(capacity + 1)
    weight = counts * length
    total = -(-int(weight.sum()) // capacity)
    half = capacity // 2
    # Sums over all lengths above i, for i from 0.
    above, heavy = (np.append(np.cumsum(x[::-1])[::-1][1:], 0) for x in (counts, weight))
    k = np.arange(half + 1)
    alone = above[capacity - k]
    beside, held = above[half] - alone, heavy[half] - heavy[capacity - k]
    small = np.where(k > 0, heavy[np.maximum(k - 1, 0)], heavy[0]) - heavy[half]
    more = -(-np.maximum(small - (beside * capacity - held), 0) // capacity)
    third = k > capacity // 3
    two = (alone + -(-(above[np.maximum(k - 1, 0)] - alone) // 2))[third]
    few = [-(-int(above[capacity // (m + 1)]) // m) for m in range(1, 12)]
    return max(total, int((alone + beside + more).max()), int(two.max(initial=0)), *few)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing: patterns of lengths and how many sequences have each.

    Each piece goes to the fullest sequence it fits in.  Sequences alike are one group, and a group
    takes all pieces of a length in one step.
    """
    groups: dict[int, list[list]] = {}  # room left -> [pattern, sequences]
    for a in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[a])
        for room in sorted(r for r in groups if r >= a):
            each = room // a
            while left and groups[room]:
                pattern, n = groups[room].pop()
                whole = min(n, left // each)
                part = left - whole * each if whole < n else 0
                for sequences, taken in ((whole, each), (1 if part else 0, part), (n - whole - (1 if part else 0), 0)):
                    if sequences:
                        groups.setdefault(room - taken * a, []).append([pattern + (a,) * taken, sequences])
                left -= whole * each + part
            if not left:
                break
        each = capacity // a
        for sequences, taken in ((left // each, each), (1 if left % each else 0, left % each)):
            if sequences:
                groups.setdefault(capacity - taken * a, []).append([(a,) * taken, sequences])
    return [(pattern, n) for room in sorted(groups) for pattern, n in groups[room]]


def dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the pieces of ``other`` fit into those of ``one``, several to a piece."""

    def fits(rooms, rest):
        if not rest:
            return True
        tried = set()
        for i, room in enumerate(rooms):
            if room >= rest[0] and room not in tried:
                tried.add(room)
                if fits([*rooms[:i], room - rest[0], *rooms[i + 1 :]], rest[1:]):
                    return True
        return False

    return sum(one) >= sum(other) and fits(list(one), sorted(other, reverse=True))


def fillings(counts: np.ndarray, room: int, least: int, most: int = FILLINGS, steps: int = STEPS) -> list[tuple[int, ...]]:
    """Undominated sets of pieces that fill ``room`` with at least ``least``, fullest first.

    A piece of just that length dominates all else.  Pairs that fill it are listed next, from the one with the
    longest piece; larger sets by depth first, longest pieces first, for ``steps`` steps.
    """
    if room == 0:
        return [()]
    if counts[room]:
        return [(room,)]
    there = np.flatnonzero(counts[: room + 1])
    if not len(there):
        return [()] if least <= 0 else []
    found: dict[tuple[int, ...], None] = {}
    x = there[there * 2 >= room][::-1]
    pairs = x[(counts[room - x] > 0) & ((room - x != x) | (counts[x] > 1))]
    found.update(((int(i), room - int(i)), None) for i in pairs[:most])
    left, order = counts.copy(), there[::-1].tolist()
    used: list[int] = []

    def deeper(space, begin):
        nonlocal steps
        steps -= 1
        i = int(np.searchsorted(-there[::-1], -space, "left"))
        if i < begin:
            # A longer piece than the last may still fit: such a set is dominated by one with it.
            if any(left[order[j]] for j in range(i, begin)):
                return
            i = begin
        maximal = True
        for j in range(i, len(order)):
            if steps <= 0 or len(found) >= 2 * most:
                return
            if left[order[j]]:
                maximal = False
                left[order[j]] -= 1
                used.append(order[j])
                deeper(space - order[j], j)
                used.pop()
                left[order[j]] += 1
        if maximal and room - space >= least:
            found[tuple(used)] = None

    if len(found) < most:
        deeper(room, 0)
    sets = sorted(found, key=lambda s: (-sum(s), len(s), [-p for p in s]))
    kept: list[tuple[int, ...]] = []
    for s in sets:
        if len(kept) < most and not any(dominates(k, s) for k in kept):
            kept.append(s)
    return kept


def complete(counts: np.ndarray, capacity: int, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and their numbers of sequences, in as few sequences as found.

    ``counts[length]`` pieces of each length up to ``capacity``.  Depth-first branch and bound; the
    steps are counted, not timed, so the same counts always give the same patterns.
    """
    counts = np.asarray(counts, dtype=np.int64).copy()
    best = best_fit(counts, capacity)
    most, bound = sum(n for _, n in best), lower_bound(counts, capacity)
    total = int((counts * np.arange(capacity + 1)).sum())
    chosen: list[tuple[tuple[int, ...], int]] = []

    def branches(bins):
        """Ways on from the present counts: ``(pattern, sequences)``."""
        a = int(np.flatnonzero(counts)[-1])
        # A better solution has most - 1 sequences at most, and so this much waste.
        waste = (most - 1) * capacity - total - sum((capacity - sum(p)) * n for p, n in chosen)
        if waste < 0 or bins + lower_bound(counts, capacity) >= most:
            return
        counts[a] -= 1
        ways = fillings(counts, capacity - a, capacity - a - waste)
        counts[a] += 1
        for filling in ways:
            pattern = (a, *filling)
            times = min(int(counts[p]) // m for p, m in Counter(pattern).items())
            lost = capacity - sum(pattern)
            times = min(times, waste // lost) if lost else times
            for n in sorted({times, times // 2, 1}, reverse=True):
                if 0 < n <= times:
                    yield pattern, n

    def turn(pattern, n):
        for p in pattern:
            counts[p] -= n

    stack, bins = [], 0
    if most > bound:
        stack.append(branches(0))
    while stack and nodes > 0 and most > bound:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if chosen:
                pattern, n = chosen.pop()
                turn(pattern, -n)
                bins -= n
            continue
        nodes -= 1
        turn(*step)
        chosen.append(step)
        bins += step[1]
        if counts.any():
            stack.append(branches(bins))
        else:
            if bins < most:
                best, most = list(chosen), bins
            turn(step[0], -step[1])
            bins -= chosen.pop()[1]
    return best


# --- places -------------------------------------------------------------------------------------


class Places:
    """Where the r-th piece of a length goes, from the patterns."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], counts: np.ndarray):
        self.base = np.concatenate([[0], np.cumsum(counts)[:-1]])
        used, rows, first = np.zeros(len(counts), dtype=np.int64), [], 0
        for pattern, n in patterns:
            offset = 0
            for length, times in Counter(pattern).items():
                rows.append((self.base[length] + used[length], n, first, offset, length))
                used[length] += n * times
                offset += length * times
            first += n
        rows.sort()
        self.start, self.n, self.first, self.offset, self.length = np.array(rows, dtype=np.int64).reshape(-1, 5).T

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset; ranks are from 0 within a length."""
        at = self.base[length] + rank
        row = np.searchsorted(self.start, at, "right") - 1
        times, nth = np.divmod(at - self.start[row], self.n[row])
        return self.first[row] + nth, self.offset[row] + times * self.length[row]


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY, nodes: int = NODES) -> tuple[DataFrame, dict[str, str]]:
    """``items`` with the columns sequence_id and offset, and their names in the result.

    No sequence holds more than ``capacity``, and the items of one stand without gaps from 0.  A length
    below 1, above ``capacity`` or missing has no place: both columns are null.  Repeated rows are
    items of their own; which of the items of one length goes where depends on their order in the
    stored table.  Other columns travel along once; no rows give no rows.
    """
    names = dict(zip(("sequence_id", "offset"), fresh(items, "sequence_id", "offset")))
    size, part, order, before, rank, made = fresh(items, "__size", "__part", "__order", "__before", "__rank", "__place")
    fits = F.col(length).between(1, capacity)
    stored = items.withColumns(
        {size: F.when(fits, F.col(length)).otherwise(0).cast("int"), part: F.spark_partition_id(), order: F.monotonically_increasing_id()}
    )
    stored = store(stored, "pack-items")
    by_part = store(stored.groupBy(size, part).agg(F.count(F.lit(1)).alias(before)), "pack-counts")
    # At most capacity + 1 rows.
    histogram = bounded_rows(by_part.groupBy(size).agg(F.sum(before).alias(before)), capacity + 1, "lengths")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in histogram:
        counts[r[size]] = r[before]
    counts[0] = 0
    places = Places(complete(counts, capacity, nodes), counts)
    earlier = Window.partitionBy(size).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    ranked = stored.withColumn(rank, F.row_number().over(Window.partitionBy(size, part).orderBy(order)) - 1)
    ranked = ranked.join(starts, [size, part]).withColumn(rank, F.col(rank) + F.col(before))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        known = lengths.to_numpy() > 0
        sequence, offset = places.of(lengths.to_numpy()[known], ranks.to_numpy()[known])
        out = pd.DataFrame({"sequence_id": pd.array([pd.NA] * len(known), dtype="Int64")})
        out["offset"] = out["sequence_id"]
        out.loc[known, "sequence_id"], out.loc[known, "offset"] = sequence, offset
        return out

    out = ranked.withColumn(made, place.asNondeterministic()(F.col(size), F.col(rank)))
    return out.select(*items.columns, *[F.col(made)[f].alias(n) for f, n in names.items()]), names
