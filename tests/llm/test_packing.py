import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from calibra.llm import packing, queries

PLAIN = Tokenizer.from_file(path(packing.VOCABULARY))


def plain_ids(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]


def fewest(items, capacity):
    """Sequences of an optimal packing, by trying everything."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[i]}.values():
            go(i + 1, [*rooms[:j], rooms[j] - items[i], *rooms[j + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def histogram(items, capacity):
    return np.bincount(np.array(items, dtype=np.int64), minlength=capacity + 1)


def check_patterns(patterns, counts, capacity):
    got = Counter()
    for pattern, n in patterns:
        assert n > 0 and 0 < sum(pattern) <= capacity
        for p in pattern:
            got[p] += n
    assert got == Counter({i: int(c) for i, c in enumerate(counts) if c})
    return sum(n for _, n in patterns)


@pytest.mark.parametrize("seed", range(8))
def test_as_few_as_an_exhaustive_search(seed):
    rng = random.Random(seed)
    for _ in range(60):
        capacity = rng.choice([10, 20, 37, 50])
        low, high = rng.choice([1, 1, capacity // 5]), rng.choice([capacity // 2, capacity])
        items = [rng.randint(low, high) for _ in range(rng.randrange(12))]
        counts = histogram(items, capacity)
        want = fewest(items, capacity)
        assert packing.lower_bound(counts, capacity) <= want
        assert check_patterns(packing.complete(counts, capacity), counts, capacity) == want
        assert check_patterns(packing.best_fit(counts, capacity), counts, capacity) >= want


def test_search_beats_best_fit():
    rng = np.random.default_rng(0)
    counts = histogram(rng.integers(500, 1200, 5000), 2048)
    plain, found = (check_patterns(f(counts, 2048), counts, 2048) for f in (packing.best_fit, packing.complete))
    assert packing.lower_bound(counts, 2048) <= found < plain


def test_best_fit_is_best_fit():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([20, 53])
        items = [rng.randint(1, capacity) for _ in range(rng.randrange(40))]
        rooms = []
        for x in sorted(items, reverse=True):
            fitting = [r for r in rooms if r >= x]
            if fitting:
                rooms.remove(min(fitting))
            rooms.append((min(fitting) if fitting else capacity) - x)
        counts = histogram(items, capacity)
        got = packing.best_fit(counts, capacity)
        assert Counter(capacity - sum(p) for p, n in got for _ in range(n)) == Counter(rooms)


def test_large_counts_take_no_longer():
    counts = histogram(np.random.default_rng(2).integers(1, 2049, 3000), 2048) * 10**9
    found = check_patterns(packing.complete(counts, 2048, nodes=200), counts, 2048)
    assert found <= packing.lower_bound(counts, 2048) * 1.02


def test_undominated_fillings():
    counts = histogram([3, 4, 7, 5, 2, 6], 20)
    assert packing.fillings(counts, 7, 0) == [(7,)]
    got = packing.fillings(histogram([3, 4, 5, 2, 6, 1], 20), 7, 0)
    assert {(4, 3), (5, 2), (6, 1)} == set(got)
    assert packing.dominates((6, 4), (3, 3, 4)) and not packing.dominates((6, 4), (5, 5))
    assert packing.fillings(histogram([], 20), 7, 0) == [()] and packing.fillings(histogram([], 20), 7, 3) == []


def check_layout(rows, capacity=2048):
    """Rows ``(length, sequence, offset)``: gapless from 0, none above capacity; number of sequences."""
    held = defaultdict(list)
    for length, sequence, offset in rows:
        held[sequence].append((offset, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(held)


def check_documents(got, texts):
    """Pieces ``(key, piece, start, length, crc, ...)`` against plain encoding; keys are unique."""
    by_key = defaultdict(list)
    for g in got:
        by_key[g[0]].append(g[1:5])
    assert set(by_key) == set(texts)
    for key, text in texts.items():
        ids = np.array(plain_ids(text), dtype="<u4")
        n = -(-len(ids) // 2048)
        first = len(ids) - (n - 1) * 2048
        starts = [0] + [first + 2048 * i for i in range(n - 1)]
        ends = [*starts[1:], len(ids)]
        want = [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(starts, ends))]
        assert sorted(by_key[key]) == want


def test_query(spark):
    directory = "/root/testdata/sf0.1"
    got = [tuple(r) for r in queries.QUERIES["op12_best_fit_packing"](spark, directory).collect()]
    docs = spark.read.parquet(f"{directory}/documents.parquet").collect()
    check_documents(got, {r["doc_id"]: r["text"] for r in docs})
    bins = check_layout([(g[3], g[5], g[6]) for g in got])
    counts = histogram([g[3] for g in got], 2048)
    bound = packing.lower_bound(counts, 2048)
    assert bound <= bins <= bound * 1.005 + 1


def test_odd_rows(spark):
    long = "é a1 \n\n  b'll " * 4000
    texts = {1: None, 2: "", 3: " ", 4: long, 5: "x" * 9000, 6: "a<|endoftext|> b <|endof" + "text|>", 7: " " * 3000, 8: "日本 ½ \x00\x85  end"}
    texts |= {10 + i: "word " * i for i in range(0, 4200, 300)} | {30: "a" * 2047, 31: " the" * 2047, 32: " the" * 2048}
    rows = [(k, t, 7, "s") for k, t in texts.items()]
    schema = "doc_id bigint, text string, length int, sequence_id string"
    df = spark.createDataFrame(rows, schema)
    made = packing.pieces(df).withColumn("sequence_id", packing.F.lit("mine"))
    out, names = packing.pack(made)
    assert names["sequence_id"] == "sequence_id_" and out.columns[: len(made.columns)] == made.columns
    got = out.collect()
    check_documents([(r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in got], texts)
    check_layout([(r["length"], r["sequence_id_"], r["offset"]) for r in got])
    twice = spark.createDataFrame([(None, "null key", 0, "")] * 2 + [(5, "same", 0, "")] * 3, schema)
    rows = packing.pack(packing.pieces(twice))[0].collect()
    assert Counter(r["doc_id"] for r in rows) == {None: 2, 5: 3}
    assert check_layout([(r["length"], r["sequence_id"], r["offset"]) for r in rows]) == 1


def test_lengths_without_a_place(spark):
    rows = [(1, None), (2, 0), (3, -5), (4, 2049), (5, 2048), (6, 1), (7, 1)]
    out, _ = packing.pack(spark.createDataFrame(rows, "id int, length bigint"))
    got = {r["id"]: r for r in out.collect()}
    assert all(got[i]["sequence_id"] is None and got[i]["offset"] is None for i in (1, 2, 3, 4))
    assert check_layout([(got[i]["length"], got[i]["sequence_id"], got[i]["offset"]) for i in (5, 6, 7)]) == 2


def test_hot_length_over_many_parts(spark):
    rows = [(i, 700 if i % 3 else 1 + i % 1300) for i in range(6000)]
    out, _ = packing.pack(spark.createDataFrame(rows, "id int, length int").repartition(16))
    got = out.collect()
    assert len({r["id"] for r in got}) == len(rows)
    check_layout([(r["length"], r["sequence_id"], r["offset"]) for r in got])


def test_no_rows(spark):
    out = packing.pack(packing.pieces(spark.createDataFrame([], "doc_id bigint, text string")))[0]
    assert out.count() == 0 and out.columns[-2:] == ["sequence_id", "offset"]


def test_other_vocabularies_are_left_to_the_library():
    other = Tokenizer.from_file(path("word_bpe_49k.json"))
    for text in ("The cat's hat", "", "É ß 日本"):
        assert packing.encoder(path("word_bpe_49k.json"))(text).tolist() == other.encode(text, add_special_tokens=False).ids
