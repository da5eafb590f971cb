import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from calibra.llm import queries, ranked_search as R

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    """Rows ``(item, rank, key, score)`` from plain dictionaries."""
    held = [(key, Counter(t), len(t)) for key, text in docs if (t := plain_terms(text))]
    total, df = sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for key, tf, n in held:
            m = 100 - 25 + (25 * n * len(held)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m))
                for t in plain_terms(text)
                if t in tf
            )
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k])]
    return out


def rows_for_test():
    rng = random.Random(4)
    words = ["The", "of", "é", "ÉA", "naïve", "x1", "a_b", "日本", "\x7f", "K", "ſ", "don't", "42"] + [f"w{i}" for i in range(60)]
    draw = lambda n: rng.choice([" ", ", ", "\n", "-"]).join(rng.choices(words, weights=[80 // (i + 1) + 1 for i in range(len(words))], k=n))
    docs = [(i, draw(rng.choice([1, 5, 40, 300]))) for i in range(400)]
    docs += [(500 + i, docs[7][1]) for i in range(60)] + [(600, None), (601, ""), (602, " .,!\x00"), (603, "the " * 20_000), (None, docs[7][1]), ((1 << 62) + 1, docs[7][1]), (9, docs[9][1])]
    items = [(i, draw(12)) for i in range(25)] + [(30, docs[7][1]), (31, None), (32, ""), (33, "unknownterm"), (34, "w1 w1 w1 W1"), (34, "w1 w1 w1 W1")]
    return docs, items + [(35, " ".join(t for _, t in docs[:40])), (None, "w2 naïve 42")]


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("k", "bucket_rows", "block_bytes"), [(20, 2048, 8 << 20), (20, 7, 8 << 20), (3, 50, 6000), (1000, 64, 8 << 20)])
def test_same_as_plain(spark, k, bucket_rows, block_bytes):
    docs, items = rows_for_test()
    d = spark.createDataFrame([(*r, 1, 2.0) for r in docs], "doc_id bigint, text string, n int, norm double").repartition(5)
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, key string")
    got = R.search(d, q, k=k, bucket_rows=bucket_rows, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert answer(got) == sorted(plain_search(docs, items, k), key=str)


def test_nothing_to_search(spark):
    docs, items = "doc_id bigint, text string", "item_id bigint, text string"
    some = spark.createDataFrame([(1, "a b")], docs)
    one = spark.createDataFrame([(1, "a b")], items)
    assert R.search(spark.createDataFrame([], docs), one).count() == 0
    assert R.search(some, spark.createDataFrame([], items)).count() == 0
    assert R.search(some, spark.createDataFrame([(1, None), (2, "?!")], items)).count() == 0
    assert R.search(spark.createDataFrame([(1, None), (2, "")], docs), one).count() == 0


def vectors(seed, n, terms=200):
    """Documents with a few of many terms, a few of them close to the item."""
    rng = np.random.default_rng(seed)
    rows = [np.sort(rng.choice(terms, size=rng.integers(1, 30), replace=False)) for _ in range(n)]
    impacts = [rng.integers(1, 900_000, size=len(r)) for r in rows]
    for i in range(0, n, 97):
        rows[i], impacts[i] = np.arange(10), np.full(10, 900_000)
    norms = np.array([math.sqrt((x.astype(float) ** 2).sum()) for x in impacts])
    order = np.argsort(-norms, kind="stable")
    return [rows[i] for i in order], [impacts[i] for i in order], norms[order]


def test_buckets_are_pruned_and_nothing_is_lost():
    rows, impacts, norms = vectors(1, 4000)
    items = R.Items([Counter({t: 1 for t in range(10)}), Counter({50: 3, 51: 1})], np.full(200, 3000, dtype=np.int64))
    best, dense, scored, everything = R.Best(np.zeros(2, dtype=np.int64), 20), np.zeros(200, dtype=np.int64), 0, [[], []]
    for a in range(0, 4000, 250):
        part = slice(a, a + 250)
        bucket = R.Bucket(200, np.array([len(r) for r in rows[part]]), np.concatenate(rows[part]), np.concatenate(impacts[part]), norms[part])
        scored += R.search_bucket(bucket, np.arange(a, a + len(rows[part])), items, best, dense)
    for key, (r, x) in enumerate(zip(rows, impacts)):
        for i in range(2):
            dense[items.terms[i]] = items.values[i]
            everything[i].append((-int((dense[r] * x).sum()), key))
            dense[items.terms[i]] = 0
    for i in range(2):
        assert list(zip((-best.score[i]).tolist(), best.key[i].tolist())) == sorted(everything[i])[:20]
    touched = sum(s < 0 for e in everything for s, _ in e)
    assert scored < touched / 3


@pytest.mark.parametrize("seed", range(5))
def test_survivors_hold_every_vector_above_the_threshold(seed):
    rows, impacts, norms = vectors(seed, 300, 40)
    bucket = R.Bucket(40, np.array([len(r) for r in rows]), np.concatenate(rows), np.concatenate(impacts), norms)
    rng = np.random.default_rng(seed)
    terms, values = np.arange(0, 40, 3), rng.integers(1, 9000, 14)
    dense = np.zeros(40, dtype=np.int64)
    dense[terms] = values
    scores = np.array([(dense[r] * x).sum() for r, x in zip(rows, impacts)])
    for threshold in [1, *np.quantile(scores, [0.2, 0.5, 0.9, 1.0]).astype(int).tolist()]:
        found = bucket.survivors(terms, values, max(threshold, 1))
        assert set(np.flatnonzero(scores >= max(threshold, 1)).tolist()) <= set(found.tolist())
        if len(found):
            assert bucket.scores(found, dense).tolist() == scores[found].tolist()


def test_query(spark):
    directory = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{directory}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{directory}/benchmark.parquet").collect()]
    got = queries.QUERIES["op11_ranked_search"](spark, directory)
    assert answer(got) == sorted(plain_search(docs, items, 20), key=str)
