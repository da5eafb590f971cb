import numpy as np

from calibra.llm import hnsw


def brute(rows, queries, k):
    live = {(i, tuple(v)) for i, v in rows if v and i is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    out = {}
    for q in queries:
        x = min((v for i, v in live if i == q), default=None)
        if x is None:
            continue
        near = sorted((float(np.sqrt(((np.array(v) - np.array(x)) ** 2).sum())), i) for i, v in live if i != q and len(v) == len(x))
        out[q] = near[:k]
    return out


def recall(found, want):
    return np.mean([len({i for _, i in want[q]} & {i for _, i in found.get(q, [])}) / max(len(want[q]), 1) for q in want])


def ask(spark, rows, **options):
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id bigint, embedding array<float>, rank int, x string")
    out = hnsw.nearest(df, df.where("vec_id % 100 = 0"), **options)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    found = {}
    for r in sorted(out.collect(), key=lambda r: (r["query_id"], r["rank"])):
        near = found.setdefault(r["query_id"], [])
        near.append((r["score"], r["vec_id"]))
        assert r["rank"] == len(near)
    return found


def test_recall_on_embeddings(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 100 == 0], 10)
    found = ask(spark, rows, shard_rows=600)
    assert recall(found, want) >= 0.95
    for q, near in found.items():
        assert near == sorted(near) and len(near) == 10


def test_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.standard_normal(6).astype(np.float32)]) for i in range(100, 150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(200, rows[0][1])]
    rows += [(500, None), (600, [0.0] * 6), (700, [float("nan")] * 6), (800, [None] + [1.0] * 5), (900, [1.0, 2.0]), (None, rows[0][1])]
    found = ask(spark, rows, shard_rows=16)
    want = brute(rows, [100, 200, 500, 600, 700, 800, 900], 10)
    assert {q for q in want if want[q]} == set(found)
    for q in found:
        assert [i for _, i in found[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in found[q]], [s for s, _ in want[q]], rtol=1e-12, atol=0)


def test_fewer_candidates_and_empty(spark):
    assert ask(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])]) == {0: [(2**0.5, 1)]}
    assert ask(spark, [(100, [1.0])]) == {}
    assert ask(spark, []) == {}


def test_every_node_can_be_reached():
    x = np.random.default_rng(2).standard_normal((500, 8))
    order, graph = hnsw.build(x, 0)
    assert sorted(order) == list(range(500))
    found = hnsw.search(x[order], graph, x[order], 1, 64)[:, 0]
    assert (found == np.arange(500)).mean() > 0.99
