import numpy as np
from brute import component_of, cosine

from calibra.llm.embedding_dedup import embedding_components

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, h int"


def rows_for_test():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((25, 16))
    rows, i = [], 0
    for b in range(25):
        for _ in range(1 + b % 6):
            x = base[b] + 0.04 * rng.standard_normal(16)
            rows.append((i, [float(v) for v in x.astype(np.float32)], b % 3))
            i += 1
    for k in range(12):
        rows.append((i + k, rows[3][1], rows[3][2]))
    i += 12
    rows.append((i, [2 * v for v in rows[3][1]], rows[3][2]))
    rows.append((i + 1, rows[3][1], None))
    rows.append((i + 2, rows[3][1], 99))
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 7]
    rows += [(i + 3 + k, v, 0) for k, v in enumerate(bad)]
    return [(*r, "x", 1) for r in rows]


def expected(rows, threshold):
    def ok(v):
        return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v)

    live = [(i, v, l) for i, v, l, *_ in rows if ok(v) and l is not None]
    links = [
        (a, b) for a, x, l in live for b, y, m in live
        if a < b and l == m and len(x) == len(y) and cosine(x, y) >= threshold
    ]
    label = component_of([r[0] for r in rows], links)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return {i: (degree[i], label[i], label[i] == i) for i in degree}


def test_against_brute_force(spark):
    rows = rows_for_test()
    want = expected(rows, 0.98)
    assert max(n for n, *_ in want.values()) > 12
    for block_rows in (3, 1024):
        out = embedding_components(spark.createDataFrame(rows, SCHEMA).repartition(5), block_rows=block_rows)
        assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert {r["vec_id"]: tuple(r)[1:] for r in out.collect()} == want


def test_rows_without_key_and_repeated_rows(spark):
    x, y = [1.0, 0.0, 0.5], [-1.0, 3.0, 0.0]
    rows = [(1, x, 0), (1, x, 0), (2, x, 0), (3, y, 0), (3, x, 0), (None, x, 0)]
    out = embedding_components(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([(1, 3, 1, True)] * 2 + [(2, 3, 1, False), (3, 3, 1, False), (3, 0, 3, True), (None, 0, None, False)], key=str)


def test_embeddings_against_brute_force(spark, tables):
    rows = [tuple(r) for r in tables("embeddings").select("vec_id", "embedding", "label").collect()]
    out = {r["vec_id"]: tuple(r)[1:] for r in embedding_components(tables("embeddings")).collect()}
    assert out == expected(rows, 0.98)


def test_empty_table(spark):
    assert embedding_components(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0
