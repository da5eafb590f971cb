import re
from collections import Counter
from itertools import product

import numpy as np
import pytest

from calibra.llm import mixing, queries


def plain_targets(sizes, weights):
    out, over = [0.0] * len(sizes), set()
    while True:
        left = sum(sizes) - sum(3 * sizes[i] for i in over)
        total = sum(w for i, w in enumerate(weights) if i not in over)
        new = set()
        for i, w in enumerate(weights):
            out[i] = 3 * sizes[i] if i in over else left * w / total
            if i not in over and out[i] > 3 * sizes[i]:
                new.add(i)
        if not new:
            return out
        over |= new


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1, 1000], [1, 1, 1, 1, 1, 5000, 0], [0, 7], [0, 0], [5], []])
def test_targets(sizes):
    weights = [(1, 2, 3)[i % 3] for i in range(len(sizes))]
    got = [float(t) for t in mixing.targets(sizes, weights)]
    assert got == pytest.approx(plain_targets(sizes, weights) if sum(sizes) else [0.0] * len(sizes))
    assert sum(got) == pytest.approx(sum(sizes))


@pytest.mark.parametrize("target", [0, 300, 1000, 1500, 2600, 3000])
@pytest.mark.parametrize("shape", [[(400, 1), (300, 2)], [(100, 1), (1, 900)], [(50, 4), (2, 150), (1, 500)], [(1, 1000)]])
def test_expected_copies(shape, target):
    n, each = (np.array([c[i] for c in shape]) for i in (0, 1))
    got = mixing.expected_copies(n, n * each, target)
    assert ((got >= 0) & (got <= 3)).all()
    large = each * mixing.LARGE > target
    assert (got * n)[large] == pytest.approx(np.round((got * n)[large]))
    # Whole copies of the smallest documents leave half a document; no choice of copies comes nearer than ``nearest``.
    light = (n * each)[~large].sum()
    nearest = min(
        (
            max(words - target, target - words - 3 * light, 0)
            for copies in product(*[range(3 * c + 1) for c in n[large].tolist()])
            for words in [(np.array(copies, dtype=float) * each[large]).sum()]
        )
        if (n[large] < 5).all()
        else [0]
    )
    assert abs((got * n * each).sum() - target) <= nearest + each.min() / 2 + 1e-6


def test_query(spark):
    directory = "/root/testdata/sf0.1"
    out = queries.QUERIES["op9_mixing"](spark, directory)
    got = {r["doc_id"]: r for r in out.collect()}
    docs = spark.read.parquet(f"{directory}/documents.parquet").collect()
    assert len(got) == len(docs)
    sizes = {r["doc_id"]: len(re.findall("[^\x20\x09-\x0d]+", r["text"] or "")) for r in docs}
    totals = Counter()
    for r in docs:
        totals[r["source"]] += sizes[r["doc_id"]]
    order = sorted(totals, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    wanted = dict(zip(order, plain_targets([totals[s] for s in order], [(1, 2, 3)[i % 3] for i in range(len(order))])))
    taken = Counter()
    for r in docs:
        g, s = got[r["doc_id"]], r["source"]
        assert (g["size"], g["source_size"]) == (sizes[r["doc_id"]], totals[s])
        assert g["target"] == pytest.approx(wanted[s], rel=1e-12)
        assert g["taken"] in {k * g["size"] for k in range(4)}
        taken[s] += g["taken"]
    for s in order:
        assert taken[s] == pytest.approx(wanted[s], rel=0.005)


def test_odd_rows(spark):
    rows = [(i, "w " * (i % 7), None if i % 4 == 0 else f"s{i % 3}", "c", 1) for i in range(200)]
    rows += [(None, None, "s1", "c", 1), (5, "w " * 5, "s2", "c", 1), (300, "x", "", "c", 1), (301, None, "empty", "c", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string, target int")
    out, names = mixing.mix(df)
    assert names["size"] == "size_" and out.columns[:5] == df.columns
    first = sorted(map(str, out.collect()))
    again, _ = mixing.mix(df.repartition(7))
    assert len(first) == len(rows) and sorted(map(str, again.collect())) == first
    copies = {(r["doc_id"], r["source"]): r["copies"] for r in out.collect()}
    assert max(copies.values()) <= 3
    made = mixing.mixed(df)
    assert made.columns == df.columns
    seen = Counter((r["doc_id"], r["source"]) for r in made.collect())
    assert seen[(None, "s1")] == copies[(None, "s1")] and sum(seen.values()) == sum(r["copies"] for r in out.collect())


def test_no_rows(spark):
    assert mixing.mixed(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0
