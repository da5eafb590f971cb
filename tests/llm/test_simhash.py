import random
import re

import numpy as np
import pytest
import xxhash
from brute import component_of

from calibra.llm import queries, simhash


def plain(text, size=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    shingles = [" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "A b  c\nd", "É x   y z w", "w " * 500, "a\x0bb\x0cc d e f"])
def test_fingerprint(text):
    assert simhash.simhash(text) == plain(text)


def test_fingerprint_of_long_text_in_blocks(monkeypatch):
    text = " ".join(str(random.Random(1).randrange(50) * i) for i in range(900))
    monkeypatch.setattr(simhash, "_HASHES_AT_ONCE", 100)
    assert simhash.simhash(text) == plain(text)


def test_forest_links_what_is_near():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for _ in range(9)] + [base]))
    links = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 4]
    want = component_of(range(len(fps)), links)
    rows, roots = simhash.forest(fps, None, 4)
    got = component_of(range(len(fps)), list(zip(rows.tolist(), roots.tolist())))
    assert got == want
    rows, roots = simhash.forest(fps[:250], fps[250:], 4)
    across = [(i, j) for i, j in links if (i < 250) != (j < 250)]
    assert component_of(range(len(fps)), list(zip(rows.tolist(), roots.tolist()))) == component_of(range(len(fps)), across)


@pytest.mark.parametrize("tile_rows", [20, 65_536])
def test_components_against_brute_force(spark, tables, tile_rows):
    docs = tables("documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(10_001, None), (10_002, ""), (10_003, rows[5][1] + " more"), (10_004, rows[5][1]), (10_005, rows[5][1].upper())]
    fps = {i: plain(t) for i, t in rows}
    want = component_of(fps, [(a, b) for a in fps for b in fps if a > b and (fps[a] ^ fps[b]).bit_count() <= 4])
    rows += [(None, rows[0][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, fp string, key int")
    found = simhash.simhash_components(df, tile_rows=tile_rows)
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in found.collect()}
    assert got.pop(None)[1] is None
    assert got == {i: (fps[i], want[i]) for i in fps}
    kept = simhash.simhash_dedup(df.union(df.where("doc_id = 5")))
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({*want.values()})


def test_rows_that_repeat_a_key_are_one_document(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (2, "v w x y z"), (3, "v w x y z")], "doc_id bigint, text string")
    assert {(r["doc_id"], r["component_id"]) for r in simhash.simhash_components(df).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query(spark):
    out = queries.QUERIES["op7_simhash"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 200
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in out.collect())
