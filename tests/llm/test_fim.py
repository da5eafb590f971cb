import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from calibra.llm import fim, queries

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain_cut(key, text, seed=42, fim_percent=50, spm_percent=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts_for_test():
    rng = random.Random(3)
    alphabet = list("ab \t\n\x0b\x0c\r\x0e\x08\x1f!") + ["é", "漢", "😀", "\x85", "\xa0", " ", "\x00", "\x7f", "<", "<P", ">", "  "]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(400)]
    texts += [None, "", " ", "\n\t ", "a", " a", "a ", "x" * 8, "x" * 7 + " ", " " * 8 + "y", "<P>", "a <S> b", "<M", "S>", "<" * 9 + " >" * 9]
    return texts + ["word " * 30_000, "é " * 9_000, " " * 5_000, texts[3], texts[3]]


@pytest.mark.parametrize(("fim_percent", "spm_percent"), [(50, 80), (100, 50), (0, 0)])
def test_same_as_plain(spark, fim_percent, spm_percent):
    rows = [(i, t, i, "x", "y") for i, t in enumerate(texts_for_test())] + [(None, "no key here", 1, None, None), (5, "a b c d", 2, "", ""), (5, "a b c d", 2, "", "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int, form string, OUTPUT string")
    out, names = fim.transform(df, fim_percent=fim_percent, spm_percent=spm_percent)
    assert names["n"] == "n_" and out.columns[:5] == df.columns
    out = out.withColumn("back", fim.restore(names["output"], names["form"]))
    got = sorted(((r["doc_id"], *[r[names[f]] for f in fim.FIELDS], r["back"]) for r in out.repartition(3).collect()), key=str)
    want = sorted(((r[0], *plain_cut(r[0], r[1], fim_percent=fim_percent, spm_percent=spm_percent), r[1] or "") for r in rows), key=str)
    assert got == want


def test_marks_of_every_byte_at_every_place():
    for place in range(8):
        data = np.zeros((256, 8), dtype=np.uint8) + np.uint8(0x41)
        data[:, place] = np.arange(256)
        words = fim.words_of(data.reshape(-1))
        space = (fim.space_marks(words) >> np.uint64(8 * place + 7)) & np.uint64(1)
        assert np.flatnonzero(space).tolist() == [9, 10, 11, 12, 13, 32]
        first = (fim.char_marks(words) >> np.uint64(8 * place + 7)) & np.uint64(1)
        assert np.flatnonzero(first == 0).tolist() == list(range(0x80, 0xC0))


def test_select_finds_every_mark():
    rng = np.random.default_rng(1)
    marked = rng.random(800) < 0.3
    marks = fim.Marks(fim.words_of((marked * 0x80).astype(np.uint8)))
    at = np.flatnonzero(marked)
    assert marks.place(np.arange(1, len(at) + 1)).tolist() == at.tolist()
    assert marks.before(np.arange(801)).tolist() == np.concatenate([[0], np.cumsum(marked)]).tolist()


def test_slices_and_empty_batches():
    whole = pa.array(["zero", "one two ", "", "three"])
    h = [np.array([1, 1], dtype=np.int64)] * 2 + [np.zeros(2, dtype=np.int64)] * 2
    assert fim.cut(whole.slice(1, 2), h, 50, 80).field("n").to_pylist() == [3, 0]
    assert len(fim.cut(whole.slice(0, 0), [x[:0] for x in h], 50, 80)) == 0


@pytest.mark.parametrize("size", [1, 7, 64, 10**6])
def test_parts_of_a_batch(monkeypatch, size):
    monkeypatch.setattr(fim, "BYTES_AT_ONCE", size)
    texts = [t or "" for t in texts_for_test()]
    h = [np.random.default_rng(i).integers(0, 1 << 32, len(texts)) for i in range(4)]
    assert fim.cut_in_parts(pa.array(texts), h, 80, 50).equals(fim.cut(pa.array(texts), h, 80, 50))
    assert len(fim.cut_in_parts(pa.array([], pa.string()), [x[:0] for x in h], 80, 50)) == 0


def test_no_rows_and_any_partitioning(spark):
    schema = "doc_id bigint, text string"
    assert fim.transform(spark.createDataFrame([], schema))[0].count() == 0
    df = spark.createDataFrame([(i, f"a{i} b c\nd {i}") for i in range(300)], schema)
    first = sorted(map(str, fim.transform(df)[0].collect()))
    assert sorted(map(str, fim.transform(df.repartition(7))[0].collect())) == first


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    got = queries.QUERIES["op13_fill_in_middle"](spark, "/root/testdata/sf0.01").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(r["doc_id"], *(c := plain_cut(r["doc_id"], r["text"]))[:4], sha(c[4]), sha(r["text"] or "")) for r in docs]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
