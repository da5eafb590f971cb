import hashlib
import random

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from calibra.llm import bpe, queries

PLAIN = Tokenizer.from_file(path("word_bpe_49k.json"))


def plain(text):
    ids = PLAIN.encode(text or "", add_special_tokens=False).ids
    return ids, PLAIN.decode(ids, skip_special_tokens=False)


def passage(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéñü's,.1 2") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def rows_for_test():
    shared = [passage(i, 400) for i in range(4)]
    rows = []
    for i in range(30):
        rng = random.Random(100 + i)
        parts = [shared[rng.randrange(4)], passage(200 + i, 60), shared[rng.randrange(4)][rng.randrange(50) :]]
        rows.append((i, rng.choice(["", " ", "\n\n", "x"]).join(parts)))
    rows += [(40, None), (41, ""), (42, " \t\n "), (43, "nospace" * 900), (44, "nospace" * 900), (45, rows[0][1])]
    rows += [(46, "<|endoftext|> a <|start" + "oftext|>" + shared[0]), (47, "İ ß ﬁ é ́   " + shared[1])]
    rows += [(None, shared[2]), (0, shared[2] + " other text of the same id"), (0, rows[0][1])]
    return rows


@pytest.mark.parametrize(("zero_bits", "broadcast_rows"), [(6, 5_000_000), (9, 5_000_000), (6, 0)])
def test_same_as_the_tokenizer(spark, zero_bits, broadcast_rows):
    rows = rows_for_test()
    df = spark.createDataFrame([(*r, "c", 1, b"x") for r in rows], "doc_id bigint, text string, key string, n_tokens int, ids binary")
    out = bpe.encode(df.repartition(4), zero_bits=zero_bits, decoded=True, broadcast_rows=broadcast_rows)
    got = sorted(((r["doc_id"], r["n_tokens"], np.frombuffer(r["ids"], dtype="<u4").tolist(), r["decoded"]) for r in out.collect()), key=str)
    want = sorted(((i, len(plain(t)[0]), *plain(t)) for i, t in rows), key=str)
    assert got == want
    again = bpe.decode(bpe.encode(df, zero_bits=zero_bits))
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in again.collect()) == sorted((str(i), plain(t)[1]) for i, t in rows)


def test_long_runs_are_cut_where_both_sides_agree(monkeypatch):
    monkeypatch.setattr(bpe, "_RUN_BYTES", 500)
    for text in (passage(1, 900), "x" * 4000, "a  b\n\n" * 400):
        data = text.encode()
        spans, _ = bpe.segments(data, set(), 9, None)
        assert spans[0][1] == 0 and spans[-1][2] == len(data) and all(a[2] == b[1] for a, b in zip(spans, spans[1:]))
        ids = b"".join(bpe.encode_all([data[s:e].decode() for _, s, e in spans]))
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain(text)[0]


def test_shared_chunks_are_encoded_once(spark, monkeypatch):
    text = passage(7, 3000)
    first = bpe.chunk_spans(text.encode(), 9)
    assert len(first) > 10
    moved = bpe.chunk_spans(("new words " + text).encode(), 9)
    cut = lambda spans, t: {t.encode()[a:b] for a, b in spans}
    assert len(cut(first, text) & cut(moved, "new words " + text)) >= len(first) - 2


def test_pieces_are_reused_only_where_the_vocabulary_splits_at_space(monkeypatch):
    assert bpe.splits_at_space(None) and bpe.splits_at_space(path("byte_bpe_50k.json"))
    monkeypatch.setattr(bpe, "_KNOWN_BYTES", 2000)
    monkeypatch.setattr(bpe, "_BATCH_CHARS", 200)
    texts = [passage(i, 40) for i in range(9)] + ["", "y" * 300, passage(3, 40), " ", "\x0b\x0c a\x1f b\u00a0c"]
    for file in (None, path("byte_bpe_50k.json")):
        t = bpe.tokenizer(file)
        want = [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert [np.frombuffer(v, dtype="<u4").tolist() for v in bpe.encode_all(texts, file)] == want


def test_no_rows(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query(spark):
    directory = "/root/testdata/sf0.01"
    out = queries.QUERIES["op2_bpe"](spark, directory)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for r in spark.read.parquet(f"{directory}/documents.parquet").collect():
        ids, text = plain(r["text"])
        data = np.array(ids, dtype="<u4").tobytes()
        want.append((r["doc_id"], len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, out.collect())) == sorted(want)
