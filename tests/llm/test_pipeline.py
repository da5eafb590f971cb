"""The pipeline against a plain version of its stages, each held to its own input."""

import re

import corpus_pipeline
import numpy as np
import pytest
from brute import component_of
from public_tokenizers import path
from test_simhash import plain as fingerprint
from tokenizers import Tokenizer

from calibra.llm import substring_dedup as S

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{DIRECTORY}/documents.parquet"), []
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, DIRECTORY).collect()
        if name != "bpe":
            assert set(rows[0].asDict()) == set(docs.columns)
            docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "mixing", "bpe"]


def test_language_stage_keeps_what_reads_as_a_language(steps):
    before, after = steps[0], {r["doc_id"]: r for r in steps[1]}
    assert len(after) >= 0.97 * len(before)
    for r in before:
        if r["doc_id"] in after:
            assert after[r["doc_id"]]["text"] == r["text"]
        else:
            assert len(re.findall(r"[^\W\d_]", r["text"] or "")) < 20


def test_simhash_stage(steps):
    fps = {r["doc_id"]: fingerprint(r["text"]) for r in steps[1]}
    want = component_of(fps, [(a, b) for a in fps for b in fps if a > b and (fps[a] ^ fps[b]).bit_count() <= 4])
    assert sorted(r["doc_id"] for r in steps[2]) == sorted({*want.values()})


def test_substring_stage(steps):
    owner, want = {}, {}
    rows = sorted((r["doc_id"], r["text"].encode()) for r in steps[2])
    for i, t in rows:
        for d in S.chunk_digests(t)[2].tolist():
            owner.setdefault(d, i)
    for i, t in rows:
        spans = S.repeated_spans(t, {d: owner[d] for d in S.chunk_digests(t)[2].tolist() if owner[d] != i})
        text = S.cut_out(t, spans)
        if not spans or text.strip():
            want[i] = text
    assert {r["doc_id"]: r["text"] for r in steps[3]} == want


def test_mixing_stage(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[3]}
    taken = [r["doc_id"] for r in steps[4]]
    assert all(r["text"] == texts[r["doc_id"]] for r in steps[4]) and max(map(taken.count, taken)) <= 3
    size = {i: len(t.split()) for i, t in texts.items()}
    assert sum(size[i] for i in taken) == pytest.approx(sum(size.values()), rel=0.2)


def test_token_stage(steps):
    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], t.encode(r["text"], add_special_tokens=False).ids) for r in steps[4])
    assert sorted((r["doc_id"], np.frombuffer(r["ids"], dtype="<u4").tolist()) for r in steps[5]) == want


def test_token_stage_decodes(steps):
    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    for r in steps[5]:
        assert r["decoded"] == t.decode(np.frombuffer(r["ids"], dtype="<u4").tolist(), skip_special_tokens=False)
    assert sum(len(r["decoded"]) > 0 for r in steps[5]) == sum(len(r["text"]) > 0 for r in steps[4])


def test_run_is_the_stages(spark, steps):
    out = corpus_pipeline.run(spark, DIRECTORY)
    assert sorted(map(str, out.collect())) == sorted(map(str, steps[5]))


@pytest.mark.parametrize("number", range(5))
def test_stages_on_odd_and_no_rows(spark, number):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, key int"
    rows = [(1, None, "en", None, None, "x", 1), (2, "", None, "s", 0, "x", 1), (3, "the garden " * 30, None, None, 330, None, None)]
    rows += [(3, "the garden " * 30, None, None, 330, None, None), (None, "of the house and " * 9, "en", "s", 153, "x", 1)]
    stage = corpus_pipeline.STAGES[number][1]
    df = spark.createDataFrame(rows, schema)
    out = stage(spark, df, DIRECTORY)
    assert number == 4 or out.columns == df.columns
    assert out.count() <= 3 * len(rows)
    assert stage(spark, df.limit(0), DIRECTORY).count() == 0
