"""Language identification, the ordinal classifier, and token counts of sections."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from calibra.llm import language, ordinal, queries, token_spans


def test_language_of_held_out_documents(spark, tables):
    """The tags of a third of the rows are hidden; the text and the source must tell them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("tag", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))
    out, names = language.identify(docs, declared="tag", host="source")
    held = out.where("doc_id % 3 = 0 and n_chars > 100")
    assert held.where(F.col(names["language"]) == F.col("lang")).count() >= 0.97 * held.count()
    assert out.where(names["accepted"]).count() >= 0.97 * docs.count()


def test_evidence_decides_where_the_text_does_not(spark):
    rows = [(i, w, t, h, None, None) for i, (w, t, h) in enumerate(
        [("the house and the garden of the king", "en", "a.example.com")] * 20
        + [("das haus und der garten des herrn", "de", "b.example.de")] * 20
        + [("ab", None, "a.example.com"), ("ab", None, "b.example.de"), ("ab", "de", None), ("ab", "en", None), ("ab", None, "new.example.de")]
    )]
    rows += [(90, None, "en", "a.example.com", "x", 1), (91, "", "en", None, "x", 1), (92, "12 345 --", "de", None, "x", 1)]
    df = spark.createDataFrame(rows, "id int, text string, tag string, host string, language string, p int")
    out, names = language.identify(df, declared="tag", host="host")
    assert names["language"] == "language_" and out.columns[:6] == df.columns
    got = {r["id"]: r for r in out.collect()}
    assert [got[i]["language_"] for i in range(40, 45)] == ["en", "de", "de", "en", "de"]
    for i in (90, 91, 92):
        assert (got[i]["language_"], got[i]["posterior"], got[i]["accepted"]) == ("und", 1.0, False)
    assert len(got) == len(rows)


def test_suffix_is_evidence(spark):
    rows = [(i, "the garden and the king", "en", "com") for i in range(30)] + [(40 + i, "der garten und das haus", "de", "de") for i in range(30)]
    rows += [(90, "ab", None, "com"), (91, "ab", None, "de")]
    out, names = language.identify(spark.createDataFrame(rows, "id int, text string, tag string, s string"), declared="tag", suffix="s")
    got = {r["id"]: r[names["language"]] for r in out.collect()}
    assert (got[90], got[91]) == ("en", "de")


def test_language_of_nothing(spark):
    schema = "id int, text string, tag string"
    for rows in ([], [(1, "a", None), (2, None, None)]):
        out, names = language.identify(spark.createDataFrame(rows, schema), declared="tag")
        assert [r[names["accepted"]] for r in out.collect()] == [False] * len(rows)


def test_long_text_is_read_whole(monkeypatch):
    text = "wort und garten " * 300
    whole = np.concatenate(list(language.grams(text)))
    monkeypatch.setattr(language, "_CHARS_AT_ONCE", 100)
    assert np.array_equal(whole, np.concatenate(list(language.grams(text))))
    assert [sum(map(len, language.grams(t))) for t in (None, "", " 1\n", "a")] == [0, 0, 0, 1]


def test_pages_query(spark):
    out = queries.QUERIES["language_id_pages"](spark, "/root/testdata/sf0.01")
    assert out.count() == 250 and out.where("accepted and language = declared").count() > 200


# --- ordinal classifier ------------------------------------------------------------------


def test_gradient_finds_ordered_grades():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((800, 5))
    grades = np.digitize(x @ np.array([2.0, -1, 0.5, 0, 0]) + 0.3 * rng.logistic(size=800), [-1.0, 1.5])
    rows = [(np.arange(5, dtype=np.int32), v) for v in x]
    w, cuts = ordinal.fit(rows, grades, 3, steps=400)
    assert (np.diff(cuts) > 0).all()
    p = ordinal.tail_probabilities(x @ w[:5], cuts)
    assert (np.diff(p, axis=1) <= 0).all()
    assert (np.round(p.sum(axis=1)) == grades).mean() > 0.85


def test_held_out_accuracy(spark):
    directory = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{directory}/{t}.parquet") for t in ("documents", "labels"))
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    labels = labels.select("doc_id", grade.alias("grade"))
    model = ordinal.train(docs, labels.where("doc_id % 3 <> 0"))
    out, names = ordinal.grade(docs.join(labels.where("doc_id % 3 = 0"), "doc_id"), model)
    rows = out.collect()
    right = np.mean([(r["grade"] == 2) == r[names["selected"]] for r in rows])
    most = np.mean([r["grade"] == 2 for r in rows])
    assert right > 0.9 and right > most + 0.05
    assert np.corrcoef([r["grade"] for r in rows], [r[names["expected_grade"]] for r in rows])[0, 1] > 0.7


def test_grading_odd_rows_and_no_grades(spark):
    docs = spark.createDataFrame([(1, "good words here", "x"), (2, "bad things", "x"), (3, None, "x"), (4, "", "x"), (5, "w " * 700_000, "x")], "doc_id int, text string, selected string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id int, grade int")
    model = ordinal.train(docs, labels)
    out, names = ordinal.grade(docs, model)
    assert names["selected"] == "selected_"
    got = {r["doc_id"]: r["expected_grade"] for r in out.collect()}
    assert got[1] > got[3] == got[4] > got[2] and len(got) == 5
    assert ordinal.grade(docs.limit(0), model)[0].count() == 0
    for few in (labels.where("doc_id = 1"), labels.limit(0), labels.withColumn("doc_id", F.col("doc_id") + 100)):
        assert ordinal.train(docs, few) is None
    assert ordinal.train(docs.limit(0), labels) is None
    out, names = ordinal.grade(docs, None)
    assert {tuple(r) for r in out.select(*names.values()).collect()} == {(None, None, False)} and out.count() == docs.count()


# --- tokens of sections --------------------------------------------------------------------


def plain_sections(text, rule):
    """Token by token, byte by byte."""
    encoding, _ = token_spans.encoder()
    data = text.encode()
    line_of, line = [], 0
    for b in data:
        line_of.append(line)
        line += b == 10
    n, at = {}, 0
    for t in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(t))
        lines = line_of[at : at + size]
        own = lines[0] if rule == "first" else lines[-1] if rule == "last" else max(sorted(set(lines)), key=lines.count)
        n.setdefault(own, [0, 0])
        n[own][0] += 1
        n[own][1] += len(set(lines)) > 1
        at += size
    return [tuple(n.get(i, [0, 0])) for i in range(line_of[-1] + 1)] if data else []


@pytest.mark.parametrize("rule", token_spans.RULES)
def test_sections_against_plain_count(spark, rule):
    texts = ["one line", "a\n\n\n\nb\n", "\n \n\t\nx", "é\nñ ü\r\n\r\nz\n\n", "", None, "x" * 5000 + "\n" + "y z " * 4000]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, "a\nb", "s", 1)], "doc_id bigint, text string, section string, key int")
    got = {}
    for r in token_spans.section_tokens(df, rule=rule).orderBy("doc_id", "section").collect():
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["n_crossing"]))
    assert got.pop(None) == plain_sections("a\nb", rule)
    assert got == {i: plain_sections(t, rule) for i, t in enumerate(texts) if t}


def test_sections_of_all_documents(spark, tables):
    encoding, _ = token_spans.encoder()
    out = queries.QUERIES["op6_token_counts"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "section", "start_byte", "end_byte", "n_tokens", "n_crossing"]
    got = {r["doc_id"]: r["n_tokens"] for r in token_spans.document_tokens(out).collect()}
    assert got == {r["doc_id"]: len(encoding.encode_ordinary(r["text"])) for r in tables("documents").collect() if r["text"]}
    assert token_spans.section_tokens(tables("documents").limit(0)).count() == 0


def test_documents_without_text_count_no_tokens(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a\nb"), (None, "")], "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op6_token_counts"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in out.where("doc_id is null or doc_id < 3").collect()), key=str) == [(1, 0, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0), (None, 0, 0, 0, 0, 0)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_spans.document_tokens(out).collect()}
    assert got.pop(3) >= 3 and got == {1: 0, 2: 0, None: 0}
