import random

import numpy as np

from calibra.llm import queries
from calibra.llm.chunks import byte_chunks, rolling, word_chunks
from calibra.llm.substring_dedup import cut_out, dedup_substrings, repeated_spans


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_rolling_hash_sees_its_window_only():
    data = np.frombuffer(words(1, 200).encode(), dtype=np.uint8)
    whole, part = rolling(data), rolling(data[100:])
    assert (whole[115:] == part[15:]).all() and len(set(whole.tolist())) > 500


def test_chunks_follow_an_insertion():
    text = words(2, 400).encode()
    starts, all_ = word_chunks(np.frombuffer(text, dtype=np.uint8), 2)
    moved, _ = word_chunks(np.frombuffer(b"some new words " + text, dtype=np.uint8), 2)
    assert len(all_) == 400 and len(set(starts + 15) - set(moved)) <= 2
    assert {text[i - 1 : i] for i in starts[1:]} == {b" "}
    assert all(text[i] & 0xC0 != 0x80 for i in byte_chunks(np.frombuffer(text, dtype=np.uint8), 3))


def run(spark, rows):
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id bigint, text string, spans string, digest int")
    out, names = dedup_substrings(df.repartition(4))
    assert names == {"spans": "spans_"} and out.columns == [*df.columns, "spans_"]
    return out.collect()


def test_passages_go_from_all_but_the_first(spark):
    passage = words(5, 52)
    rows = [(i, f"{words(100 + i, 80)} {passage}\n{words(500 + i, 70)}") for i in range(40)]
    rows += [(i, words(900 + i, 150)) for i in range(60, 80)]
    old = dict(rows)
    new = {r["doc_id"]: r for r in run(spark, rows)}
    assert new[0]["text"] == old[0] and not new[0]["spans_"]
    for i in range(1, 40):
        assert passage not in new[i]["text"] and [s["kept_in"] for s in new[i]["spans_"]] == [0]
        # A short word beside the passage may chance to be the same in another document.
        assert new[i]["text"].startswith(words(100 + i, 80)[:-20]) and new[i]["text"].endswith(words(500 + i, 70)[20:])
    for i in range(60, 80):
        assert new[i]["text"] == old[i]


def test_same_as_the_chunks_of_all_documents(spark, tables):
    """Brute force: owners from one dictionary over all documents in the order of their keys."""
    from calibra.llm.substring_dedup import chunk_digests

    rows = sorted((r["doc_id"], r["text"]) for r in tables("documents").collect())
    owner = {}
    for i, t in rows:
        for d in chunk_digests(t.encode())[2].tolist():
            owner.setdefault(d, i)
    want = {}
    for i, t in rows:
        foreign = {d: owner[d] for d in chunk_digests(t.encode())[2].tolist() if owner[d] != i}
        want[i] = cut_out(t.encode(), repeated_spans(t.encode(), foreign))
    assert {r["doc_id"]: r["text"] for r in run(spark, rows)} == want
    assert sum(want[i] != t for i, t in rows) > 10


def test_odd_rows(spark):
    long = words(9, 30_000)
    rows = [(1, None), (2, ""), (3, " \n "), (4, long), (5, "x " + long), (6, "one"), (6, "one"), (None, long), (7, words(3, 40) + " " + words(3, 40))]
    out = run(spark, rows)
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], []).append(r["text"])
    assert got[1] == [None] and got[2] == [""] and got[3] == [" \n "] and got[4] == [long] and got[6] == ["one", "one"]
    assert len(got[5][0].split()) < 30 and len(got[None][0].split()) < 30
    assert len(got[7][0].split()) < 60
    assert [s["kept_in"] for r in out if r["doc_id"] == 7 for s in r["spans_"]] == [7]


def test_no_rows(spark):
    assert run(spark, []) == []


def test_query(spark):
    out = queries.QUERIES["op8_substring_dedup"](spark, "/root/testdata/sf0.001")
    assert out.count() == 200 and out.columns[:2] == ["doc_id", "text"]


def covered(rows, n=16):
    """Words to cut of every text, by plain comparison of windows of words in the order of the keys."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        all_, first, marks = text.split(), {}, set()
        for at in range(len(all_) - n + 1):
            window = tuple(all_[at : at + n])
            if window in seen or at - first.setdefault(window, at) >= n:
                marks.update(range(at, at + n))
        for window in first:
            seen.setdefault(window, i)
        out[i] = [w for at, w in enumerate(all_) if at not in marks]
    return out


def test_periodic_runs_are_cut(spark):
    """One word, two words and a short line, repeated for 51 words or more in two documents and in other phases."""
    periods = ["and", "der", "a", "no", "yes no", "to be", "x y", "the same old line\n", "Home | About us | Log in\n"]
    rows = []
    for p, period in enumerate(periods):
        run_ = (period + " ") * (-(-60 // len(period.split())))
        rows += [(10 * p + 1, f"{words(p, 40)} {run_} {words(50 + p, 40)}"), (10 * p + 2, f"{words(100 + p, 43)} {run_[len(period.split()[0]):]} {words(150 + p, 40)}")]
    got = {r["doc_id"]: r["text"].split() for r in run(spark, rows)}
    for p in range(len(periods)):
        # One copy of a window of 16 words stays, in the first document; the other keeps its own words only.
        assert len(got[10 * p + 1]) <= 80 + 16 + 6, periods[p]
        assert got[10 * p + 2] == words(100 + p, 43).split() + words(150 + p, 40).split(), periods[p]
    assert got == covered(rows)


def test_words_that_never_stood_together_stay(spark):
    """Whole chunks of earlier texts, each shorter than 16 words, in an order that stands nowhere."""

    def chunks(text):
        data = text.encode()
        at = [*word_chunks(np.frombuffer(data, dtype=np.uint8), 2)[0].tolist(), len(data)]
        return [data[a:b].decode().rstrip() for a, b in zip(at, at[1:])]

    sources = [(i, words(i, 60)) for i in range(1, 31)]
    parts = [c for _, t in sources for c in chunks(t)[1:-1] if len(c.split()) < 12 and len(c.encode()) > 16]
    mixed = []
    for part in random.Random(7).sample(parts, len(parts)):
        if chunks(" ".join([*mixed, part])) == [*mixed, part]:
            mixed.append(part)
    rows = [*sources, (100, " ".join(mixed))]
    assert len(rows[-1][1].split()) > 100
    assert covered(rows) == {i: t.split() for i, t in rows}
    out = run(spark, rows)
    assert {r["doc_id"]: r["text"] for r in out} == dict(rows) and not any(r["spans_"] for r in out)


def test_same_as_plain_windows_of_words(spark, tables):
    rows = [(r["doc_id"], r["text"]) for r in tables("documents").collect()]
    want = covered(rows)
    assert {r["doc_id"]: r["text"].split() for r in run(spark, rows)} == want
    assert sum(want[i] != t.split() for i, t in rows) > 10
