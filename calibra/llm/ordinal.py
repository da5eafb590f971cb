"""Quality classifier: cumulative-link regression on graded ratings.

One weight per hashed token is shared by all grades; ordered thresholds cut the score into grades:
``P(grade >= j) = sigmoid(w.x - t_j)``.  The thresholds are the first one plus exponentials, so they
stay in order while they are fitted.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .shared import fresh

BUCKETS = 1 << 16
# About so many labelled rows are fitted, drawn by a hash of their key.
MAX_TRAIN = 20_000
STEPS, RATE, PENALTY = 200, 0.5, 1e-5
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CHARS_AT_ONCE = 1 << 20


def _pieces(text: str):
    """Parts of a very long text, cut at white space where there is some."""
    at = 0
    while at < len(text):
        end = at + _CHARS_AT_ONCE
        if end < len(text):
            space = text.rfind(" ", at, end)
            end = space if space > at else end
        yield text[at:end]
        at = end


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: one plus the logarithm of each token's count, scaled to unit length."""
    counts = Counter()
    for piece in _pieces(text or ""):
        counts.update(_TOKEN.findall(piece.lower()))
    buckets = np.fromiter((crc32(t.encode("utf-8", "replace")) % BUCKETS for t in counts), dtype=np.int64, count=len(counts))
    values = 1 + np.log(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    kept, where = np.unique(buckets, return_inverse=True)
    values = np.bincount(where, values, len(kept)) if len(kept) else values
    return kept.astype(np.int32), (values / (np.linalg.norm(values) or 1.0)).astype(np.float32)


def cut_points(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def tail_probabilities(score: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """``P(grade >= j)`` for ``j`` from 1, a column each."""
    return 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -60, 60)))


def fit(rows: list, grades: np.ndarray, n_grades: int, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY):
    """Weights and thresholds by Adam on the whole sample; ``rows`` are pairs (buckets, values)."""
    sizes = np.array([len(b) for b, _ in rows])
    at, value = np.concatenate([b for b, _ in rows]), np.concatenate([v for _, v in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), sizes)
    least = np.array([(np.sum(grades >= j) + 1) / (len(grades) + 2) for j in range(1, n_grades)])
    start = -np.log(least / (1 - least))
    raw = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    x = np.concatenate([np.zeros(BUCKETS), raw])
    first, second = np.zeros_like(x), np.zeros_like(x)
    reached = np.arange(n_grades + 1)[None, :] <= grades[:, None]
    for step in range(1, steps + 1):
        w, raw = x[:BUCKETS], x[BUCKETS:]
        score = np.bincount(row, value * w[at], len(rows))
        p = tail_probabilities(score, cut_points(raw))
        above = np.concatenate([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))], axis=1)
        own = np.arange(len(rows)), grades
        chance = np.maximum(above[own] - above[grades * 0 + own[0], grades + 1], 1e-12)
        slope = above * (1 - above)
        d_score = -(slope[own] - slope[own[0], grades + 1]) / chance / len(rows)
        d_cut = np.zeros(n_grades - 1)
        np.add.at(d_cut, np.maximum(grades - 1, 0), np.where(grades > 0, slope[own] / chance / len(rows), 0.0))
        np.add.at(
            d_cut, np.minimum(grades, n_grades - 2), np.where(grades < n_grades - 1, -slope[own[0], grades + 1] / chance / len(rows), 0.0)
        )
        tail = d_cut[::-1].cumsum()[::-1]
        grad = np.concatenate([np.bincount(at, value * d_score[row], BUCKETS) + penalty * w, tail[:1], tail[1:] * np.exp(raw[1:])])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        x = x - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return x[:BUCKETS].astype(np.float32), cut_points(x[BUCKETS:])


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade",
    max_train: int = MAX_TRAIN, steps: int = STEPS,
) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and thresholds from ``labels (key, grade)``, grades from 0.

    About ``max_train`` labelled rows, drawn by hash, are fitted in one task; labels without key or
    grade do not count, and a label counts as often as rows repeat it.  Without documents of two different
    grades there is nothing to fit and no model: None.
    """
    labels = labels.select(F.col(key).alias("k"), F.col(grade).cast("int").alias("grade")).where("k is not null and grade >= 0")
    stats = labels.agg(F.count(F.lit(1)).alias("n"), F.max("grade").alias("top"), F.min("grade").alias("low")).first()
    if not stats["n"] or stats["top"] == stats["low"]:
        return None
    n_grades = stats["top"] + 1
    part = int(min(1.0, max_train / stats["n"]) * 1_000_000)
    # About max_train rows, whatever the data.
    sample = F.broadcast(labels.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < part))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(sample, "k").select("text", "grade")

    def encode(frames):
        for frame in frames:
            found = [features(t) for t in frame["text"]]
            yield pd.DataFrame({"b": [b.tobytes() for b, _ in found], "v": [v.tobytes() for _, v in found], "grade": frame["grade"]})

    def learn(frames):
        frame = pd.concat([*frames, pd.DataFrame({"b": [], "v": [], "grade": []})])
        # The order in which rows arrive must not matter.
        frame = frame.sort_values(["b", "v", "grade"])
        if frame["grade"].nunique() < 2:
            return
        pairs = [(np.frombuffer(b, dtype=np.int32), np.frombuffer(v, dtype=np.float32)) for b, v in zip(frame["b"], frame["v"])]
        w, cuts = fit(pairs, frame["grade"].to_numpy().astype(int), n_grades, steps)
        yield pd.DataFrame({"w": [w.tobytes()], "cuts": [cuts.tobytes()]})

    encoded = rows.mapInPandas(encode, "b binary, v binary, grade int")
    model = encoded.repartition(1).mapInPandas(learn, "w binary, cuts binary").collect()
    if not model:
        return None
    return np.frombuffer(model[0]["w"], dtype=np.float32), np.frombuffer(model[0]["cuts"])


def grade(docs: DataFrame, model: tuple | None, text: str = "text", tail: int | None = None, least: float = 0.5) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with expected_grade, p_tail and selected, and the names these columns got.

    ``p_tail`` is the probability of at least grade ``tail`` (the highest by default), and a row is
    selected from ``least`` on, ties included.  Null and empty texts, and texts of unknown tokens, have
    score zero.  Without a model grade and probability are null and nothing is selected.
    """
    names = dict(zip(("expected_grade", "p_tail", "selected"), fresh(docs, "expected_grade", "p_tail", "selected")))
    if model is None:
        none = F.lit(None).cast("double")
        return docs.withColumns(dict(zip(names.values(), (none, none, F.lit(False))))), names
    weights, cuts = model
    at = (len(cuts) if tail is None else tail) - 1
    column, = fresh(docs, "__p")

    @F.pandas_udf("array<double>")
    def probabilities(texts: pd.Series) -> pd.Series:
        found = [features(t) for t in texts]
        score = np.array([float(weights[b] @ v) for b, v in found])
        return pd.Series(list(tail_probabilities(score, cuts)))

    # Never evaluated twice by a filter that moves below the projection.
    out = docs.withColumn(column, probabilities.asNondeterministic()(F.col(text)))
    total = F.aggregate(column, F.lit(0.0), lambda a, v: a + v)
    out = out.withColumns({names["expected_grade"]: total, names["p_tail"]: F.get(F.col(column), F.lit(at))})
    return out.withColumn(names["selected"], F.col(names["p_tail"]) >= least).drop(column), names
