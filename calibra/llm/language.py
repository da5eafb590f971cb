"""Language identification by fusing evidence: text, declared tag, address suffix, host.

The text likelihood is a naive Bayes model of hashed character trigrams, fitted to the declared tags
of all rows and tempered, since the trigrams of a long text are far from independent.  How often a
tag, a suffix or a host goes with a language is counted by grouped aggregation of the text
posteriors of all rows; the prior of a host is smoothed towards that of its domain, and that towards
all rows.  A row's own share is taken out of every count before it is used on that row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sizing import bounded_rows
from .shared import fresh, store

BUCKETS, MAX_LANGUAGES = 1 << 15, 200
TEMPERED, SMOOTHING, UNKNOWN_PRIOR, MIN_POSTERIOR = 100, 5.0, 0.01, 0.5
BROADCAST_HOSTS = 100_000
UNKNOWN = "und"
_CHARS_AT_ONCE = 1 << 18
# Everything in ASCII that is no letter counts as one separator.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], dtype=np.uint32)


def grams(text: str | None):
    """Blocks of bucket numbers of the trigrams of a text that hold a letter."""
    # A separator on either side, so that a single letter has a trigram.
    data = np.frombuffer(f" {text or ''} ".lower().encode("utf-8", "replace"), dtype=np.uint8)
    for i in range(0, len(data) - 2, _CHARS_AT_ONCE):
        b = _FOLD[data[i : i + _CHARS_AT_ONCE + 2]]
        code = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
        # Runs of separators say nothing.
        code = code[((code >> 8) != 0x2020) & ((code & 0xFFFF) != 0x2020)]
        yield (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def train(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Log-probabilities ``(bucket, language)`` from all rows ``(text, declared)`` with a known tag."""

    def count(frames):
        total = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for frame in frames:
            for text, tag in zip(frame["text"], frame["declared"]):
                for block in grams(text):
                    total[languages.index(tag)] += np.bincount(block, minlength=BUCKETS)
        i, j = np.nonzero(total)
        yield pd.DataFrame({"l": i, "g": j, "n": total[i, j]})

    known = rows.select("text", "declared").where(F.col("declared").isin(languages))
    counts = known.mapInPandas(count, "l int, g int, n bigint").groupBy("l", "g").agg(F.sum("n").alias("n"))
    table = np.full((BUCKETS, len(languages)), 0.5)
    # At most BUCKETS rows a language.
    for r in counts.collect():
        table[r["g"], r["l"]] += r["n"]
    return np.log(table / table.sum(axis=0)).astype(np.float32)


def _softmax(logs: np.ndarray) -> np.ndarray:
    odds = np.exp(logs - logs.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def likelihoods(texts: pd.Series, model: np.ndarray, tempered: int = TEMPERED) -> np.ndarray:
    """A row per text: its tempered log-likelihood per language, then of unknown text, then the number of trigrams."""
    unknown, out = -np.log(BUCKETS), np.zeros((len(texts), model.shape[1] + 2))
    for row, value in zip(out, texts):
        for block in grams(value):
            row[:-2] += model[block].sum(axis=0, dtype=np.float64)
            row[-1] += len(block)
        if row[-1]:
            row[-2] = unknown * row[-1]
            row[:-1] *= min(1.0, tempered / row[-1])
    return out


def fuse(ll: np.ndarray, counts: dict[str, np.ndarray], seen: np.ndarray, smoothing: float) -> np.ndarray:
    """Posteriors of the languages and, last, of unknown text.

    ``counts`` has the soft counts of every row's declared tag, suffix, host and domain (NaN: no
    evidence), ``seen`` those of all rows.
    """
    k, letters = len(seen), ll[:, -1:] > 0
    # Rows without letters are in no count.
    own = np.where(letters, _softmax(ll[:, :-1])[:, :k], 0.0)
    counts = {by: np.maximum(c - own, 0.0) for by, c in counts.items()}
    logs, total = ll[:, :-1].copy(), max(seen.sum(), 1.0)
    for by in ("declared", "suffix"):
        c = counts[by]
        there = ~np.isnan(c[:, 0])
        # The frequency of a value in all rows is the prior of that in a language, and all that is known of other text.
        overall = c.sum(axis=1, keepdims=True) / total
        given = np.log((c + smoothing * overall + 1e-9) / (seen + smoothing + 1e-9))
        logs[there] += np.concatenate([given, np.log(overall + 1e-9 / total)], axis=1)[there]
    prior = np.broadcast_to((seen + 1) / (seen.sum() + k), own.shape)
    for by in ("domain", "host"):
        c = counts[by]
        smoothed = (c + smoothing * prior) / (c.sum(axis=1, keepdims=True) + smoothing)
        prior = np.where(np.isnan(c), prior, smoothed)
    logs[:, :k] += np.log(prior * (1 - UNKNOWN_PRIOR))
    logs[:, k] += np.log(UNKNOWN_PRIOR)
    return _softmax(logs)


def registered_domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _counts(light: DataFrame, by: str, column: str, name: str, k: int) -> DataFrame:
    sums = [F.sum(F.col("p")[i]) for i in range(k)]
    found = light.where(F.col(by).isNotNull()).groupBy(F.col(by).alias(column)).agg(F.array(*sums).alias(name))
    return store(found, f"by-{by}")


def _look_up(rows: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Left join; the table is broadcast where a count shows that it is small."""
    small = table.count() <= BROADCAST_HOSTS
    return rows.join(F.broadcast(table) if small else table, column, "left")


def identify(
    rows: DataFrame,
    text: str = "text",
    declared: str | None = None,
    host: str | None = None,
    suffix: str | None = None,
    languages: list[str] | None = None,
    smoothing: float = SMOOTHING,
    min_posterior: float = MIN_POSTERIOR,
) -> tuple[DataFrame, dict[str, str]]:
    """``rows`` with language, posterior and accepted, and the names these columns got.

    ``declared``, ``host`` and ``suffix`` name the columns of further evidence; a missing value is
    no evidence.  ``languages`` defaults to all declared tags (more than 200 fail loudly).  A row is
    accepted when its text holds a letter, a language beats unknown text, and the posterior reaches
    ``min_posterior``; rows with null, empty or letterless texts are never accepted and are ``und``.
    Ties go to the first language in order.  Repeated rows have equal results; no rows give no rows.
    """
    names = dict(zip(("language", "posterior", "accepted"), fresh(rows, "language", "posterior", "accepted")))
    found, *evidence = fresh(rows, "__found", "__declared", "__suffix", "__host", "__domain")
    kinds = ("declared", "suffix", "host", "domain")
    columns, counted = dict(zip(kinds, evidence)), dict(zip(kinds, fresh(rows, *[f"__c_{by}" for by in kinds])))
    given = {"declared": declared, "suffix": suffix, "host": host, "domain": host}
    values = {by: F.col(c).cast("string") if c else F.lit(None).cast("string") for by, c in given.items()}
    values["domain"] = registered_domain(values["domain"])
    if languages is None:
        tags = rows.select(values["declared"].alias("tag")).where("tag is not null").distinct()
        languages = [r["tag"] for r in bounded_rows(tags, MAX_LANGUAGES, "declared languages")]
    languages = sorted(languages)
    k = len(languages)
    if not k:
        none = {names["language"]: F.lit(UNKNOWN), names["posterior"]: F.lit(1.0), names["accepted"]: F.lit(False)}
        return rows.withColumns(none), names
    model = train(rows.select(F.col(text).alias("text"), values["declared"].alias("declared")), languages)

    @F.pandas_udf("array<double>")
    def posteriors(texts: pd.Series) -> pd.Series:
        ll = likelihoods(texts, model)
        return pd.Series([p if n else None for p, n in zip(_softmax(ll[:, :-1])[:, :k], ll[:, -1])])

    # Never evaluated twice by a filter that moves below the projection.
    light = rows.select(posteriors.asNondeterministic()(F.col(text)).alias("p"), *[v.alias(by) for by, v in values.items()])
    light = light.where(F.col("p").isNotNull())
    light = store(light, "posteriors")
    sums = light.agg(*[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)]).first()
    seen = np.array([float(sums[f"s{i}"] or 0.0) for i in range(k)])

    full = rows.withColumns({columns[by]: values[by] for by in kinds})
    for by in kinds:
        if given[by]:
            full = _look_up(full, _counts(light, by, columns[by], counted[by], k), columns[by])
        else:
            full = full.withColumn(counted[by], F.lit(None).cast("array<double>"))

    @F.pandas_udf("language string, posterior double, accepted boolean")
    def decide(texts: pd.Series, c1: pd.Series, c2: pd.Series, c3: pd.Series, c4: pd.Series) -> pd.DataFrame:
        missing, ll = np.full(k, np.nan), likelihoods(texts, model)
        counts = {by: np.stack([missing if v is None else v for v in c]) for by, c in zip(kinds, (c1, c2, c3, c4))}
        posterior, letters = fuse(ll, counts, seen, smoothing), ll[:, -1] > 0
        best = np.where(letters, posterior.argmax(axis=1), k)
        top = np.where(letters, posterior.max(axis=1), 1.0)
        return pd.DataFrame(
            {
                "language": np.array([*languages, UNKNOWN])[best],
                "posterior": top,
                "accepted": letters & (best < k) & (top >= min_posterior),
            }
        )

    full = full.withColumn(found, decide.asNondeterministic()(F.col(text), *[counted[by] for by in kinds]))
    return full.select(*rows.columns, *[F.col(found)[c].alias(n) for c, n in names.items()]), names
