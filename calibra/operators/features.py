"""Encodings, scalers, polynomial terms, principal components and mixed-type preparation."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import with_position
from ..functions.quantiles import quantiles
from ..functions.sizing import TASK_ROWS, bounded_rows, lookup_side
from .describe import modes

# Indicator columns are real columns, so their number is limited; use one_hot_vector beyond it.
MAX_INDICATORS = 1000
# Levels of a text column that a fitted preparation holds.
MAX_LEVELS = 1_000_000
MISSING_LEVEL = "nan"


def levels_of(df: DataFrame, col: str, max_levels: int = MAX_INDICATORS) -> list[str]:
    """Sorted distinct non-missing values as text."""
    found = df.select(F.col(col).cast("string")).where(F.col(col).isNotNull()).distinct()
    return sorted(r[0] for r in bounded_rows(found, max_levels, f"levels of {col}"))


def one_hot(df: DataFrame, cols: list[str], drop_first: bool = False, max_levels: int = MAX_INDICATORS) -> DataFrame:
    """Indicator columns ``<col>_<value>`` in place of the columns; a missing value is all zeros."""
    indicators = {}
    for c in cols:
        for level in levels_of(df, c, max_levels)[1 if drop_first else 0 :]:
            hit = F.col(c).cast("string") == F.lit(level)
            indicators[f"{c}_{level}"] = F.coalesce(hit, F.lit(False)).cast("int")
    return df.withColumns(indicators).drop(*cols)


def one_hot_vector(df: DataFrame, cols: list[str], drop_first: bool = False, task_rows: int = TASK_ROWS) -> DataFrame:
    """Indicators of any number of levels as one sparse vector ``<col>_vec`` in place of each column.

    Position i stands for the i-th level in sorted order; with ``drop_first`` the first level has
    none.  A missing value is all zeros.
    """
    for c in cols:
        codes = level_codes(df, c, task_rows=task_rows)
        first = int(drop_first)
        size = max(codes.count() - first, 1)
        # The number after the last position stands for all zeros.
        code = F.when(F.col("__code") >= first, F.col("__code") - first).otherwise(size).cast("double")
        coded = _with_code(df, c, codes, None).withColumn("__code", code)
        # The encoder learns the number of positions from the largest code.
        top = df.sparkSession.createDataFrame([(float(size),)], "__code double")
        encoder = OneHotEncoder(inputCol="__code", outputCol=f"{c}_vec", dropLast=True).fit(top)
        df = encoder.transform(coded).drop(c, "__code")
    return df


def level_codes(df: DataFrame, col: str, missing: str | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """``(level, code)``: 0-based rank of each distinct value; any number of levels."""
    text = F.col(col).cast("string")
    if missing is not None:
        text = F.coalesce(text, F.lit(missing))
    found = df.select(text.alias("level")).where("level is not null").distinct()
    return with_position(found, ["level"], name="code", task_rows=task_rows)


def _with_code(df: DataFrame, col: str, codes: DataFrame, missing: str | None) -> DataFrame:
    text = F.col(col).cast("string")
    key = F.coalesce(text, F.lit(missing)) if missing is not None else text
    side = lookup_side(codes.select(F.col("level").alias("__level"), F.col("code").alias("__code")))
    return df.join(side, key == F.col("__level"), "left").drop("__level")


def label_encode(df: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Replace text by the rank of its level; missing values form a level of their own."""
    for c in cols:
        codes = level_codes(df, c, MISSING_LEVEL, task_rows)
        df = _with_code(df, c, codes, MISSING_LEVEL).withColumn(c, F.col("__code")).drop("__code")
    return df


def ordinal_fit(df: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> dict[str, DataFrame]:
    """Level codes per column, learned on one table for use on another."""
    return {c: level_codes(df, c, task_rows=task_rows) for c in cols}


def ordinal_transform(df: DataFrame, fitted: dict[str, DataFrame]) -> DataFrame:
    """Replace text by its learned code; unseen or missing values become -1."""
    for c, codes in fitted.items():
        df = _with_code(df, c, codes, None)
        df = df.withColumn(c, F.coalesce("__code", F.lit(-1).cast("bigint"))).drop("__code")
    return df


def binary_encode(df: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Spread the level number (from 1, sorted) over bit columns ``<col>_0`` (highest bit) onwards.

    A missing value has the number 0.  Levels are numbered in sorted order, not by appearance,
    because a distributed table has no order of appearance.
    """
    for c in cols:
        codes = level_codes(df, c, task_rows=task_rows)
        bits = max(1, int(codes.count()).bit_length())
        df = _with_code(df, c, codes, None).withColumn("__code", F.coalesce(F.col("__code") + 1, F.lit(0)))
        df = df.withColumns({f"{c}_{i}": F.getbit("__code", F.lit(bits - 1 - i)).cast("int") for i in range(bits)})
        df = df.drop("__code", c)
    return df


def minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0, missing values stay missing."""
    fields = [F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in cols]
    s = df.agg(F.struct(*fields).alias("s")).scalar()
    return df.withColumns({c: _shifted(c, s[c]["lo"], s[c]["hi"] - s[c]["lo"]) for c in cols})


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    fields = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in cols]
    s = df.agg(F.struct(*fields).alias("s")).scalar()
    return df.withColumns({c: _shifted(c, s[c]["mean"], s[c]["std"]) for c in cols})


def _shifted(col: str, origin: Column, width: Column) -> Column:
    x = F.col(col) - origin
    return F.when(width == 0, x * 0.0).otherwise(F.try_divide(x, width))


def log_positive(df: DataFrame, cols: list[str]) -> DataFrame:
    """Natural logarithm of each column whose rows are all present and positive."""
    row = df.agg(*[F.min(F.coalesce(F.col(c) > 0, F.lit(False))).alias(c) for c in cols]).first()
    return df.withColumns({c: F.log(c) for c in cols if row[c]})


def poly_terms(cols: list[str], degree: int) -> dict[str, Column]:
    """Names and expressions of all monomials up to ``degree``, by degree, then by column order."""
    terms = {}
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(cols, d):
            name = " ".join(c if combo.count(c) == 1 else f"{c}^{combo.count(c)}" for c in dict.fromkeys(combo))
            product = F.col(combo[0]).cast("double")
            for c in combo[1:]:
                product = product * F.col(c).cast("double")
            terms[name] = product
    return terms


def poly(df: DataFrame, cols: list[str], degree: int) -> DataFrame:
    """Polynomial features as columns, without bias."""
    rest = [c for c in df.columns if c not in cols]
    return df.select(*rest, *[e.alias(n) for n, e in poly_terms(cols, degree).items()])


def _assembled(df: DataFrame, cols: list[str], out: str = "__vec") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip").transform(df)


def pca_loadings(df: DataFrame, cols: list[str], k: int) -> tuple[np.ndarray, list[float]]:
    """Loadings (variables x components) and variance shares of already scaled columns.

    The sign of a component is fixed: its largest loading (the first of equals) is positive.
    """
    model = PCA(k=k, inputCol="__vec", outputCol="__pc").fit(_assembled(df, cols))
    loadings = model.pc.toArray()
    size = np.round(np.abs(loadings), 9)
    signs = np.sign(loadings[size.argmax(axis=0), range(k)])
    return loadings * np.where(signs == 0, 1.0, signs), list(model.explainedVariance.toArray())


def _complete(cols: list[str]) -> dict[str, Column]:
    """The columns, missing altogether in rows where one of them is missing or NaN."""
    whole = F.lit(True)
    for c in cols:
        x = F.col(c).cast("double")
        whole = whole & x.isNotNull() & ~F.isnan(x)
    return {c: F.when(whole, F.col(c)) for c in cols}


def pca(df: DataFrame, cols: list[str], k: int = 2) -> DataFrame:
    """Add ``pc1`` .. ``pck`` of the standardised columns.

    Rows with a missing value have no scores and take part neither in the scaling nor in the fit.
    """
    scaled = standardize(df.withColumns({f"__z_{c}": x for c, x in _complete(cols).items()}), [f"__z_{c}" for c in cols])
    loadings, _ = pca_loadings(scaled, [f"__z_{c}" for c in cols], k)
    scores = {}
    for j in range(k):
        score = F.lit(0.0)
        for i, c in enumerate(cols):
            score = score + F.col(f"__z_{c}") * F.lit(float(loadings[i, j]))
        scores[f"pc{j + 1}"] = score
    return scaled.withColumns(scores).drop(*[f"__z_{c}" for c in cols])


def pca_variance(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(component, share, cumulative)`` of the standardised columns, from rows without a missing value."""
    _, shares = pca_loadings(standardize(df.withColumns(_complete(cols)), cols), cols, len(cols))
    rows = [(i + 1, float(s), float(sum(shares[: i + 1]))) for i, s in enumerate(shares)]
    return df.sparkSession.createDataFrame(rows, "component int, share double, cumulative double")


def with_result(df: DataFrame, key: list[str], *results: DataFrame) -> DataFrame:
    """Attach result columns by key, never by position."""
    for r in results:
        df = df.join(r, key, "left")
    return df


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class Prepared:
    """What :class:`TablePreparer` learned: SQL expressions by feature name, in assembler order.

    Features in ``levels`` are texts, coded by their place in the list, -1 when unseen.
    """

    expressions: dict[str, str]
    levels: dict[str, list[str]]
    output: str

    def model(self) -> PipelineModel:
        """Stages that can be saved and reloaded with any fitted pipeline."""
        columns = [f"__f{i}" for i in range(len(self.expressions))]
        texts = {c: self.levels[name] for c, name in zip(columns, self.expressions) if name in self.levels}
        listed = ", ".join(f"{e} AS {f'{c}_text' if c in texts else c}" for e, c in zip(self.expressions.values(), columns))
        stages = [SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__")]
        if texts:
            codes = [f"{c}_code" for c in texts]
            stages.append(
                StringIndexerModel.from_arrays_of_labels(
                    list(texts.values()), [f"{c}_text" for c in texts], codes, handleInvalid="keep"
                )
            )
            # The indexer gives unseen texts the number after the last one.
            seen = [f"CASE WHEN {code} < {len(known)} THEN {code} ELSE -1.0D END AS {c}" for code, (c, known) in zip(codes, texts.items())]
            stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(seen)} FROM __THIS__"))
        stages.append(VectorAssembler(inputCols=columns, outputCol=self.output, handleInvalid="error"))
        return PipelineModel(stages)

    @property
    def names(self) -> list[str]:
        return list(self.expressions)


class TablePreparer(Estimator):
    """Mixed-type preparation as a pipeline stage, so a search refits it in every fold.

    Numeric columns: median fill, then population standardisation when ``scale``.
    Text columns: most frequent value, then ordinal code, -1 when unseen.  A column without any
    value becomes a constant: 0 for numbers, -1 for text.
    ``passthrough`` columns are taken as they are.  Feature names follow the assembler input:
    numeric, text, passthrough.
    """

    def __init__(self, num=(), cat=(), passthrough=(), scale=True, output="features", max_levels=MAX_LEVELS):
        super().__init__()
        self.num, self.cat, self.passthrough = list(num), list(cat), list(passthrough)
        self.scale, self.output, self.max_levels = scale, output, max_levels

    def learn(self, df: DataFrame) -> Prepared:
        expressions, known = self._numeric(df), {}
        for c in self.cat:
            levels = levels_of(df, c, self.max_levels)
            if not levels:
                expressions[c] = "-1.0D"
                continue
            top = modes(df.select(F.col(c).cast("string").alias(c)), [c]).first()
            expressions[c] = f"coalesce(cast({_quoted(c)} AS string), {_text(top['top'])})"
            known[c] = levels
        for c in self.passthrough:
            expressions[c] = f"cast({_quoted(c)} AS double)"
        return Prepared(expressions, known, self.output)

    def _numeric(self, df):
        if not self.num:
            return {}
        rows = quantiles(df, self.num, [0.5]).collect()
        medians = {r["column"]: r["q"][0] if r["q"] and r["q"][0] is not None else 0.0 for r in rows}
        filled = {c: f"coalesce(cast({_quoted(c)} AS double), {medians[c]!r}D)" for c in self.num}
        if not self.scale:
            return filled
        aggs = []
        for i, c in enumerate(self.num):
            aggs += [F.avg(F.expr(filled[c])).alias(f"m{i}"), F.stddev_pop(F.expr(filled[c])).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        return {
            c: f"(({filled[c]}) - {row[f'm{i}']!r}D) / {(row[f's{i}'] or 1.0)!r}D" for i, c in enumerate(self.num)
        }

    def _fit(self, dataset):
        return self.learn(dataset).model()

    def copy(self, extra=None):
        return TablePreparer(self.num, self.cat, self.passthrough, self.scale, self.output, self.max_levels)
