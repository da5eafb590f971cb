"""Queries over evaluation metrics, with a rule as the predictor."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C, metrics as E
from .registry import query

# The rule: a discount of at least 5 percent predicts a returned line.
RULE = """rule AS (SELECT l_orderkey, l_linestatus, (l_returnflag = 'R')::INT AS y, (l_discount >= 0.05)::INT AS p,
  l_returnflag AS flag, CASE WHEN l_tax < 0.03 THEN 'A' WHEN l_tax < 0.06 THEN 'N' ELSE 'R' END AS guess FROM lineitem)"""


def _rule(t):
    tax = F.col("l_tax")
    return t("lineitem").select(
        "l_orderkey",
        "l_linestatus",
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") >= 0.05).cast("int").alias("p"),
        F.col("l_returnflag").alias("flag"),
        F.when(tax < 0.03, "A").when(tax < 0.06, "N").otherwise("R").alias("guess"),
        "l_discount",
        "l_tax",
    )


@query("accuracy", f"WITH {RULE} SELECT round(avg((y = p)::INT), 6) AS accuracy FROM rule")
def accuracy(t):
    return C.round_cols(E.accuracy(_rule(t), "y", "p"), ["accuracy"], 6)


@query(
    "prf_binary",
    f"""WITH {RULE}, s AS (SELECT sum(y * p) AS tp, sum(p) AS pp, sum(y) AS ap FROM rule)
        SELECT round(tp / pp, 6) AS precision, round(tp / ap, 6) AS recall, round(2 * tp / (pp + ap), 6) AS f1 FROM s""",
)
def prf_binary(t):
    return C.round_cols(E.prf_binary(_rule(t), "y", "p"), ["precision", "recall", "f1"], 6)


_CLASSES = f"""WITH {RULE}, c AS (SELECT class, (SELECT count(*) FROM rule WHERE flag = class AND guess = class) AS tp,
    (SELECT count(*) FROM rule WHERE guess = class) AS pp, (SELECT count(*) FROM rule WHERE flag = class) AS ap
    FROM (VALUES ('A'), ('N'), ('R')) v(class)),
  s AS (SELECT class, tp / pp AS precision, tp / ap AS recall, 2 * tp / (pp + ap) AS f1, ap AS support FROM c)"""


@query(
    "prf_weighted",
    f"""{_CLASSES} SELECT round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / sum(support), 6) AS recall,
        round(sum(f1 * support) / sum(support), 6) AS f1 FROM s""",
)
def prf_weighted(t):
    return C.round_cols(E.prf_weighted(_rule(t), "flag", "guess"), ["precision", "recall", "f1"], 6)


@query(
    "classification_report",
    f"""{_CLASSES} SELECT class AS name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM s
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
          round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM s""",
)
def classification_report(t):
    return C.round_cols(E.report(_rule(t), "flag", "guess"), ["precision", "recall", "f1"], 6)


@query(
    "confusion_matrix",
    f"""WITH {RULE} SELECT flag AS actual, count(*) FILTER (WHERE guess = 'A') AS "A", count(*) FILTER (WHERE guess = 'N') AS "N",
        count(*) FILTER (WHERE guess = 'R') AS "R" FROM rule GROUP BY flag""",
)
def confusion_matrix(t):
    return E.confusion(_rule(t), "flag", "guess")


# Made scores per class: the discount for returned, the tax for accepted, their difference for new lines.
_SCORES = {"R": "l_discount", "A": "l_tax", "N": "l_extendedprice"}


def _auc_sql() -> str:
    parts = []
    for c, s in _SCORES.items():
        parts.append(
            f"""SELECT '{c}' AS class, (sum(rk) FILTER (WHERE y) - count(*) FILTER (WHERE y) * (count(*) FILTER (WHERE y) + 1) / 2)
                / (count(*) FILTER (WHERE y)::DOUBLE * count(*) FILTER (WHERE NOT y)) AS auc, count(*) FILTER (WHERE y) AS support
                FROM (SELECT l_returnflag = '{c}' AS y, rank() OVER (ORDER BY {s}) + (count(*) OVER (PARTITION BY {s}) - 1) / 2 AS rk FROM lineitem)"""
        )
    return " UNION ALL ".join(parts)


@query("auc_by_class", f"SELECT class, round(auc, 8) AS auc, support FROM ({_auc_sql()})")
def auc_by_class(t):
    scores = {c: F.col(s) for c, s in _SCORES.items()}
    return C.round_cols(E.auc_by_class(t("lineitem"), "l_returnflag", scores), ["auc"], 8)


@query(
    "auc_ovr",
    f"SELECT round(avg(auc), 8) AS macro, round(sum(auc * support) / sum(support), 8) AS weighted FROM ({_auc_sql()})",
)
def auc_ovr(t):
    scores = {c: F.col(s) for c, s in _SCORES.items()}
    return C.round_cols(E.auc_ovr(t("lineitem"), "l_returnflag", scores), ["macro", "weighted"], 8)


# A price estimate from the quantity alone.
_PRICED = """priced AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus, l_extendedprice AS y, 2500 * l_quantity AS p FROM lineitem)"""


def _priced(t):
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus",
        F.col("l_extendedprice").alias("y"), (F.lit(2500) * F.col("l_quantity")).alias("p"),
    )


@query(
    "regression_metrics",
    f"""WITH {_PRICED} SELECT round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS r2, round(avg(abs(y - p)), 4) AS mae,
        round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM priced""",
)
def regression_metrics(t):
    df = E.regression_metrics(_priced(t), "y", "p")
    return C.round_cols(C.round_cols(df, ["r2"], 6), ["mae", "rmse"], 4)


@query(
    "split_metrics",
    f"""WITH {RULE}, k AS (SELECT DISTINCT l_linestatus AS part FROM rule), c AS (
      SELECT part, class, (SELECT count(*) FROM rule WHERE l_linestatus = part AND y = class AND p = class) AS tp,
        (SELECT count(*) FROM rule WHERE l_linestatus = part AND p = class) AS pp,
        (SELECT count(*) FROM rule WHERE l_linestatus = part AND y = class) AS ap FROM k, (VALUES (0), (1)) v(class)),
      s AS (SELECT part, tp / pp AS precision, tp / ap AS recall, 2 * tp / (pp + ap) AS f1, ap AS support FROM c)
      SELECT part, round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / sum(support), 6) AS recall,
        round(sum(f1 * support) / sum(support), 6) AS f1,
        round((SELECT avg((y = p)::INT) FROM rule WHERE l_linestatus = part), 6) AS accuracy FROM s GROUP BY part""",
)
def split_metrics(t):
    df = E.split_metrics(_rule(t).withColumnRenamed("l_linestatus", "part"), "y", "p")
    return C.round_cols(df, ["precision", "recall", "f1", "accuracy"], 6)


@query(
    "real_vs_predicted",
    f"""WITH {_PRICED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y AS real, p AS predicted,
        (SELECT least(min(y), min(p)) FROM priced) AS low, (SELECT greatest(max(y), max(p)) FROM priced) AS high FROM priced""",
)
def real_vs_predicted(t):
    return E.real_vs_pred(_priced(t), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "y", "p")


@query(
    "metric_pivot",
    f"""WITH {RULE} SELECT 'discount rule' AS model, round(avg((y = p)::INT) FILTER (WHERE l_linestatus = 'F'), 6) AS "F",
          round(avg((y = p)::INT) FILTER (WHERE l_linestatus = 'O'), 6) AS "O" FROM rule
        UNION ALL SELECT 'tax rule', round(avg((flag = guess)::INT) FILTER (WHERE l_linestatus = 'F'), 6),
          round(avg((flag = guess)::INT) FILTER (WHERE l_linestatus = 'O'), 6) FROM rule""",
)
def metric_pivot(t):
    df, long = _rule(t), None
    for model, y, p in [("discount rule", "y", "p"), ("tax rule", "flag", "guess")]:
        wide = E.accuracy(df, y, p, ["l_linestatus"]).select(
            F.lit(model).alias("model"), F.col("l_linestatus").alias("dataset"), F.lit("accuracy").alias("metric"),
            F.col("accuracy").alias("value"),
        )
        long = wide if long is None else long.unionByName(wide)
    return C.round_cols(E.metric_pivot(long, "accuracy", ["F", "O"]), ["F", "O"], 6)


@query(
    "adjusted_rand",
    f"""WITH {RULE}, ct AS (SELECT flag, guess, count(*) AS n FROM rule GROUP BY 1, 2),
        s AS (SELECT (SELECT sum(n::DOUBLE * (n - 1) / 2) FROM ct) AS c,
                     (SELECT sum(n::DOUBLE * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM ct GROUP BY flag)) AS a,
                     (SELECT sum(n::DOUBLE * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM ct GROUP BY guess)) AS b,
                     (SELECT sum(n)::DOUBLE * (sum(n) - 1) / 2 FROM ct) AS t)
        SELECT round((c - a * b / t) / ((a + b) / 2 - a * b / t), 9) AS ari FROM s""",
)
def adjusted_rand(t):
    return C.round_cols(E.ari(_rule(t), "flag", "guess"), ["ari"], 9)
