"""Queries over descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C, describe as D
from .cleaning import HOLED_ORDERS, holed_orders
from .registry import query

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _per_measure(select: str, table: str = "lineitem", cols=_MEASURES) -> str:
    """One SELECT per column: ``{c}`` is the column."""
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", {select.replace('{c}', c)} FROM {table}""" for c in cols)


@query("shape", "SELECT count(*) AS rows, 11::BIGINT AS columns, count(*) * 11 AS cells FROM lineitem")
def shape(t):
    return D.shape(t("lineitem"))


@query(
    "schema_report",
    """SELECT 'c_custkey' AS "column", 'bigint' AS type, min(c_custkey)::VARCHAR AS example FROM customer
       UNION ALL SELECT 'c_name', 'string', min(c_name) FROM customer
       UNION ALL SELECT 'c_nationkey', 'int', min(c_nationkey)::VARCHAR FROM customer
       UNION ALL SELECT 'c_acctbal', 'double', min(c_acctbal)::VARCHAR FROM customer
       UNION ALL SELECT 'c_mktsegment', 'string', min(c_mktsegment) FROM customer""",
)
def schema_report(t):
    return D.schema_report(t("customer"))


_DESCRIBE = """count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min,
  round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
  round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max"""


@query("describe_numeric", _per_measure(_DESCRIBE))
def describe_numeric(t):
    return C.round_cols(D.describe(t("lineitem"), _MEASURES), ["mean", "std", "q25", "q50", "q75"], 4)


_TOP = """(SELECT {c} FROM holed WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""


@query(
    "describe_all",
    f"""WITH {HOLED_ORDERS}
    SELECT *, NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq FROM (
      {_per_measure(_DESCRIBE, 'holed', ['o_totalprice'])})
    UNION ALL SELECT 'o_orderstatus', count(o_orderstatus), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
      count(DISTINCT o_orderstatus), {_TOP.replace('{c}', 'o_orderstatus')},
      (SELECT count(*) FROM holed WHERE o_orderstatus = {_TOP.replace('{c}', 'o_orderstatus')}) FROM holed
    UNION ALL SELECT 'o_orderpriority', count(o_orderpriority), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
      count(DISTINCT o_orderpriority), {_TOP.replace('{c}', 'o_orderpriority')},
      (SELECT count(*) FROM holed WHERE o_orderpriority = {_TOP.replace('{c}', 'o_orderpriority')}) FROM holed""",
)
def describe_all(t):
    df = D.describe_all(holed_orders(t), ["o_totalprice", "o_orderstatus", "o_orderpriority"])
    return C.round_cols(df, ["mean", "std", "q25", "q50", "q75"], 4)


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "central",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, {_mode_sql(c)} AS mode FROM lineitem"""
        for c in _MEASURES
    ),
)
def central(t):
    return C.round_cols(D.central(t("lineitem"), _MEASURES), ["mean", "median"], 4)


@query(
    "dispersion",
    _per_measure("round(stddev_samp({c}), 4) AS std, round(var_samp({c}), 3) AS variance, min({c}) AS min, max({c}) AS max"),
)
def dispersion(t):
    return C.round_cols(C.round_cols(D.dispersion(t("lineitem"), _MEASURES), ["std"], 4), ["variance"], 3)


@query(
    "quantiles",
    _per_measure(
        """round(quantile_cont({c}, 0.1), 4) AS p10, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
           round(quantile_cont({c}, 0.7), 4) AS p70, round(quantile_cont({c}, 0.75), 4) AS p75, round(quantile_cont({c}, 0.9), 4) AS p90"""
    ),
)
def quantile_table(t):
    probs = [10, 25, 50, 70, 75, 90]
    q = D.quantiles(t("lineitem"), _MEASURES, [p / 100 for p in probs])
    return q.select("column", *[F.round(F.col("q")[i], 4).alias(f"p{p}") for i, p in enumerate(probs)])


@query(
    "nunique",
    _per_measure("count(DISTINCT {c}) AS \"distinct\"", "lineitem", ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]),
)
def nunique(t):
    return D.nunique(t("lineitem"), ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"])


@query("unique", "SELECT DISTINCT p_brand FROM part")
def unique(t):
    return D.unique(t("part"), "p_brand")


@query(
    "value_counts",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE l_returnflag END AS value, count(*) AS "count"
       FROM lineitem GROUP BY l_returnflag""",
)
def value_counts(t):
    return D.value_counts(t("lineitem"), "l_returnflag", {"A": "accepted", "R": "returned"})


@query(
    "group_stats",
    """SELECT l_returnflag, l_linestatus, sum((l_discount >= 0.05)::INT)::BIGINT AS discounted, count(*) AS total,
              round(avg(l_quantity), 4) AS mean_quantity, round(avg(l_extendedprice), 4) AS mean_price,
              round(sum((l_discount >= 0.05)::INT) / count(*), 6) AS discount_rate
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def group_stats(t):
    return D.group_stats(
        t("lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "discounted": F.sum((F.col("l_discount") >= 0.05).cast("int")),
            "total": F.count(F.lit(1)),
            "mean_quantity": F.round(F.avg("l_quantity"), 4),
            "mean_price": F.round(F.avg("l_extendedprice"), 4),
        },
        {"discount_rate": F.round(F.col("discounted") / F.col("total"), 6)},
    )


@query(
    "group_rate",
    """SELECT o_orderpriority, sum((o_orderstatus = 'F')::INT)::BIGINT AS hits, count(*) AS "count",
              round(avg((o_orderstatus = 'F')::INT), 6) AS rate FROM orders GROUP BY o_orderpriority""",
)
def group_rate(t):
    return C.round_cols(D.group_rate(t("orders"), ["o_orderpriority"], F.col("o_orderstatus") == "F"), ["rate"], 6)


@query(
    "group_mean",
    """SELECT c_mktsegment, round(avg(c_acctbal) / 1000, 6) AS mean, round((SELECT avg(c_acctbal) FROM customer) / 1000, 6) AS global_mean
       FROM customer GROUP BY c_mktsegment""",
)
def group_mean(t):
    return C.round_cols(D.group_mean(t("customer"), ["c_mktsegment"], "c_acctbal", 1000.0), ["mean", "global_mean"], 6)


@query(
    "group_share",
    """SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total, round(sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders), 8) AS share
       FROM orders GROUP BY o_orderpriority""",
)
def group_share(t):
    df = D.group_share(t("orders"), ["o_orderpriority"], "o_totalprice")
    return df.withColumns({"total": F.round("total", 2), "share": F.round("share", 8)})


@query(
    "pivot_mean",
    """SELECT l_returnflag, round(avg(l_extendedprice) FILTER (WHERE l_linestatus = 'F'), 4) AS "F",
              round(avg(l_extendedprice) FILTER (WHERE l_linestatus = 'O'), 4) AS "O" FROM lineitem GROUP BY l_returnflag""",
)
def pivot_mean(t):
    df = D.pivot_mean(t("lineitem"), ["l_returnflag"], "l_linestatus", "l_extendedprice", ["F", "O"])
    return C.round_cols(df, ["F", "O"], 4)


def _corr(a: str, b: str) -> str:
    return "1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)"


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS "column", {', '.join(f'{_corr(a, b)} AS {b}' for b in _MEASURES)} FROM lineitem""" for a in _MEASURES
    ),
)
def corr_matrix(t):
    return C.round_cols(D.corr_matrix(t("lineitem"), _MEASURES), _MEASURES, 6)


@query(
    "corr_target",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(corr({c}, l_extendedprice), 6) AS r FROM lineitem""" for c in ["l_quantity", "l_discount", "l_tax"]
    ),
)
def corr_target(t):
    return C.round_cols(D.corr_target(t("lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"), ["r"], 6)


@query(
    "corr_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for i, a in enumerate(_MEASURES)
        for b in _MEASURES[i + 1 :]
    ),
)
def corr_pairs(t):
    return C.round_cols(D.corr_pairs(t("lineitem"), _MEASURES), ["r"], 6)


def _histogram_sql(table: str, col: str, bins: int) -> str:
    return f"""WITH s AS (SELECT min({col}) AS lo, (max({col}) - min({col})) / {bins} AS w FROM {table}),
      b AS (SELECT least(floor(({col} - lo) / w), {bins - 1})::INT AS bin FROM {table}, s),
      c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
      SELECT i.range::INT AS bin, round(lo + i.range * w, 4) AS low, round(lo + (i.range + 1) * w, 4) AS high, coalesce(n, 0) AS n
      FROM range({bins}) i CROSS JOIN s LEFT JOIN c ON c.bin = i.range"""


@query("histogram", _histogram_sql("orders", "o_totalprice", 20))
def histogram(t):
    return C.round_cols(D.histogram(t("orders"), "o_totalprice", 20), ["low", "high"], 4)


@query("histogram_lines", "SELECT round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median FROM orders")
def histogram_lines(t):
    return C.round_cols(D.histogram_lines(t("orders"), "o_totalprice"), ["mean", "median"], 4)


@query(
    "box_stats",
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                         quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag),
       j AS (SELECT l.l_returnflag, q1, median, q3, l_extendedprice AS x,
                    l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
             FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag)
       SELECT l_returnflag, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3, count(*) AS n,
              min(x) FILTER (WHERE inside) AS whisker_low, max(x) FILTER (WHERE inside) AS whisker_high,
              count(*) FILTER (WHERE NOT inside) AS outliers
       FROM j GROUP BY l_returnflag""",
)
def box_stats(t):
    return C.round_cols(D.box_stats(t("lineitem"), ["l_returnflag"], "l_extendedprice"), ["q1", "median", "q3"], 4)


_PROFILE = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "group_profile",
    f"""WITH m AS (SELECT l_suppkey, {', '.join(f'avg({c}) AS {c}' for c in _PROFILE)} FROM lineitem GROUP BY l_suppkey)
       SELECT l_suppkey, {', '.join(f'round(({c} - (SELECT min({c}) FROM m)) / ((SELECT max({c}) FROM m) - (SELECT min({c}) FROM m)), 6) AS {c}' for c in _PROFILE)}
       FROM m""",
)
def group_profile(t):
    return C.round_cols(D.group_profile(t("lineitem"), ["l_suppkey"], _PROFILE), _PROFILE, 6)


@query(
    "series",
    """SELECT event_type, date_part('day', ts)::INT AS period, round(sum(value), 2) AS value FROM events GROUP BY 1, 2""",
)
def series(t):
    return C.round_cols(D.series(t("events"), ["event_type"], F.dayofmonth("ts"), "value"), ["value"], 2)


# The quantile cuts and names of the three risk classes.
RISK_CUTS, RISK_NAMES = [0.33, 0.66], ["Bajo", "Medio", "Alto"]


@query(
    "quantile_class",
    """SELECT o_orderkey, CASE WHEN o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.33) FROM orders) THEN 'Bajo'
              WHEN o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.66) FROM orders) THEN 'Medio' ELSE 'Alto' END AS risk FROM orders""",
)
def quantile_class(t):
    df = D.quantile_class(t("orders"), "o_totalprice", RISK_CUTS, RISK_NAMES, "risk")
    return df.select("o_orderkey", "risk")


@query(
    "median_label",
    "SELECT o_orderkey, (o_totalprice > (SELECT median(o_totalprice) FROM orders))::INT AS high FROM orders",
)
def median_label(t):
    return D.median_label(t("orders"), "o_totalprice", "high").select("o_orderkey", "high")


@query(
    "percentile_curve",
    "SELECT i.range::INT AS step, round((SELECT quantile_cont(o_totalprice, list_value("
    + ", ".join(f"{i / 100}" for i in range(101))
    + ")) FROM orders)[i.range + 1], 4) AS value FROM range(101) i",
)
def percentile_curve(t):
    return C.round_cols(D.percentile_curve(t("orders"), "o_totalprice", 100), ["value"], 4)


@query(
    "scatter_sample",
    """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders ORDER BY md5(o_orderkey::VARCHAR || '|42'), o_orderkey LIMIT 100""",
)
def scatter_sample(t):
    return D.scatter_sample(t("orders"), ["o_totalprice", "o_orderstatus"], 100, "o_orderkey")


_SUPP = ["s_suppkey", "s_nationkey", "s_acctbal"]
_SUPP_ALL = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]


def _profile_sql() -> str:
    rows = ["""SELECT 'shape' AS section, '*' AS "column", 'rows' AS measure, count(*)::DOUBLE AS value FROM supplier"""]
    for name, value in [("columns", "max(4)"), ("cells", "count(*) * 4"), ("numeric", "max(3)"), ("categorical", "max(1)")]:
        rows.append(f"SELECT 'shape', '*', '{name}', ({value})::DOUBLE FROM supplier")
    for c in _SUPP_ALL:
        rows.append(f"SELECT 'missing', '{c}', 'missing', (count(*) - count({c}))::DOUBLE FROM supplier")
        rows.append(f"SELECT 'missing', '{c}', 'percent', (100.0 * (count(*) - count({c})) / count(*))::DOUBLE FROM supplier")
        rows.append(f"SELECT 'distinct', '{c}', 'distinct', count(DISTINCT {c})::DOUBLE FROM supplier")
    for c in _SUPP:
        for name, e in [
            ("mean", f"avg({c})"),
            ("std", f"stddev_samp({c})"),
            ("min", f"min({c})"),
            ("q25", f"quantile_cont({c}, 0.25)"),
            ("q50", f"quantile_cont({c}, 0.5)"),
            ("q75", f"quantile_cont({c}, 0.75)"),
            ("max", f"max({c})"),
        ]:
            rows.append(f"SELECT 'numeric', '{c}', '{name}', ({e})::DOUBLE FROM supplier")
    for i, a in enumerate(_SUPP):
        for b in _SUPP[i + 1 :]:
            rows.append(f"SELECT 'correlation', '{a}~{b}', 'r', corr({a}, {b}) FROM supplier")
    out = []
    for c in _SUPP:
        q = f"(SELECT quantile_cont({c}, %s) FROM supplier)"
        q1, q3 = q % 0.25, q % 0.75
        out.append(f"""SELECT '{c}' AS c, count(*) FILTER (WHERE {c} < {q1} - 1.5 * ({q3} - {q1}) OR {c} > {q3} + 1.5 * ({q3} - {q1})) AS n FROM supplier""")
    counted = " UNION ALL ".join(out)
    rows.append(f"SELECT 'outliers', c, 'outliers', n::DOUBLE FROM ({counted})")
    rows.append(f"SELECT 'outliers', 'total', 'outliers', sum(n)::DOUBLE FROM ({counted})")
    return f"""SELECT section, "column", measure, round(value, 4) AS value FROM ({' UNION ALL '.join(rows)})"""


@query("profile", _profile_sql())
def profile(t):
    return C.round_cols(D.profile(t("supplier")), ["value"], 4)
