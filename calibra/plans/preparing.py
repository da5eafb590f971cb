"""Queries over encodings, scalers, polynomial terms, components, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C, features as X, splits as S
from .cleaning import HOLED_ORDERS, holed_orders
from .registry import query

_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_KEYS = ", ".join(_KEY)
_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _status_levels(rows: str) -> str:
    return f"SELECT v AS level, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT v FROM ({rows}))"


@query(
    "one_hot",
    f"""WITH {HOLED_ORDERS} SELECT o_orderkey,
        coalesce(o_orderstatus = 'F', false)::INT AS "o_orderstatus_F", coalesce(o_orderstatus = 'O', false)::INT AS "o_orderstatus_O",
        coalesce(o_orderstatus = 'P', false)::INT AS "o_orderstatus_P" FROM holed""",
)
def one_hot(t):
    return X.one_hot(holed_orders(t).select("o_orderkey", "o_orderstatus"), ["o_orderstatus"])


@query(
    "one_hot_drop_first",
    "SELECT o_orderkey, "
    + ", ".join(f"""(o_orderpriority = '{p}')::INT AS "o_orderpriority_{p}" """ for p in _PRIORITIES[1:])
    + " FROM orders",
)
def one_hot_drop_first(t):
    return X.one_hot(t("orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"], drop_first=True)


@query(
    "label_encode",
    f"""WITH {HOLED_ORDERS}, lv AS ({_status_levels("SELECT coalesce(o_orderstatus, 'nan') AS v FROM holed")})
        SELECT o_orderkey, code AS o_orderstatus FROM holed JOIN lv ON coalesce(o_orderstatus, 'nan') = level""",
)
def label_encode(t):
    return X.label_encode(holed_orders(t).select("o_orderkey", "o_orderstatus"), ["o_orderstatus"])


@query(
    "label_encode_many",
    f"""WITH lv AS ({_status_levels("SELECT c_name AS v FROM customer")})
        SELECT c_custkey, code AS c_name FROM customer JOIN lv ON c_name = level""",
)
def label_encode_many(t):
    return X.label_encode(t("customer").select("c_custkey", "c_name"), ["c_name"])


@query(
    "ordinal_encode",
    f"""WITH lv AS ({_status_levels("SELECT c_mktsegment AS v FROM customer WHERE c_acctbal < 0 AND c_mktsegment <> 'MACHINERY'")})
        SELECT c_custkey, coalesce(code, -1) AS c_mktsegment FROM customer LEFT JOIN lv ON c_mktsegment = level""",
)
def ordinal_encode(t):
    customers = t("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    seen = customers.where("c_acctbal < 0 and c_mktsegment <> 'MACHINERY'")
    fitted = X.ordinal_fit(seen, ["c_mktsegment"])
    return X.ordinal_transform(customers.select("c_custkey", "c_mktsegment"), fitted)


@query(
    "binary_encode",
    f"""WITH lv AS ({_status_levels("SELECT o_orderpriority AS v FROM orders")})
        SELECT o_orderkey, (((code + 1) >> 2) & 1)::INT AS o_orderpriority_0, (((code + 1) >> 1) & 1)::INT AS o_orderpriority_1,
               ((code + 1) & 1)::INT AS o_orderpriority_2 FROM orders JOIN lv ON o_orderpriority = level""",
)
def binary_encode(t):
    return X.binary_encode(t("orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])


@query(
    "minmax",
    f"""SELECT {_KEYS}, {', '.join(f'round(({c} - (SELECT min({c}) FROM lineitem)) / ((SELECT max({c}) FROM lineitem) - (SELECT min({c}) FROM lineitem)), 9) AS {c}' for c in ['l_quantity', 'l_extendedprice'])},
        0.0::DOUBLE AS fixed FROM lineitem""",
)
def minmax(t):
    cols = ["l_quantity", "l_extendedprice", "fixed"]
    df = X.minmax(t("lineitem").select(*_KEY, "l_quantity", "l_extendedprice", F.lit(3.0).alias("fixed")), cols)
    return C.round_cols(df, cols, 9)


@query(
    "standardize",
    f"""SELECT {_KEYS}, {', '.join(f'round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 6) AS {c}' for c in _MEASURES)}
        FROM lineitem""",
)
def standardize(t):
    return C.round_cols(X.standardize(t("lineitem").select(*_KEY, *_MEASURES), _MEASURES), _MEASURES, 6)


@query(
    "log_positive",
    f"SELECT {_KEYS}, round(ln(l_quantity), 9) AS l_quantity, round(ln(l_extendedprice), 9) AS l_extendedprice, l_tax FROM lineitem",
)
def log_positive(t):
    df = X.log_positive(t("lineitem").select(*_KEY, "l_quantity", "l_extendedprice", "l_tax"), ["l_quantity", "l_extendedprice", "l_tax"])
    return C.round_cols(df, ["l_quantity", "l_extendedprice"], 9)


@query(
    "polynomial",
    f"""SELECT {_KEYS}, l_quantity, l_discount, l_tax, l_quantity * l_quantity AS "l_quantity^2", l_quantity * l_discount AS "l_quantity l_discount",
        l_quantity * l_tax AS "l_quantity l_tax", l_discount * l_discount AS "l_discount^2", l_discount * l_tax AS "l_discount l_tax",
        l_tax * l_tax AS "l_tax^2" FROM lineitem""",
)
def polynomial(t):
    return X.poly(t("lineitem").select(*_KEY, "l_quantity", "l_discount", "l_tax"), ["l_quantity", "l_discount", "l_tax"], 2)


@query(
    "prepare_mixed",
    f"""WITH {HOLED_ORDERS}, med AS (SELECT median(o_totalprice) AS m FROM holed),
        filled AS (SELECT o_orderkey, coalesce(o_totalprice, m) AS x, o_custkey::DOUBLE AS c,
          coalesce(o_orderstatus, (SELECT o_orderstatus FROM holed WHERE o_orderstatus IS NOT NULL
                                   GROUP BY 1 ORDER BY count(*) DESC, o_orderstatus LIMIT 1)) AS s FROM holed, med)
        SELECT o_orderkey, round((x - (SELECT avg(x) FROM filled)) / (SELECT stddev_pop(x) FROM filled), 6) AS f0,
               round((c - (SELECT avg(c) FROM filled)) / (SELECT stddev_pop(c) FROM filled), 6) AS f1,
               CASE s WHEN 'F' THEN 0.0 WHEN 'O' THEN 1.0 ELSE 2.0 END::DOUBLE AS f2 FROM filled""",
)
def prepare_mixed(t):
    df = holed_orders(t)
    return _vector_columns(X.TablePreparer(num=["o_totalprice", "o_custkey"], cat=["o_orderstatus"]), df, "o_orderkey", 3)


@query(
    "prepare_passthrough",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
         WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END::DOUBLE AS f0, c_acctbal AS f1, c_nationkey::DOUBLE AS f2 FROM customer""",
)
def prepare_passthrough(t):
    prep = X.TablePreparer(cat=["c_mktsegment"], passthrough=["c_acctbal", "c_nationkey"])
    return _vector_columns(prep, t("customer"), "c_custkey", 3)


def _vector_columns(prep, df, key, size):
    from pyspark.ml.functions import vector_to_array

    out = prep.fit(df).transform(df).withColumn("__a", vector_to_array("features"))
    return out.select(key, *[F.round(F.col("__a")[i], 6).alias(f"f{i}") for i in range(size)])


# With two standardised variables the components are their sum and difference.
_TWO = """WITH z AS (SELECT o_orderkey, o_totalprice AS a, o_custkey + o_totalprice / 200 AS b FROM orders),
  m AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb, corr(a, b) AS r FROM z)"""


def _two(t):
    price = F.col("o_totalprice")
    return t("orders").select("o_orderkey", price.alias("a"), (F.col("o_custkey") + price / 200).alias("b"))


@query(
    "pca",
    f"""{_TWO} SELECT o_orderkey, round(((a - ma) / sa + (b - mb) / sb) / sqrt(2), 6) AS pc1,
        round(((a - ma) / sa - (b - mb) / sb) / sqrt(2), 6) AS pc2 FROM z, m""",
)
def pca(t):
    return C.round_cols(X.pca(_two(t), ["a", "b"], 2).select("o_orderkey", "pc1", "pc2"), ["pc1", "pc2"], 6)


@query(
    "pca_variance",
    f"""{_TWO} SELECT 1 AS component, round((1 + abs(r)) / 2, 8) AS share, round((1 + abs(r)) / 2, 8) AS cumulative FROM m
        UNION ALL SELECT 2, round((1 - abs(r)) / 2, 8), 1.0::DOUBLE FROM m""",
)
def pca_variance(t):
    return C.round_cols(X.pca_variance(_two(t), ["a", "b"]), ["share", "cumulative"], 8)


@query(
    "with_result",
    """SELECT o_orderkey, o_totalprice, (o_totalprice > (SELECT median(o_totalprice) FROM orders))::INT AS high,
              (o_orderstatus = 'F')::INT AS finished FROM orders""",
)
def with_result(t):
    from ..operators.describe import median_label

    orders = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    high = median_label(orders, "o_totalprice", "high").select("o_orderkey", "high")
    finished = orders.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("finished"))
    return X.with_result(orders.drop("o_orderstatus"), ["o_orderkey"], high, finished)


# --- splits and folds -------------------------------------------------------------------

_TICKET = "md5(o_orderkey::VARCHAR || '|42')"


@query(
    "split_random",
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {_TICKET}) <= ceil((SELECT count(*) FROM orders) * 0.2)
        THEN 'test' ELSE 'train' END AS part FROM orders""",
)
def split_random(t):
    return S.split(t("orders").select("o_orderkey"), "o_orderkey", 0.2, 42)


@query(
    "split_stratified",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_TICKET})
        <= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.25 + 0.5) THEN 'test' ELSE 'train' END AS part FROM orders""",
)
def split_stratified(t):
    return S.split(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 0.25, 42, stratify="o_orderstatus")


@query("folds", f"SELECT o_orderkey, (ntile(4) OVER (ORDER BY {_TICKET}) - 1)::INT AS fold FROM orders")
def folds(t):
    return S.folds(t("orders").select("o_orderkey"), "o_orderkey", 4, 42)


@query(
    "folds_stratified",
    f"SELECT o_orderkey, o_orderstatus, (ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY {_TICKET}) - 1)::INT AS fold FROM orders",
)
def folds_stratified(t):
    return S.folds(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 5, 42, stratify="o_orderstatus")
