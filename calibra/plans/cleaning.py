"""Queries over column operators, missing values, duplicates, rules and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C, describe as D, fills, outliers, quality
from ..sources.tables import load_parquet
from .registry import Tables, query

# The tables have no missing values; these holes are written alike here and in the SQL.
HOLED_ORDERS = """holed AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus
  FROM orders)"""


def holed_orders(t: Tables):
    return t("orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
    )


HOLED_EVENTS = """holed AS (
  SELECT event_id, user_id, ts, CASE WHEN event_id % 5 IN (1, 2) THEN NULL ELSE value END AS value
  FROM events)"""


def holed_events(t: Tables):
    return t("events").select(
        "event_id", "user_id", "ts", F.when(~(F.col("event_id") % 5).isin(1, 2), F.col("value")).alias("value")
    )


# --- sources, projection, filters -------------------------------------------------------


@query("load_parquet", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def load(t):
    return load_parquet(t.spark, t.directory, "customer")


@query("clean_names", "SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier")
def clean_names(t):
    return C.clean_names(t("supplier"), [(r"^[a-z]+_", ""), (r"[^0-9A-Za-z_]+", "_")])


@query("head", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5")
def head(t):
    return C.head(t("orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), 5, ["o_totalprice", "o_orderkey"])


@query("tail", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5")
def tail(t):
    return C.tail(t("orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), 5, ["o_totalprice", "o_orderkey"])


@query("reorder", "SELECT o_orderpriority, o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def reorder(t):
    return C.reorder(t("orders").drop("o_orderdate"), first=["o_orderpriority"], last=["o_totalprice", "o_orderstatus"])


@query("drop_cols", "SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part")
def drop_cols(t):
    return C.drop_cols(t("part"), ["p_name", "no_such_column"])


@query("rename", "SELECT n_nationkey AS nation_id, n_name AS nation_name, n_regionkey FROM nation")
def rename(t):
    return C.rename(t("nation"), {"n_nationkey": "nation_id", "n_name": "nation_name"})


@query(
    "select_by_type",
    """SELECT 'numeric' AS kind, p_brand AS brand, sum(p_size)::BIGINT AS s1, count(p_partkey) AS s2 FROM part GROUP BY p_brand""",
)
def select_by_type(t):
    part = t("part")
    numeric = C.numeric_cols(part)
    by = C.categorical_cols(part)[1]
    assert numeric == ["p_partkey", "p_size", "p_retailprice"]
    return part.groupBy(F.col(by).alias("brand")).agg(
        F.lit("numeric").alias("kind"), F.sum(numeric[1]).alias("s1"), F.count(numeric[0]).alias("s2")
    )


@query(
    "derive",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         round(CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END, 6) AS tax_ratio,
         l_quantity * l_extendedprice AS volume,
         (l_extendedprice - l_extendedprice * l_discount) / 1e9 AS margin
       FROM lineitem""",
)
def derive(t):
    li = t("lineitem")
    out = C.derive(
        li,
        {
            "tax_ratio": F.round(C.ratio("l_tax", "l_discount"), 6),
            "volume": F.col("l_quantity") * F.col("l_extendedprice"),
            "margin": (F.col("l_extendedprice") - F.col("l_extendedprice") * F.col("l_discount")) / 1e9,
        },
    )
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "tax_ratio", "volume", "margin")


@query("filter_compare", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000")
def filter_compare(t):
    return t("orders").where(F.col("o_totalprice") > 200000).select("o_orderkey", "o_totalprice")


@query("filter_between", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")
def filter_between(t):
    return C.between(t("lineitem"), "l_quantity", 10, 20).select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")


@query("filter_isin", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_isin(t):
    return C.isin(t("customer"), "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey", "c_mktsegment")


@query("filter_equal_project", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_equal_project(t):
    return t("orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey")


@query(
    "drop_keys",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def drop_keys(t):
    overdrawn = t("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return C.drop_keys(t("orders"), overdrawn, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("cast_int", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity FROM lineitem")
def cast_int(t):
    return C.cast_cols(t("lineitem"), {"l_quantity": "int"}).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query(
    "to_numeric",
    """SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment
                                       ELSE ' ' || CAST(c_nationkey AS VARCHAR) || '.5 ' END AS DOUBLE) AS code
       FROM customer""",
)
def to_numeric(t):
    text = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise(
        F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(".5 "))
    )
    return C.to_numeric(t("customer").select("c_custkey", text.alias("code")), ["code"])


@query(
    "as_category",
    """WITH levels AS (SELECT o_orderpriority AS level, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
                       FROM (SELECT DISTINCT o_orderpriority FROM orders))
       SELECT level, code, count(*) AS n FROM orders JOIN levels ON o_orderpriority = level GROUP BY level, code""",
)
def as_category(t):
    df = C.as_category(t("orders").select("o_orderpriority"), ["o_orderpriority"])
    names = C.categories(df, "o_orderpriority")
    code = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("o_orderpriority")) - 1
    return df.groupBy(F.col("o_orderpriority").alias("level"), code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "conditional_value",
    """SELECT l_returnflag, CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 20 THEN 'medium' ELSE 'small' END AS size_class,
              count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def conditional_value(t):
    size = F.when(F.col("l_quantity") >= 40, "large").when(F.col("l_quantity") >= 20, "medium").otherwise("small")
    return t("lineitem").groupBy("l_returnflag", size.alias("size_class")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "map_values",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status,
              CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'O' END AS back FROM orders""",
)
def map_values(t):
    names = {"F": "finished", "O": "open"}
    df = C.map_values(t("orders"), "o_orderstatus", names, "status")
    return C.map_values(df, "status", {v: k for k, v in names.items()}, "back").select("o_orderkey", "status", "back")


@query(
    "clean_text",
    r"""SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS cleaned,
               length(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS n_chars FROM documents""",
)
def clean_text(t):
    df = t("documents").select("doc_id", C.clean_text("text").alias("text"))
    return df.select("doc_id", F.md5(F.col("text").cast("binary")).alias("cleaned"), F.length("text").cast("bigint").alias("n_chars"))


@query(
    "prefix_class",
    r"""SELECT p_partkey, CASE WHEN regexp_matches(p_name, '^[a-m][a-z]+ ') THEN substr(p_name, 1, 1) ELSE 'X' END AS deck FROM part""",
)
def prefix_class(t):
    return t("part").select("p_partkey", C.prefix_class("p_name", "[a-m][a-z]+ ").alias("deck"))


@query(
    "round_cols",
    "SELECT l_orderkey, l_partkey, l_suppkey, round(sqrt(l_extendedprice), 3) AS root FROM lineitem",
)
def round_cols(t):
    root = F.sqrt("l_extendedprice").alias("root")
    return C.round_cols(t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", root), ["root"], 3)


@query(
    "data_dictionary",
    """SELECT 's_suppkey' AS "column", 'bigint' AS type, 'supplier key' AS comment, count(s_suppkey) AS present FROM supplier
       UNION ALL SELECT 's_name', 'string', 'supplier name', count(s_name) FROM supplier
       UNION ALL SELECT 's_nationkey', 'int', NULL, count(s_nationkey) FROM supplier
       UNION ALL SELECT 's_acctbal', 'double', 'account balance', count(s_acctbal) FROM supplier""",
)
def data_dictionary(t):
    df = C.describe_columns(
        t("supplier"), {"s_suppkey": "supplier key", "s_name": "supplier name", "s_acctbal": "account balance"}
    )
    present = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "present")
    return C.data_dictionary(df).join(present, "column")


@query(
    "drop_constant",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
)
def drop_constant(t):
    df = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(999).alias("fixed"), F.lit(None).cast("int").alias("void"))
    return C.drop_constant(df)


@query("scale_unit", "SELECT o_orderkey, o_totalprice / 1e9 AS o_totalprice FROM orders")
def scale_unit(t):
    return C.scale_unit(t("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 1e9)


# --- missing values ---------------------------------------------------------------------


@query(
    "null_report",
    f"""WITH {HOLED_ORDERS}
    SELECT 'o_totalprice' AS "column", count(*) - count(o_totalprice) AS missing,
           round(100.0 * (count(*) - count(o_totalprice)) / count(*), 4)::DOUBLE AS percent FROM holed
    UNION ALL
    SELECT 'o_orderstatus', count(*) - count(o_orderstatus),
           round(100.0 * (count(*) - count(o_orderstatus)) / count(*), 4)::DOUBLE FROM holed""",
)
def null_report(t):
    return quality.null_report(holed_orders(t)).withColumn("percent", F.round("percent", 4))


@query(
    "null_total",
    f"""WITH {HOLED_ORDERS}
    SELECT (2 * count(*) - count(o_totalprice) - count(o_orderstatus))::BIGINT AS missing, true AS any_missing FROM holed""",
)
def null_total(t):
    return quality.null_total(holed_orders(t))


@query("drop_null_any", f"WITH {HOLED_ORDERS} SELECT * FROM holed WHERE o_totalprice IS NOT NULL AND o_orderstatus IS NOT NULL")
def drop_null_any(t):
    return quality.drop_null(holed_orders(t))


@query(
    "drop_null_all",
    f"""WITH {HOLED_ORDERS} SELECT o_totalprice, o_orderstatus, count(*) AS n FROM holed
        WHERE NOT (o_totalprice IS NULL AND o_orderstatus IS NULL) GROUP BY 1, 2""",
)
def drop_null_all(t):
    df = quality.drop_null(holed_orders(t).select("o_totalprice", "o_orderstatus"), how="all")
    return df.groupBy("o_totalprice", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "drop_null_thresh",
    f"""WITH {HOLED_ORDERS} SELECT * FROM holed
        WHERE (o_totalprice IS NOT NULL)::INT + (o_orderstatus IS NOT NULL)::INT + 3 >= 4""",
)
def drop_null_thresh(t):
    return quality.drop_null(holed_orders(t), thresh=4)


@query("drop_null_cols", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def drop_null_cols(t):
    return quality.drop_null_cols(holed_orders(t))


@query(
    "fill_const",
    f"""WITH {HOLED_ORDERS} SELECT o_orderkey, o_custkey, o_orderpriority, coalesce(o_totalprice, 0) AS o_totalprice,
        coalesce(o_orderstatus, 'unknown') AS o_orderstatus FROM holed""",
)
def fill_const(t):
    return fills.fill_const(holed_orders(t), {"o_totalprice": 0.0, "o_orderstatus": "unknown"})


@query(
    "fill_mean",
    f"""WITH {HOLED_ORDERS} SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM holed)), 4) AS o_totalprice FROM holed""",
)
def fill_mean(t):
    df = fills.fill_stat(holed_orders(t).select("o_orderkey", "o_totalprice"), ["o_totalprice"], "mean")
    return C.round_cols(df, ["o_totalprice"], 4)


@query(
    "fill_median",
    f"""WITH {HOLED_ORDERS} SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT median(o_totalprice) FROM holed)), 4) AS o_totalprice FROM holed""",
)
def fill_median(t):
    df = fills.fill_stat(holed_orders(t).select("o_orderkey", "o_totalprice"), ["o_totalprice"], "median")
    return C.round_cols(df, ["o_totalprice"], 4)


@query(
    "fill_mode",
    f"""WITH {HOLED_ORDERS}, top AS (SELECT o_orderstatus FROM holed WHERE o_orderstatus IS NOT NULL
          GROUP BY o_orderstatus ORDER BY count(*) DESC, o_orderstatus LIMIT 1)
        SELECT o_orderkey, coalesce(o_orderstatus, (SELECT o_orderstatus FROM top)) AS o_orderstatus FROM holed""",
)
def fill_mode(t):
    return fills.fill_stat(holed_orders(t).select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], "mode")


GROUP_HOLES = """holed AS (
  SELECT o_orderkey, o_orderpriority,
         CASE WHEN o_orderkey % 7 = 0 OR o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice
  FROM orders),
med AS (SELECT o_orderpriority, median(o_totalprice) AS m FROM holed GROUP BY o_orderpriority),
grouped AS (SELECT o_orderkey, holed.o_orderpriority, coalesce(o_totalprice, m) AS x
            FROM holed JOIN med ON holed.o_orderpriority = med.o_orderpriority)"""


def _group_holes(t):
    gap = (F.col("o_orderkey") % 7 == 0) | (F.col("o_orderpriority") == "5-LOW")
    return t("orders").select("o_orderkey", "o_orderpriority", F.when(~gap, F.col("o_totalprice")).alias("o_totalprice"))


@query(
    "fill_group_median",
    f"""WITH {GROUP_HOLES} SELECT o_orderkey, o_orderpriority,
        round(coalesce(x, (SELECT median(x) FROM grouped)), 4) AS o_totalprice FROM grouped""",
)
def fill_group_median(t):
    return C.round_cols(fills.fill_group(_group_holes(t), ["o_orderpriority"], ["o_totalprice"]), ["o_totalprice"], 4)


@query(
    "fill_group_median_before",
    f"""WITH {GROUP_HOLES} SELECT o_orderkey, o_orderpriority,
        round(coalesce(x, (SELECT median(o_totalprice) FROM holed)), 4) AS o_totalprice FROM grouped""",
)
def fill_group_median_before(t):
    df = fills.fill_group(_group_holes(t), ["o_orderpriority"], ["o_totalprice"], fallback_after=False)
    return C.round_cols(df, ["o_totalprice"], 4)


_EVENT_ORDER = ["ts", "event_id"]


@query(
    "ffill_by_user",
    f"""WITH {HOLED_EVENTS} SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM holed""",
)
def ffill_by_user(t):
    return fills.ffill(holed_events(t), "value", _EVENT_ORDER, ["user_id"]).drop("ts")


@query(
    "ffill_global",
    f"""WITH {HOLED_EVENTS} SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER (
        ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM holed""",
)
def ffill_global(t):
    return fills.ffill(holed_events(t), "value", _EVENT_ORDER).drop("ts")


@query(
    "bfill_by_user",
    f"""WITH {HOLED_EVENTS} SELECT event_id, user_id, first_value(value IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM holed""",
)
def bfill_by_user(t):
    return fills.bfill(holed_events(t), "value", _EVENT_ORDER, ["user_id"]).drop("ts")


@query(
    "bfill_global",
    f"""WITH {HOLED_EVENTS} SELECT event_id, user_id, first_value(value IGNORE NULLS) OVER (
        ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM holed""",
)
def bfill_global(t):
    return fills.bfill(holed_events(t), "value", _EVENT_ORDER).drop("ts")


def _interpolate_sql(partition: str) -> str:
    over = f"{partition} ORDER BY ts, event_id"
    return f"""WITH {HOLED_EVENTS},
    numbered AS (SELECT *, row_number() OVER ({over}) AS pos FROM holed),
    edged AS (SELECT *,
        last_value(value IGNORE NULLS) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
        last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
        first_value(value IGNORE NULLS) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1,
        first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1
      FROM numbered)
    SELECT event_id, user_id, round(CASE WHEN value IS NOT NULL THEN value
        WHEN v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * ((pos - p0) / (p1 - p0)) ELSE v0 END, 6) AS value
    FROM edged"""


@query("interpolate_by_user", _interpolate_sql("PARTITION BY user_id"))
def interpolate_by_user(t):
    df = fills.interpolate(holed_events(t), "value", _EVENT_ORDER, ["user_id"])
    return C.round_cols(df.drop("ts"), ["value"], 6)


@query("interpolate_global", _interpolate_sql(""))
def interpolate_global(t):
    return C.round_cols(fills.interpolate(holed_events(t), "value", _EVENT_ORDER).drop("ts"), ["value"], 6)


# --- duplicates, rules ------------------------------------------------------------------

_LINE_KEY = ["l_orderkey", "l_linenumber"]


@query(
    "dup_count",
    """SELECT 'key' AS scope, (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT AS duplicates FROM lineitem
       UNION ALL SELECT 'row', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem))""",
)
def dup_count(t):
    li = t("lineitem")
    by_key = quality.dup_count(li, _LINE_KEY).withColumn("scope", F.lit("key"))
    return by_key.unionByName(quality.dup_count(li).withColumn("scope", F.lit("row")))


@query("dedupe_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def dedupe_rows(t):
    return quality.dedupe(t("lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"))


@query(
    "dedupe_by_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                      ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def dedupe_by_key(t):
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    df = quality.dedupe(t("lineitem").select(*_LINE_KEY, *order), _LINE_KEY, order)
    return df.select(*_LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "validate_rules",
    """SELECT 'quantity above 45' AS rule, count(*) FILTER (WHERE l_quantity > 45) AS violations FROM lineitem
       UNION ALL SELECT 'discount outside [0, 0.08]', count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.08) FROM lineitem
       UNION ALL SELECT 'negative price', count(*) FILTER (WHERE l_extendedprice < 0) FROM lineitem""",
)
def validate_rules(t):
    return quality.validate(
        t("lineitem"),
        {
            "quantity above 45": F.col("l_quantity") > 45,
            "discount outside [0, 0.08]": (F.col("l_discount") < 0) | (F.col("l_discount") > 0.08),
            "negative price": F.col("l_extendedprice") < 0,
        },
    )


@query(
    "check_identity",
    """SELECT round(max(abs(p_retailprice - l_extendedprice / l_quantity)), 4) AS max_difference
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def check_identity(t):
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    out = quality.check_identity(joined, "p_retailprice", F.try_divide("l_extendedprice", "l_quantity"))
    return C.round_cols(out, ["max_difference"], 4)


@query(
    "text_audit",
    r"""SELECT raw, cleaned, raw <> cleaned AS changed FROM (
          SELECT DISTINCT raw, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS cleaned FROM (
            SELECT CASE WHEN p_partkey % 2 = 0 THEN '  ' || replace(p_name, ' ', '   ') ELSE p_name END AS raw FROM part))""",
)
def text_audit(t):
    padded = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("   ")))).otherwise(F.col("p_name"))
    return quality.text_audit(t("part").select(padded.alias("raw_name")), "raw_name")


# --- outliers ---------------------------------------------------------------------------

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _fence_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
            FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {table})"""
        for c in cols
    )


@query(
    "iqr_bounds",
    f"""SELECT "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr, round(low, 4) AS low, round(high, 4) AS high
        FROM ({_fence_sql("lineitem", _MEASURES)})""",
)
def iqr_bounds(t):
    return C.round_cols(outliers.iqr_bounds(t("lineitem"), _MEASURES), ["q1", "q3", "iqr", "low", "high"], 4)


# Squares and products have long upper tails, so the fences cut something.
TAILS = """tails AS (SELECT l_orderkey, l_partkey, l_suppkey, l_quantity * l_quantity * l_quantity AS cube,
  l_extendedprice * l_discount AS rebate, l_tax FROM lineitem)"""
_TAIL_COLS = ["cube", "rebate", "l_tax"]


def _tails(t):
    q, e = F.col("l_quantity"), F.col("l_extendedprice")
    return t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", (q * q * q).alias("cube"), (e * F.col("l_discount")).alias("rebate"), "l_tax"
    )


def _outlier_sql(c: str) -> str:
    return f"""({c} < (SELECT low FROM fences WHERE "column" = '{c}') OR {c} > (SELECT high FROM fences WHERE "column" = '{c}'))"""


_TAIL_CTE = f"WITH {TAILS}, fences AS ({_fence_sql('tails', _TAIL_COLS)})"


@query(
    "iqr_report",
    f"""{_TAIL_CTE}, counts AS (
        {" UNION ALL ".join(f'''SELECT '{c}' AS "column", count(*) FILTER (WHERE {_outlier_sql(c)}) AS outliers FROM tails''' for c in _TAIL_COLS)})
      SELECT * FROM counts UNION ALL SELECT 'total', sum(outliers)::BIGINT FROM counts""",
)
def iqr_report(t):
    return outliers.iqr_report(_tails(t), _TAIL_COLS)


@query("iqr_rows", f"{_TAIL_CTE} SELECT l_orderkey, l_partkey, l_suppkey FROM tails WHERE {_outlier_sql('rebate')}")
def iqr_rows(t):
    return outliers.iqr_rows(_tails(t), "rebate").select("l_orderkey", "l_partkey", "l_suppkey")


@query(
    "iqr_drop",
    f"{_TAIL_CTE} SELECT l_orderkey, l_partkey, l_suppkey FROM tails WHERE NOT ({' OR '.join(_outlier_sql(c) for c in _TAIL_COLS)})",
)
def iqr_drop(t):
    return outliers.iqr_drop(_tails(t), _TAIL_COLS).select("l_orderkey", "l_partkey", "l_suppkey")


@query(
    "trim_quantile",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)",
)
def trim_quantile(t):
    return outliers.trim_quantile(t("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 0.99)


@query(
    "imputed_order_profile",
    """WITH holed AS (SELECT o_orderkey, o_orderpriority, o_orderstatus,
                             CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS x FROM orders),
       med AS (SELECT o_orderpriority, median(x) AS m FROM holed GROUP BY o_orderpriority),
       filled AS (SELECT holed.o_orderpriority, o_orderstatus, coalesce(x, m) AS x
                  FROM holed JOIN med ON holed.o_orderpriority = med.o_orderpriority)
       SELECT o_orderpriority, count(*) AS n, round(avg(x), 4) AS mean_price,
              sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS finished,
              round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS finished_rate
       FROM filled GROUP BY o_orderpriority""",
)
def imputed_order_profile(t):
    """Flagship: group-median imputation followed by a grouped report with a rate."""
    df = t("orders").select(
        "o_orderpriority", "o_orderstatus", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("x")
    )
    filled = fills.fill_group(df, ["o_orderpriority"], ["x"])
    return D.group_stats(
        filled,
        ["o_orderpriority"],
        {
            "n": F.count(F.lit(1)),
            "mean_price": F.round(F.avg("x"), 4),
            "finished": F.sum((F.col("o_orderstatus") == "F").cast("int")),
        },
        {"finished_rate": F.round(F.col("finished") / F.col("n"), 6)},
    )
