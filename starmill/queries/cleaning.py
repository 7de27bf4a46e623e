"""Cleaning queries: orders made dirty by the same expressions on both sides."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.columns import time_text
from starmill.functions.names import normalise_columns
from starmill.operators.clean import clean, drop_empty_rows, fill_defaults, rejects, tidy
from starmill.operators.dedup import dedup_counts, distinct_rows, latest_per_key
from starmill.operators.rules import keep_positive, lowered, rounded
from starmill.queries.base import query, table
from starmill.specs import TableSpec

ORDERS = TableSpec("orders", ("order_id",), refs=("customer_id",), types={
    "order_id": "bigint", "customer_id": "bigint", "total_price": "double", "last_update": "timestamp"})


def dirty_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders as a raw extract would bring them: odd names, padded and blank texts, bad times, lost
    values, empty rows, exact copies, newer versions and ties."""
    key = F.col("o_orderkey")
    copies = F.when(key % 10 < 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    day = F.col("o_orderdate") + F.when((key % 10 == 1) & (F.col("copy") == 1), F.expr("INTERVAL 1 DAY")).otherwise(
        F.expr("INTERVAL 0 DAY"))
    empty = key % 13 == 0

    def kept(col):
        return F.when(~empty, col)

    changed = (key % 10).isin(1, 2) & (F.col("copy") == 1)
    return table(spark, root, "orders").select("*", F.explode(copies).alias("copy")).select(
        key.alias("Order ID"),
        kept(F.when(key % 17 != 0, F.col("o_custkey"))).alias("Customer-ID"),
        kept(F.when(key % 7 == 0, F.lit("   ")).otherwise(
            F.concat(F.lit("  "), F.when(changed, F.lit("Z")).otherwise(F.col("o_orderstatus")), F.lit(" ")))
             ).alias("Status!"),
        kept(F.when(key % 6 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), F.col("o_orderpriority")))
             ).alias(" priority"),
        kept(F.when(key % 5 != 0, F.col("o_totalprice"))).alias("Total Price"),
        kept(F.when(key % 11 == 0, F.lit("bad")).when(key % 19 == 0, F.lit(""))
             .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))).alias("Last Update"),
    )


DIRTY = """
copied AS (
  SELECT o.*, c.copy FROM orders o, (VALUES (0), (1)) AS c(copy)
  WHERE c.copy = 0 OR o.o_orderkey % 10 < 3),
raw AS (
  SELECT o_orderkey AS order_id,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS customer_id,
    CASE WHEN o_orderkey % 7 = 0 THEN '   '
         ELSE '  ' || CASE WHEN o_orderkey % 10 IN (1, 2) AND copy = 1 THEN 'Z' ELSE o_orderstatus END || ' ' END AS status,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE ' ' || o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS total_price,
    CASE WHEN o_orderkey % 11 = 0 THEN 'bad' WHEN o_orderkey % 19 = 0 THEN ''
         ELSE strftime(o_orderdate + CASE WHEN o_orderkey % 10 = 1 AND copy = 1 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END,
                       '%Y-%m-%d %H:%M:%S') END AS last_update
  FROM copied),
dirty AS (
  SELECT order_id,
    CASE WHEN order_id % 13 <> 0 THEN customer_id END AS customer_id,
    CASE WHEN order_id % 13 <> 0 THEN status END AS status,
    CASE WHEN order_id % 13 <> 0 THEN priority END AS priority,
    CASE WHEN order_id % 13 <> 0 THEN total_price END AS total_price,
    CASE WHEN order_id % 13 <> 0 THEN last_update END AS last_update
  FROM raw),
tidy AS (
  SELECT order_id, customer_id, nullif(trim(status, ' '), '') AS status, nullif(trim(priority, ' '), '') AS priority,
    total_price, try_cast(nullif(last_update, '') AS TIMESTAMP) AS last_update
  FROM dirty),
full_rows AS (
  SELECT * FROM tidy WHERE NOT (customer_id IS NULL AND status IS NULL AND priority IS NULL
                                AND total_price IS NULL AND last_update IS NULL)),
filled AS (
  SELECT order_id, customer_id, coalesce(status, '') AS status, coalesce(priority, '') AS priority,
    coalesce(total_price, 0) AS total_price, last_update FROM full_rows),
latest AS (
  SELECT * FROM filled QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY last_update DESC NULLS LAST, customer_id, status, priority, total_price) = 1)
"""
OUT = ("order_id, customer_id, status, priority, total_price, "
       "strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update")


def as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("last_update", time_text(F.col("last_update")))


@query("normalise_names", f"WITH {DIRTY} SELECT * FROM dirty")
def normalise_names(spark, root):
    return normalise_columns(dirty_orders(spark, root))


@query("clean_strings", f"WITH {DIRTY} SELECT order_id, status, priority, total_price FROM tidy")
def clean_strings(spark, root):
    raw = normalise_columns(dirty_orders(spark, root))
    return tidy(raw, ORDERS).select("order_id", "status", "priority", "total_price")


@query("clean_parse_time", f"WITH {DIRTY} SELECT order_id, strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update FROM tidy")
def clean_parse_time(spark, root):
    raw = normalise_columns(dirty_orders(spark, root))
    return as_text(tidy(raw, ORDERS)).select("order_id", "last_update")


@query("clean_fill", f"""WITH {DIRTY} SELECT order_id, customer_id, coalesce(status, '') AS status,
  coalesce(priority, '') AS priority, coalesce(total_price, 0) AS total_price FROM tidy""")
def clean_fill(spark, root):
    raw = normalise_columns(dirty_orders(spark, root))
    return fill_defaults(tidy(raw, ORDERS), ORDERS).drop("last_update")


@query("drop_empty_rows", f"WITH {DIRTY} SELECT {OUT} FROM full_rows")
def drop_empty(spark, root):
    raw = normalise_columns(dirty_orders(spark, root))
    return as_text(drop_empty_rows(tidy(raw, ORDERS), ORDERS.keys))


@query("clean_incremental", f"WITH {DIRTY} SELECT DISTINCT {OUT} FROM filled")
def clean_incremental(spark, root):
    return as_text(dirty_orders(spark, root).transform(clean(ORDERS, "incremental")))


@query("clean_historical", f"WITH {DIRTY} SELECT {OUT} FROM latest")
def clean_historical(spark, root):
    return as_text(dirty_orders(spark, root).transform(clean(ORDERS, "historical")))


@query("clean_warehouse", f"""WITH {DIRTY} SELECT order_id, customer_id, lower(status) AS status, priority,
  round(total_price, 1) AS total_price, strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update
  FROM latest WHERE total_price > 0""")
def clean_warehouse(spark, root):
    rules = (keep_positive("total_price"), rounded("total_price", 1), lowered("status"), keep_positive("absent"))
    return as_text(dirty_orders(spark, root).transform(clean(replace(ORDERS, rules=rules), "warehouse")))


@query("clean_star", f"""WITH {DIRTY} SELECT DISTINCT order_id, customer_id, coalesce(status, '') AS status,
  coalesce(priority, '') AS priority, coalesce(total_price, 0) AS total_price,
  strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update FROM tidy""")
def clean_star(spark, root):
    return as_text(dirty_orders(spark, root).transform(clean(ORDERS, "star")))


@query("clean_metrics", """
WITH exact AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_shipdate FROM lineitem)),
keyed AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
total AS (SELECT count(*) AS n FROM lineitem)
SELECT total.n AS rows_in, exact.n AS rows_exact, keyed.n AS rows_out,
  total.n - exact.n AS exact_removed, exact.n - keyed.n AS key_removed FROM total, exact, keyed""")
def clean_metrics(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    return dedup_counts(lines, ["l_orderkey", "l_linenumber"])


@query("dedup_exact", """SELECT DISTINCT l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS ship_day
FROM lineitem""")
def dedup_exact(spark, root):
    lines = table(spark, root, "lineitem")
    rows = distinct_rows(lines.select("l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("d")))
    return rows.select("l_returnflag", "l_linestatus", time_text(F.col("d"), "yyyy-MM-dd").alias("ship_day"))


LINE_KEY = ["l_orderkey", "l_linenumber"]
LATEST_LINE = """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus) = 1"""


@query("dedup_latest", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM ({LATEST_LINE})""")
def dedup_latest(spark, root):
    lines = latest_per_key(table(spark, root, "lineitem"), LINE_KEY, ["l_shipdate"])
    return lines.withColumn("l_shipdate", time_text(F.col("l_shipdate"), "yyyy-MM-dd"))


@query("dedup_unordered", """SELECT * FROM (SELECT o_custkey, o_orderpriority, o_orderstatus, o_totalprice FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderstatus, o_totalprice) = 1""")
def dedup_unordered(spark, root):
    """No change column: the remaining columns decide, so the survivor is still the same each time."""
    rows = table(spark, root, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    return latest_per_key(rows, ["o_custkey", "o_orderpriority"])


TEXT_ORDERS = TableSpec("orders", ("order_id",), refs=("customer_id",), types={
    "order_id": "bigint", "customer_id": "bigint", "total_price": "decimal(10,2)"})


def text_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders as texts, some of which are no numbers, too large or too fine for their type."""
    key = F.col("o_orderkey")
    return table(spark, root, "orders").select(
        F.when(key % 23 == 0, F.concat(F.lit("no "), key.cast("string"))).otherwise(key.cast("string")).alias("Order ID"),
        F.when(key % 29 == 0, F.lit("?")).otherwise(F.col("o_custkey").cast("string")).alias("Customer ID"),
        F.when(key % 7 == 0, F.lit("n/a")).when(key % 11 == 0, F.lit("123456789.99")).when(key % 13 == 0, F.lit("2.999"))
        .when(key % 17 == 0, F.lit(" ")).otherwise(F.lit("10.50")).alias("Total Price"))


@query("clean_rejects", """
WITH lost AS (
  SELECT 'order_id' AS "column", 'unread' AS kind, 'no ' || o_orderkey AS value FROM orders WHERE o_orderkey % 23 = 0
  UNION ALL SELECT 'customer_id', 'unread', '?' FROM orders WHERE o_orderkey % 29 = 0
  UNION ALL SELECT 'total_price', CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'unread' ELSE 'rounded' END,
    CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN '123456789.99' ELSE '2.999' END
  FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0)
SELECT "column", kind, value, count(*) AS rows FROM lost GROUP BY ALL""")
def clean_rejects(spark, root):
    """Each value that the types cannot hold."""
    return rejects(text_orders(spark, root), TEXT_ORDERS)


@query("clean_unread", """
SELECT CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey END AS order_id,
  CASE WHEN o_orderkey % 29 <> 0 THEN o_custkey END AS customer_id,
  CAST(CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 3
    WHEN o_orderkey % 17 = 0 THEN 0 ELSE 10.5 END AS DOUBLE) AS total_price
FROM orders""")
def clean_unread(spark, root):
    """Rows with values that cannot be read stay, each of them, and get no default."""
    return text_orders(spark, root).transform(clean(TEXT_ORDERS, "historical")).withColumn(
        "total_price", F.col("total_price").cast("double"))
