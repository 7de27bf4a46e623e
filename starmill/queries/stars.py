"""Dimension, calendar and fact queries over the given tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill import fixed
from starmill.functions.columns import date_id, time_text
from starmill.operators.lookup import Lookup, first_link
from starmill.operators.refresh import changed_rows, refresh
from starmill.operators.star import BUILDERS, clean_registry, date_dimension, dimension, fact
from starmill.plans import jobs
from starmill.queries.base import REGISTRY, query, table
from starmill.queries.cleaning import LINE_KEY
from starmill.session import work_folder
from starmill.sinks.files import read_table, write_files
from starmill.sinks.report import report
from starmill.specs import STAR_SPECS

MONEY = "decimal(12,2)"
ORACLES = REGISTRY.oracles


def nation_lookup(spark: SparkSession, root: str, key: str, nation: str = "nation", region: str = "region") -> Lookup:
    return Lookup(table(spark, root, "nation"), {key: "n_nationkey"}, {nation: "n_name", region: region},
                  unique=True, small=True, then=(Lookup(table(spark, root, "region"), {"n_regionkey": "r_regionkey"},
                                                        {region: "r_name"}, unique=True, small=True),))


@query("dim_customer", """SELECT c_custkey, c_name, c_mktsegment, n_name AS nation, r_name AS region FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def dim_customer(spark, root):
    return dimension(table(spark, root, "customer"), "c_custkey", [nation_lookup(spark, root, "c_nationkey")],
                     ["c_custkey", "c_name", "c_mktsegment", "nation", "region"])


@query("dim_part", """SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, b.s_suppkey AS first_suppkey,
  s.s_name AS first_supplier FROM part p
LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS s_suppkey FROM lineitem GROUP BY l_partkey) b ON p.p_partkey = b.l_partkey
LEFT JOIN supplier s ON b.s_suppkey = s.s_suppkey""")
def dim_part(spark, root):
    bridge = first_link(table(spark, root, "lineitem"), "l_partkey", "l_suppkey")
    supplier = Lookup(table(spark, root, "supplier"), {"l_suppkey": "s_suppkey"}, {"first_supplier": "s_name"}, unique=True)
    by_part = Lookup(bridge, {"p_partkey": "l_partkey"},
                     {"first_suppkey": "l_suppkey", "first_supplier": "first_supplier"}, then=(supplier,), unique=True)
    return dimension(table(spark, root, "part"), "p_partkey", [by_part],
                     ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "first_suppkey", "first_supplier"])


@query("dim_supplier", """SELECT s.s_suppkey, s.s_name, c.c_name AS contact_name, c.c_mktsegment AS contact_segment,
  n.n_name AS supplier_nation, r.r_name AS supplier_region FROM supplier s
LEFT JOIN customer c ON s.s_suppkey * 3 = c.c_custkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def dim_supplier(spark, root):
    """Two roles: a contact person under a key of another name, and the place with prefixed names."""
    supplier = table(spark, root, "supplier").withColumn("contact_id", F.col("s_suppkey") * 3)
    contact = Lookup(table(spark, root, "customer"), {"contact_id": "c_custkey"},
                     {"contact_name": "c_name", "contact_segment": "c_mktsegment"}, unique=True)
    place = nation_lookup(spark, root, "s_nationkey", "supplier_nation", "supplier_region")
    return dimension(supplier, "s_suppkey", [contact, place],
                     ["s_suppkey", "s_name", "contact_name", "contact_segment", "supplier_nation", "supplier_region"])


CALENDAR = """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, strftime(d, '%Y-%m-%d') AS full_date,
  CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, dayname(d) AS day_of_week,
  dayofweek(d) IN (0, 6) AS is_weekend FROM"""


@query("dim_date", f"""{CALENDAR} (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)
ORDER BY date_id""")
def dim_date(spark, root):
    days = date_dimension(table(spark, root, "orders"), "o_orderdate")
    return days.withColumn("full_date", time_text(F.col("full_date"), "yyyy-MM-dd"))


SALES_SQL = f"""
sales AS (
  SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS customer_id, l.l_partkey AS part_id,
    coalesce(c.c_nationkey, s.s_nationkey) AS nation_id,
    CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, l.l_quantity AS quantity,
    CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS revenue
  FROM (SELECT *, CASE WHEN l_orderkey % 23 <> 0 THEN l_orderkey END AS order_ref FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
      l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount) = 1) l
  LEFT JOIN orders o ON l.order_ref = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)
"""


def fact_sales(spark: SparkSession, root: str) -> DataFrame:
    """Sales at line grain. Some order keys are lost on purpose; their nation falls back to the supplier's."""
    lines = table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", F.when(F.col("l_orderkey") % 23 != 0, F.col("l_orderkey")).alias("order_ref"))
    customer = Lookup(table(spark, root, "customer"), {"o_custkey": "c_custkey"}, {"customer_nation": "c_nationkey"}, unique=True)
    order = Lookup(table(spark, root, "orders"), {"order_ref": "o_orderkey"},
                   {"customer_id": "o_custkey", "o_orderdate": "o_orderdate", "customer_nation": "customer_nation"},
                   then=(customer,), unique=True)
    supplier = Lookup(table(spark, root, "supplier"), {"l_suppkey": "s_suppkey"}, {"supplier_nation": "s_nationkey"}, unique=True)
    return fact(lines, LINE_KEY, [order, supplier], {
        "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "customer_id": "customer_id",
        "part_id": "l_partkey", "nation_id": F.coalesce("customer_nation", "supplier_nation"),
        "date_id": date_id(F.col("o_orderdate")), "quantity": "l_quantity",
        "revenue": (F.col("l_extendedprice").cast(MONEY) * (1 - F.col("l_discount").cast("decimal(4,2)"))
                    ).cast("decimal(18,4)"),
    }, order_by=["l_shipdate"])


@query("fact_sales", f"""WITH {SALES_SQL} SELECT l_orderkey, l_linenumber, customer_id, part_id, nation_id, date_id,
  quantity, CAST(revenue AS DOUBLE) AS revenue FROM sales""")
def fact_sales_query(spark, root):
    return fact_sales(spark, root).withColumn("revenue", F.col("revenue").cast("double"))


@query("star_revenue", f"""WITH {SALES_SQL}
SELECT coalesce(r_name, 'unknown') AS region, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  count(*) AS n_sales, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM sales LEFT JOIN nation ON nation_id = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) ON CAST(strftime(d, '%Y%m%d') AS INTEGER) = date_id
GROUP BY ALL""")
def star_revenue(spark, root):
    """Revenue by region, year and quarter. The fact is summed by its two dimension keys first, so the
    dimensions meet a few rows per nation and day and not every sale."""
    by_keys = fact_sales(spark, root).groupBy("nation_id", "date_id").agg(
        F.count("*").alias("n_sales"), F.sum("revenue").alias("revenue"))
    calendar = Lookup(date_dimension(table(spark, root, "orders"), "o_orderdate", ordered=False),
                      {"date_id": "date_id"}, {"year": "year", "quarter": "quarter"}, unique=True)
    place = nation_lookup(spark, root, "nation_id")
    wide = dimension(by_keys, ["nation_id", "date_id"], [calendar, place],
                     ["region", "year", "quarter", "n_sales", "revenue"], unique=True)
    return wide.groupBy(F.coalesce("region", F.lit("unknown")).alias("region"), "year", "quarter").agg(
        F.sum("n_sales").alias("n_sales"), F.sum("revenue").cast("double").alias("revenue"))


# --- the rental star, with the given tables in the shape of the rental sources --------------------

def rental_tables(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Regions as countries, nations as cities, customers, parts as films, suppliers as stores with
    their managers, orders as rentals, lines as payments. Some links are lost or doubled on purpose."""
    def t(name: str) -> DataFrame:
        return table(spark, root, name)

    stamp = F.lit("2006-02-15 04:34:33")

    def address() -> DataFrame:
        home = t("customer").select(
            F.col("c_custkey").alias("address_id"), F.concat(F.lit(" "), "c_custkey", F.lit(" Main Street ")).alias("address"),
            F.col("c_mktsegment").alias("district"),
            F.when(F.col("c_custkey") % 4 != 0, F.lpad(F.col("c_custkey").cast("string"), 5, "0")).alias("postal_code"),
            F.when(F.col("c_custkey") % 15 != 0, F.col("c_nationkey")).cast("bigint").alias("city_id"))
        shop = t("supplier").select(
            (-F.col("s_suppkey") - 1).alias("address_id"), F.concat("s_suppkey", F.lit(" Market Square")).alias("address"),
            F.lit("").alias("district"), F.lit(None).cast("string").alias("postal_code"),
            F.col("s_nationkey").cast("bigint").alias("city_id"))
        return home.unionByName(shop)

    def payment() -> DataFrame:
        shipped = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
        return t("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("payment_id"),
            (F.col("l_orderkey") + F.col("l_suppkey")).alias("customer_id"), F.col("l_suppkey").alias("staff_id"),
            F.when(F.col("l_orderkey") % 9 != 0, F.col("l_orderkey")).alias("rental_id"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
            F.when(F.col("l_partkey") % 50 == 0, F.lit("NaT")).otherwise(shipped).alias("payment_date"),
            shipped.alias("last_update"))

    def customer() -> DataFrame:
        return t("customer").select(
            F.col("c_custkey").alias("customer_id"), F.split("c_name", "#")[0].alias("first_name"),
            F.split("c_name", "#")[1].alias("last_name"), F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
            F.when(F.col("c_acctbal") > 0, 1).alias("active"),
            F.when(F.col("c_custkey") % 31 != 0, F.col("c_custkey")).alias("address_id"),
            stamp.alias("create_date"), stamp.alias("last_update"))

    def film() -> DataFrame:
        return t("part").select(
            F.col("p_partkey").alias("film_id"), F.concat(F.lit(" "), "p_name").alias("title"),
            F.lit(None).cast("string").alias("description"), F.lit(2006).alias("release_year"),
            F.col("p_size").alias("rental_duration"), F.col("p_retailprice").cast("decimal(10,2)").alias("rental_rate"),
            F.when(F.col("p_size") > 5, F.col("p_size") * 3).alias("length"), F.col("p_type").alias("rating"),
            (F.col("p_partkey") % 7).alias("language_id"), F.lit("").alias("last_update"))

    tables = {
        "address": address, "payment": payment, "customer": customer, "film": film,
        "country": lambda: t("region").select(
            F.col("r_regionkey").cast("bigint").alias("country_id"), F.col("r_name").alias("country"), stamp.alias("last_update")),
        "city": lambda: t("nation").select(
            F.col("n_nationkey").cast("bigint").alias("city_id"), F.col("n_name").alias("city"),
            F.col("n_regionkey").cast("bigint").alias("country_id"), stamp.alias("last_update")),
        "language": lambda: t("region").select(
            F.col("r_regionkey").cast("bigint").alias("language_id"), F.col("r_name").alias("name")),
        "category": lambda: t("nation").select(
            F.col("n_nationkey").cast("bigint").alias("category_id"), F.col("n_name").alias("name")),
        "film_category": lambda: t("lineitem").select(
            F.col("l_partkey").alias("film_id"), (F.col("l_suppkey") % 30).alias("category_id")),
        "store": lambda: t("supplier").select(
            F.col("s_suppkey").alias("store_id"), (F.col("s_suppkey") + 1).alias("manager_staff_id"),
            (-F.col("s_suppkey") - 1).alias("address_id"), stamp.alias("last_update")),
        "staff": lambda: t("supplier").select(
            F.col("s_suppkey").alias("staff_id"), F.col("s_name").alias("first_name"),
            F.col("s_nationkey").cast("string").alias("last_name"), F.col("s_suppkey").alias("store_id")),
        "inventory": lambda: t("part").select(
            F.col("p_partkey").alias("inventory_id"), F.col("p_partkey").alias("film_id"),
            F.col("p_size").cast("bigint").alias("store_id")),
        "rental": lambda: t("orders").select(
            F.col("o_orderkey").alias("rental_id"), F.when(F.col("o_orderkey") % 8 != 0, F.col("o_custkey")).alias("inventory_id"),
            F.col("o_custkey").alias("customer_id")),
    }
    return {name: tables[name]() for name in names}


def rental_star(spark: SparkSession, root: str, name: str) -> DataFrame:
    return BUILDERS[name](clean_registry(rental_tables(spark, root, fixed.STAR_SOURCES[name])))


STAMP = "'2006-02-15 04:34:33'"


@query("rental_dim_customer", f"""SELECT c.c_custkey AS customer_id, split_part(c.c_name, '#', 1) AS first_name,
  split_part(c.c_name, '#', 2) AS last_name, lower(c.c_name) || '@example.org' AS email,
  CASE WHEN c.c_acctbal > 0 THEN 1 ELSE 0 END AS active,
  a.c_custkey || ' Main Street' AS address, a.c_mktsegment AS district,
  CASE WHEN a.c_custkey IS NULL THEN NULL WHEN a.c_custkey % 4 <> 0 THEN lpad(a.c_custkey::VARCHAR, 5, '0') ELSE '' END AS postal_code,
  n_name AS city, r_name AS country, {STAMP} AS create_date, {STAMP} AS last_update
FROM customer c LEFT JOIN customer a ON a.c_custkey = c.c_custkey AND c.c_custkey % 31 <> 0
LEFT JOIN nation ON a.c_nationkey = n_nationkey AND a.c_custkey % 15 <> 0 LEFT JOIN region ON n_regionkey = r_regionkey""")
def rental_dim_customer(spark, root):
    out = rental_star(spark, root, "dim_customer")
    return out.withColumns({c: time_text(F.col(c)) for c in ("create_date", "last_update")})


@query("rental_dim_film", """SELECT p.p_partkey AS film_id, p.p_name AS title, '' AS description, 2006 AS release_year,
  p.p_size AS rental_duration, CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS rental_rate,
  CAST(CASE WHEN p.p_size > 5 THEN p.p_size * 3 ELSE 0 END AS INTEGER) AS length, p.p_type AS rating,
  r_name AS language, n_name AS category, CAST(NULL AS VARCHAR) AS last_update
FROM part p LEFT JOIN region ON p.p_partkey % 7 = r_regionkey
LEFT JOIN (SELECT l_partkey, min(l_suppkey % 30) AS category_id FROM lineitem GROUP BY l_partkey) b ON b.l_partkey = p.p_partkey
LEFT JOIN nation ON category_id = n_nationkey""")
def rental_dim_film(spark, root):
    out = rental_star(spark, root, "dim_film")
    return out.withColumn("last_update", time_text(F.col("last_update"))).withColumn(
        "rental_rate", F.col("rental_rate").cast("double"))


@query("rental_dim_store", f"""SELECT s.s_suppkey AS store_id, m.s_name AS manager_first_name,
  m.s_nationkey::VARCHAR AS manager_last_name, s.s_suppkey || ' Market Square' AS store_address,
  n_name AS store_city, r_name AS store_country, {STAMP} AS last_update
FROM supplier s LEFT JOIN supplier m ON m.s_suppkey = s.s_suppkey + 1
LEFT JOIN nation ON s.s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def rental_dim_store(spark, root):
    return rental_star(spark, root, "dim_store").withColumn("last_update", time_text(F.col("last_update")))


@query("rental_dim_date", f"""{CALENDAR} (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_partkey % 50 <> 0)
ORDER BY date_id""")
def rental_dim_date(spark, root):
    days = rental_star(spark, root, "dim_date")
    return days.withColumn("full_date", time_text(F.col("full_date"), "yyyy-MM-dd"))


@query("rental_fact_payment", """
WITH pay AS (SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey + l_suppkey AS customer_id, l_suppkey AS staff_id,
    CASE WHEN l_orderkey % 9 <> 0 THEN l_orderkey END AS rental_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
    CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_shipdate END AS payment_date, l_shipdate AS last_update FROM lineitem),
one AS (SELECT * FROM pay QUALIFY row_number() OVER (PARTITION BY payment_id
    ORDER BY last_update DESC NULLS LAST, customer_id, staff_id, rental_id, amount, payment_date) = 1)
SELECT payment_id, one.customer_id, p_partkey AS film_id, coalesce(CAST(p_size AS BIGINT), s_suppkey) AS store_id,
  CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS date_id, one.rental_id, CAST(amount AS DOUBLE) AS amount,
  strftime(payment_date, '%Y-%m-%d %H:%M:%S') AS payment_date, strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update
FROM one LEFT JOIN orders ON one.rental_id = o_orderkey
LEFT JOIN part ON p_partkey = CASE WHEN o_orderkey % 8 <> 0 THEN o_custkey END
LEFT JOIN supplier ON staff_id = s_suppkey""")
def rental_fact_payment(spark, root):
    out = rental_star(spark, root, "fact_payment").withColumn("amount", F.col("amount").cast("double"))
    return out.withColumns({c: time_text(F.col(c)) for c in ("payment_date", "last_update")})


# --- the rental star, refreshed by what changed ---------------------------------------------------

def earlier_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sources as they were: cities, categories and staff of other names, addresses and rentals elsewhere, rows that did not exist
    yet, and rows that are gone by now."""
    out = dict(tables)
    change = {
        "city": lambda df: df.withColumn("city", F.when(F.col("city_id") % 5 == 0, F.lit("OLD TOWN")).otherwise(F.col("city"))),
        "address": lambda df: df.withColumn("city_id", F.when(F.col("address_id") % 40 == 0, 3).otherwise(F.col("city_id"))),
        "customer": lambda df: df.filter("customer_id % 17 <> 0").unionByName(
            df.filter("customer_id % 100 = 1").withColumn("customer_id", F.col("customer_id") + 10_000_000)),
        "category": lambda df: df.withColumn("name", F.when(F.col("category_id") == 2, F.lit("old")).otherwise(F.col("name"))),
        "film_category": lambda df: df.filter("NOT (film_id % 23 = 0 AND category_id < 9)"),
        "staff": lambda df: df.withColumn("store_id", F.when(F.col("staff_id") % 6 == 0, -1).otherwise(F.col("store_id"))),
        "rental": lambda df: df.withColumn("inventory_id", F.when(F.col("rental_id") % 50 == 0, 7).otherwise(F.col("inventory_id"))),
        "payment": lambda df: df.filter("payment_id % 13 <> 0").unionByName(
            df.filter("payment_id % 97 = 0").withColumn("payment_id", -F.col("payment_id")).withColumn("payment_date", F.lit("2030-01-01 00:00:00"))),
    }
    return out | {name: change[name](df).select(*df.columns) for name, df in tables.items() if name in change}


def refreshed_star(spark: SparkSession, root: str, name: str) -> DataFrame:
    tables = rental_tables(spark, root, fixed.STAR_SOURCES[name])
    now, before = clean_registry(tables), clean_registry(earlier_tables(tables))
    changes = {t: changed_rows(before[t], now[t]) for t in now}
    return refresh(name, BUILDERS[name](before), now, changes)


@query("refresh_dim_customer", ORACLES["rental_dim_customer"])
def refresh_dim_customer(spark, root):
    out = refreshed_star(spark, root, "dim_customer")
    return out.withColumns({c: time_text(F.col(c)) for c in ("create_date", "last_update")})


@query("refresh_dim_film", ORACLES["rental_dim_film"])
def refresh_dim_film(spark, root):
    out = refreshed_star(spark, root, "dim_film")
    return out.withColumn("last_update", time_text(F.col("last_update"))).withColumn("rental_rate", F.col("rental_rate").cast("double"))


@query("refresh_dim_store", ORACLES["rental_dim_store"])
def refresh_dim_store(spark, root):
    return refreshed_star(spark, root, "dim_store").withColumn("last_update", time_text(F.col("last_update")))


@query("refresh_dim_date", ORACLES["rental_dim_date"])
def refresh_dim_date(spark, root):
    days = refreshed_star(spark, root, "dim_date")
    return days.withColumn("full_date", time_text(F.col("full_date"), "yyyy-MM-dd"))


@query("refresh_fact_payment", ORACLES["rental_fact_payment"])
def refresh_fact_payment(spark, root):
    out = refreshed_star(spark, root, "fact_payment").withColumn("amount", F.col("amount").cast("double"))
    return out.withColumns({c: time_text(F.col(c)) for c in ("payment_date", "last_update")})


# --- runs over a raw zone -------------------------------------------------------------------------

_RUN_SQL = """WITH runs AS (SELECT unnest([1, 2]) AS run),
  built AS (SELECT 'dim_customer' AS "table", (SELECT count(*) FROM customer) AS n
    UNION ALL SELECT 'dim_film', (SELECT count(*) FROM part) UNION ALL SELECT 'dim_store', (SELECT count(*) FROM supplier)
    UNION ALL SELECT 'dim_date', (SELECT count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_partkey % 50 <> 0)
    UNION ALL SELECT 'fact_payment', (SELECT count(DISTINCT l_orderkey * 10 + l_linenumber) FROM lineitem))
  SELECT CAST(run AS INTEGER) AS run, "table", CASE WHEN "table" = 'fact_payment' THEN 'append' ELSE 'overwrite' END AS mode,
    CASE WHEN run = 2 AND "table" = 'fact_payment' THEN 'empty' ELSE 'written' END AS status,
    CASE WHEN run = 2 AND "table" = 'fact_payment' THEN 0 ELSE n END AS rows, n AS held FROM runs, built"""


@query("star_runs", _RUN_SQL)
def star_runs(spark, root):
    """Two runs of a day's star from raw text files: found, read, cleaned, built, loaded by each table's mode, and reported. The
    second run replaces the dimensions and adds no fact."""
    path = work_folder(spark, "star-runs")
    tables = rental_tables(spark, root, sorted({t for need in fixed.STAR_SOURCES.values() for t in need}))
    for name, df in tables.items():
        write_files(df, f"{path}/raw/2024-06-14/{name}", fmt="csv")
    reports = []
    for run in (1, 2):
        done = jobs.star_day(spark, f"{path}/raw", jobs.star_sink(f"{path}/star", (), unique=True), "2024-06-14")
        reports.append(report(spark, done).select(F.lit(run).alias("run"), "table", "status", "rows"))
    held = reduce(DataFrame.unionByName, [
        read_table(spark, f"{path}/star/{name}").agg(F.count("*").alias("held")).withColumn("table", F.lit(name)).withColumn(
            "mode", F.lit(STAR_SPECS[name].mode)) for name in fixed.STAR_SOURCES])
    return reduce(DataFrame.unionByName, reports).join(held, "table").select("run", "table", "mode", "status", "rows", "held")
