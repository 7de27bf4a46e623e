"""Quality and profile queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill import fixed
from starmill.functions.columns import money_text
from starmill.operators import profile, quality
from starmill.queries.base import query, table

MONEY = "decimal(12,2)"


# --- quality ------------------------------------------------------------------------------------

def dirty_customers(spark: SparkSession, root: str) -> DataFrame:
    """Customers with an e-mail, some of them wrong, and some blank or lost texts."""
    key = F.col("c_custkey")
    return table(spark, root, "customer").select(
        "c_custkey", F.when(key % 12 != 0, F.col("c_name")).alias("c_name"),
        F.when(key % 8 == 0, F.lit(" \t ")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(key % 14 == 0, F.lit(None)).when(key % 9 == 0, F.lower("c_name"))
        .otherwise(F.concat(F.lower("c_name"), F.lit("@example.org"))).alias("email"),
        "c_acctbal")


CUSTOMERS_SQL = """
cust AS (SELECT c_custkey, CASE WHEN c_custkey % 12 <> 0 THEN c_name END AS c_name,
  CASE WHEN c_custkey % 8 = 0 THEN ' ' || chr(9) || ' ' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 14 = 0 THEN NULL WHEN c_custkey % 9 = 0 THEN lower(c_name)
       ELSE lower(c_name) || '@example.org' END AS email, c_acctbal FROM customer)
"""


def _line(name: str, check: str, column: str, sql: str) -> str:
    return f"SELECT '{name}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", ({sql}) AS violations"


def _per_column(name: str, view: str, check: str, columns: str, test: str) -> list[str]:
    return [_line(name, check, c, f"SELECT count(*) FROM {view} WHERE {test.format(c=c)}") for c in columns.split()]


_BLANK = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g') = ''"
QUALITY_LINES = [
    *_per_column("customer", "cust", "missing", "c_custkey c_name c_mktsegment email c_acctbal", "{c} IS NULL"),
    *_per_column("customer", "cust", "blank", "c_name c_mktsegment email", _BLANK),
    _line("customer", "email", "email", "SELECT count(*) FROM cust WHERE NOT coalesce(contains(email, '@'), false)"),
    _line("customer", "negative", "c_acctbal", "SELECT count(*) FROM cust WHERE c_acctbal < 0"),
    _line("customer", "not_positive", "absent", "SELECT CAST(NULL AS BIGINT)"),
    _line("customer", "duplicate_rows", "*", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cust)) FROM cust"),
    _line("customer", "duplicate_key", "c_custkey", "SELECT count(*) - count(DISTINCT c_custkey) FROM cust"),
    _line("lineitem", "zero", "l_discount", "SELECT count(*) FROM lineitem WHERE l_discount = 0"),
    _line("lineitem", "not_positive", "l_quantity", "SELECT count(*) FROM lineitem WHERE l_quantity <= 0"),
    _line("lineitem", "duplicate_rows", "*", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) FROM lineitem"),
    _line("lineitem", "duplicate_key", "l_orderkey,l_linenumber",
          "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem"),
]
QUALITY_SQL = (f"WITH {CUSTOMERS_SQL} SELECT *, CASE WHEN violations IS NULL THEN 'skipped' WHEN violations > 0 THEN 'failed' "
               f"ELSE 'passed' END AS status FROM ({' UNION ALL '.join(QUALITY_LINES)})")


def quality_tables(spark: SparkSession, root: str) -> dict[str, quality.TableChecks]:
    return {
        "customer": quality.TableChecks(
            dirty_customers(spark, root), ("c_custkey",),
            [quality.email("email"), quality.negative("c_acctbal"), quality.not_positive("absent")]),
        "lineitem": quality.TableChecks(
            table(spark, root, "lineitem"), ("l_orderkey", "l_linenumber"),
            [quality.zero("l_discount"), quality.not_positive("l_quantity")], standard=False),
    }


@query("quality_report", QUALITY_SQL)
def quality_report(spark, root):
    return quality.quality_report(quality_tables(spark, root))


@query("quality_failures", f"SELECT * FROM ({QUALITY_SQL}) WHERE status = 'failed'")
def quality_failures(spark, root):
    return quality.quality_report(quality_tables(spark, root), only_failed=True)


@query("duplicate_rows", """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, source, text FROM documents)) AS violations
FROM documents""")
def duplicate_rows(spark, root):
    return quality.duplicate_rows(table(spark, root, "documents").select("lang", "source", "text"))


def orders_with_lost_keys(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("o_orderkey")
    shifted = F.when(key % 10 == 0, F.lit(None)).when(key % 7 == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
    return table(spark, root, "orders").select("o_orderkey", shifted.alias("customer_id"))


LOST_SQL = """lost AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN -o_custkey - 1
  ELSE o_custkey END AS customer_id FROM orders)"""


@query("referential_check", f"""WITH {LOST_SQL}, counts AS (
  SELECT 'orders' AS "table", 'customer_id' AS "column", count(*) AS violations FROM lost
  WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id)
  UNION ALL SELECT 'lineitem', 'l_orderkey', count(*) FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
  UNION ALL SELECT 'orders', 'absent', NULL)
SELECT "table", 'orphan' AS "check", "column", violations, CASE WHEN violations IS NULL THEN 'skipped'
  WHEN violations > 0 THEN 'failed' ELSE 'passed' END AS status FROM counts""")
def referential_check(spark, root):
    orders, lost = table(spark, root, "orders"), orders_with_lost_keys(spark, root)
    customer, lines = table(spark, root, "customer"), table(spark, root, "lineitem")
    return quality.referential_report([
        ("orders", lost, customer, "customer_id", "c_custkey"),
        ("lineitem", lines, orders, "l_orderkey", "o_orderkey"),
        ("orders", lost, customer, "absent", "c_custkey"),
    ])


_LINE_LINKS = (("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey"),
               ("second_part", "part", "p_partkey"))


@query("referential_links", """WITH lines AS (SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey,
    CASE WHEN l_orderkey % 5 = 0 THEN -l_partkey - 1 ELSE l_partkey END AS l_partkey,
    CASE WHEN l_orderkey % 3 = 0 THEN 0 - l_suppkey - 1 ELSE l_suppkey END AS l_suppkey, l_partkey AS second_part FROM lineitem)
  SELECT 'lineitem' AS "table", 'orphan' AS "check", col AS "column", violations,
    CASE WHEN violations > 0 THEN 'failed' ELSE 'passed' END AS status FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, count(*) AS violations FROM lines WHERE NOT EXISTS (SELECT 1 FROM {p} WHERE {k} = {c})"
    for c, p, k in _LINE_LINKS) + ")")
def referential_links(spark, root):
    """Four keys of one child, two of them to the same parent, in one scan of the child."""
    key = F.col("l_orderkey")
    lines = table(spark, root, "lineitem").select(
        F.when(key % 7 != 0, key).alias("l_orderkey"),
        F.when(key % 5 == 0, -F.col("l_partkey") - 1).otherwise(F.col("l_partkey")).alias("l_partkey"),
        F.when(key % 3 == 0, -F.col("l_suppkey") - 1).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
        F.col("l_partkey").alias("second_part"))
    parents = {p: table(spark, root, p) for _, p, _ in _LINE_LINKS}
    return quality.referential_report([("lineitem", lines, parents[p], c, k) for c, p, k in _LINE_LINKS])


@query("orphan_rows", f"""WITH {LOST_SQL} SELECT * FROM lost
WHERE customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id)""")
def orphan_rows(spark, root):
    return quality.orphan_rows(orders_with_lost_keys(spark, root), table(spark, root, "customer"),
                               "customer_id", "c_custkey", ignore_null=True)


@query("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in ("customer", "part", "orders", "lineitem", "events")))
def row_counts(spark, root):
    return quality.row_counts({t: table(spark, root, t) for t in ("customer", "part", "orders", "lineitem", "events")})


# --- profile ------------------------------------------------------------------------------------

SHAPES = {"customer": 5, "part": 6, "orders": 6, "lineitem": 11}


@query("shape", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, {n} AS \"columns\" FROM {t}" for t, n in SHAPES.items()))
def shape(spark, root):
    return profile.shape({t: table(spark, root, t) for t in SHAPES})


_COLUMNS = (("c_custkey", "bigint"), ("c_name", "string"), ("c_mktsegment", "string"), ("email", "string"), ("c_acctbal", "double"))


@query("column_profile", f"WITH {CUSTOMERS_SQL} " + " UNION ALL ".join(
    f"SELECT 'customer' AS \"table\", {i} AS position, '{c}' AS \"column\", '{t}' AS type, count(*) AS rows, "
    f"count(*) - count({c}) AS missing FROM cust" for i, (c, t) in enumerate(_COLUMNS, 1)))
def column_profile(spark, root):
    return profile.column_profile(dirty_customers(spark, root), "customer")


def _describe_sql(view: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, "
        f"round(quantile_cont({c}, 0.75), 4) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {view}" for c in columns.split())


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")})


@query("describe_orders", _describe_sql("orders", "o_totalprice"))
def describe_orders(spark, root):
    return _rounded(profile.describe(table(spark, root, "orders"), ["o_totalprice"]))


@query("describe_lineitem", _describe_sql("lineitem", "l_quantity l_extendedprice l_discount"))
def describe_lineitem(spark, root):
    """The same report of several columns at once."""
    return _rounded(profile.describe(table(spark, root, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@query("total_and_mean", """SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
  round(avg(o_totalprice), 4) AS mean, format('{:,.2f}', CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE)) AS total_text
FROM orders""")
def total_and_mean(spark, root):
    orders = table(spark, root, "orders").select(F.col("o_totalprice").cast(MONEY).alias("amount"), "o_totalprice")
    return profile.total_and_mean(orders, "amount", "o_totalprice").select(
        F.col("total").cast("double").alias("total"), F.round("mean", 4).alias("mean"),
        money_text(F.col("total")).alias("total_text"))


@query("value_counts", "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def value_counts(spark, root):
    return profile.value_counts(table(spark, root, "events"), "event_type")


def _histogram_sql(view: str, column: str, bins: int) -> str:
    return f"""WITH r AS (SELECT CAST(min({column}) AS DOUBLE) AS a, CAST(max({column}) AS DOUBLE) AS b FROM {view}),
b AS (SELECT CAST(i + 1 AS INTEGER) AS bin, a + i * ((b - a) / {bins}) AS lower,
  CASE WHEN i = {bins - 1} THEN b ELSE a + (i + 1) * ((b - a) / {bins}) END AS upper FROM r, range({bins}) t(i))
SELECT bin, lower, upper, count({column}) AS n FROM b LEFT JOIN {view}
  ON {column} >= lower AND ({column} < upper OR bin = {bins} AND {column} <= upper) GROUP BY bin, lower, upper"""


@query("histogram", _histogram_sql("orders", "o_totalprice", fixed.AMOUNT_BINS))
def histogram(spark, root):
    return profile.histogram(table(spark, root, "orders"), "o_totalprice")


@query("histogram_duration", _histogram_sql("part", "p_size", fixed.DURATION_BINS))
def histogram_duration(spark, root):
    return profile.histogram(table(spark, root, "part"), "p_size", fixed.DURATION_BINS)


SPEND = "SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey"


def amounts(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select("o_custkey", F.col("o_totalprice").cast(MONEY).alias("amount"))


@query("group_sum", SPEND)
def group_sum(spark, root):
    return profile.group_sum(amounts(spark, root), "o_custkey", "amount").withColumn("total", F.col("total").cast("double"))


@query("top_customers", f"SELECT * FROM ({SPEND}) ORDER BY total DESC, o_custkey LIMIT 10")
def top_customers(spark, root):
    return profile.top_sums(amounts(spark, root), "o_custkey", "amount").withColumn("total", F.col("total").cast("double"))


@query("top_parts", "SELECT p_name, p_retailprice FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 10")
def top_parts(spark, root):
    return profile.top_k(table(spark, root, "part"), "p_retailprice", ["p_partkey"], columns=["p_name", "p_retailprice"])
