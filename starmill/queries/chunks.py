"""Raw text files read in parallel: cut inside cells, with other headers, typed by their values."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.operators.types import type_report
from starmill.queries.base import query, table
from starmill.session import work_folder
from starmill.sinks.files import write_files
from starmill.sources.records import is_first, numbered_lines, read_chunks, records


@query("csv_cut_anywhere", "SELECT doc_id::INT AS doc_id, text, lang, source, n_chars::INT AS n_chars FROM documents")
def csv_cut_anywhere(spark, root):
    """Whole texts with line breaks, from files cut every 256 KB, most of them inside a cell."""
    path = work_folder(spark, "csv")
    write_files(table(spark, root, "documents"), path, fmt="csv")
    return read_chunks(spark, path, infer=True, split_bytes=256 << 10)


@query("csv_line_counts", """SELECT count(*) AS records,
  count(*) + sum(length(text) - length(replace(text, chr(10), '')))::BIGINT AS lines FROM documents""")
def csv_line_counts(spark, root):
    """Records and physical lines of one file, without headers, counted over its splits."""
    path = work_folder(spark, "csv")
    write_files(table(spark, root, "documents"), path, fmt="csv")
    lines = numbered_lines(spark, path, split_bytes=256 << 10)
    whole = records(lines).filter(~is_first()).select(F.lit(1).alias("record"), F.lit(0).alias("line"))
    every = whole.unionByName(lines.filter(~is_first()).select(F.lit(0).alias("record"), F.lit(1).alias("line")))
    return every.agg(F.sum("record").cast("bigint").alias("records"), F.sum("line").cast("bigint").alias("lines"))


ORDER_LAYOUTS = (
    ("o_orderkey", "o_custkey", "o_totalprice"),
    ("o_totalprice", "o_orderkey", "o_custkey"),
    ("O Orderkey", "o_orderpriority", "O-Totalprice"),
    ("o_orderstatus", "o_custkey", "o_orderkey"),
)


@query("chunks_of_other_headers", """SELECT o_orderkey::INT AS o_orderkey,
  CASE WHEN o_orderkey % 4 <> 2 THEN o_custkey END::INT AS o_custkey,
  CASE WHEN o_orderkey % 4 <> 3 THEN o_totalprice END::DOUBLE AS o_totalprice,
  CASE WHEN o_orderkey % 4 = 2 THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 4 = 3 THEN o_orderstatus END AS o_orderstatus FROM orders""")
def chunks_of_other_headers(spark, root):
    """Four layouts of a table, with columns in another order, missing, added and named otherwise, as one typed frame."""
    orders, path = table(spark, root, "orders"), work_folder(spark, "layouts")
    names = {"O Orderkey": "o_orderkey", "O-Totalprice": "o_totalprice"}
    for k, layout in enumerate(ORDER_LAYOUTS):
        part = orders.filter(F.col("o_orderkey") % len(ORDER_LAYOUTS) == k)
        write_files(part.select(*(F.col(names.get(c, c)).alias(c) for c in layout)), f"{path}/{k}", fmt="csv")
    return read_chunks(spark, f"{path}/*", infer=True).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")


_INTEGER, _REAL = "^[+-]?[0-9]+$", "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
# Text columns of orders, some of them with values of another kind.
_CELLS = {
    "o_orderkey": "o_orderkey::VARCHAR",
    "o_custkey": "CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN '' ELSE o_custkey::VARCHAR END",
    "big": "(o_orderkey * 4000000000)::VARCHAR",
    "wide": "CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey || '00000000000000000000' ELSE o_orderkey::VARCHAR END",
    "price": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR ELSE o_orderkey || '.25' END",
    "day": "strftime(o_orderdate, '%Y-%m-%d')",
    "moment": "CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 10:20:30' END",
    "flag": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'FALSE' END",
    "priority": "o_orderpriority",
}
_KIND = f"""CASE WHEN value IS NULL THEN NULL
  WHEN regexp_matches(value, '{_INTEGER}') AND TRY_CAST(value AS INTEGER) IS NOT NULL THEN 'int'
  WHEN regexp_matches(value, '{_INTEGER}') AND TRY_CAST(value AS BIGINT) IS NOT NULL THEN 'bigint'
  WHEN regexp_matches(value, '{_INTEGER}') AND length(ltrim(value, '+-0')) <= 38 THEN 'decimal'
  WHEN regexp_matches(value, '{_REAL}') THEN 'double'
  WHEN regexp_matches(value, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND TRY_CAST(value AS DATE) IS NOT NULL THEN 'date'
  WHEN regexp_matches(value, '^\\d{{4}}-\\d{{2}}-\\d{{2}}[ T]\\d{{2}}:\\d{{2}}:\\d{{2}}$') THEN 'timestamp'
  WHEN lower(value) IN ('true', 'false') THEN 'boolean' ELSE 'string' END"""
_CHAIN = {"int": "('int')", "bigint": "('int', 'bigint')", "decimal": "('int', 'bigint', 'decimal')",
          "double": "('int', 'bigint', 'decimal', 'double')", "date": "('date')", "timestamp": "('date', 'timestamp')",
          "boolean": "('boolean')"}
_FITS = " OR ".join(f"usual = '{k}' AND kind IN {held}" for k, held in _CHAIN.items()) + " OR usual = 'string'"


@query("type_evidence", f"""WITH cells AS (
  {' UNION ALL '.join(f"SELECT {i} AS position, '{c}' AS col, nullif({e}, '') AS value FROM orders" for i, (c, e) in enumerate(_CELLS.items(), 1))}),
kinds AS (SELECT *, {_KIND} AS kind FROM cells),
most AS (SELECT position, arg_max(kind, n * 100 - list_position(['boolean','int','bigint','decimal','double','date','timestamp','string'], kind))
    AS usual FROM (SELECT position, kind, count(*) AS n FROM kinds WHERE kind IS NOT NULL GROUP BY ALL) GROUP BY position),
whole AS (SELECT k.*, usual FROM kinds k LEFT JOIN most USING (position))
SELECT position, col AS "column", CASE
    WHEN bool_and(kind IN {_CHAIN['double']}) THEN CASE WHEN bool_or(kind = 'double') THEN 'double'
      WHEN bool_or(kind = 'decimal') THEN 'decimal(' || max(length(ltrim(value, '+-0'))) || ',0)'
      WHEN bool_or(kind = 'bigint') THEN 'bigint' ELSE 'int' END
    WHEN bool_and(kind IN {_CHAIN['timestamp']}) THEN CASE WHEN bool_or(kind = 'timestamp') THEN 'timestamp' ELSE 'date' END
    WHEN bool_and(kind = 'boolean') THEN 'boolean' ELSE 'string' END AS type,
  count(*) AS rows, count(*) - count(value) AS missing, any_value(usual) AS usual,
  count(*) FILTER (kind IS NOT NULL AND NOT ({_FITS})) AS misfits,
  min(value) FILTER (kind IS NOT NULL AND NOT ({_FITS})) AS counter_example
FROM whole GROUP BY position, col""")
def type_evidence(spark, root):
    """Types of text columns, and the values that speak against the usual kind of each."""
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    text = key.cast("string")
    cells = table(spark, root, "orders").select(
        text.alias("o_orderkey"),
        F.when(key % 101 == 0, "n/a").when(key % 11 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        (key * 4_000_000_000).cast("string").alias("big"),
        F.when(key % 7 == 0, F.concat(text, F.lit("0" * 20))).otherwise(text).alias("wide"),
        F.when(key % 2 == 0, text).otherwise(F.concat(text, F.lit(".25"))).alias("price"),
        day.alias("day"), F.when(key % 5 == 0, day).otherwise(F.concat(day, F.lit(" 10:20:30"))).alias("moment"),
        F.when(key % 2 == 0, "true").otherwise("FALSE").alias("flag"), F.col("o_orderpriority").alias("priority"))
    return type_report(cells)
