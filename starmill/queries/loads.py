"""Increment, journal, trigger and file-discovery queries."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.columns import chunk_label, time_text
from starmill.operators import increment as inc
from starmill.operators.intervals import gaps, islands
from starmill.operators.clean import clean
from starmill.operators.dedup import latest_per_key
from starmill.operators.trigger import read_events, trigger_counts
from starmill.plans.extract import Journal, extract_history, extract_increment
from starmill.queries.base import query, table
from starmill.session import work_folder
from starmill.sources.catalog import FrameSource
from starmill.sources.files import file_tables, table_files, union_chunks
from starmill.specs import TableSpec

KEYS = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey"}
EVENT_OUT = "event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value"


def events_out(df: DataFrame, *more: str) -> DataFrame:
    return df.select("event_id", time_text(F.col("ts")).alias("ts"), "user_id", "event_type", "value", *more)


@query("day_window", f"SELECT {EVENT_OUT} FROM events WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-11'")
def day_window(spark, root):
    return events_out(inc.day_window(table(spark, root, "events"), "ts", "2024-01-10"))


@query("missed_days", f"SELECT {EVENT_OUT} FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-14'")
def missed_days(spark, root):
    return events_out(inc.day_window(table(spark, root, "events"), "ts", "2024-01-11", "2024-01-14"))


@query("day_counts", "SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS rows FROM events GROUP BY 1")
def day_counts(spark, root):
    return inc.day_counts(table(spark, root, "events"), "ts").withColumn("day", time_text(F.col("day"), "yyyy-MM-dd"))


@query("increment_complete", f"SELECT {EVENT_OUT} FROM events")
def increment_complete(spark, root):
    """A history and two increments: one after a day without run, both with rows that came late on the last loaded
    day. Read back and cleaned by key they are the whole table."""
    events = table(spark, root, "events").withColumnRenamed("ts", "last_update")
    path = work_folder(spark, "increments")
    journal = Journal(spark, f"{path}/journal")
    days = [str(d) for d in events.select(F.to_date(F.min("last_update")), F.to_date(F.max("last_update"))).first()]
    first, second, last = days[0], str(date.fromisoformat(days[0]) + timedelta(days=2)), days[1]
    day, late = F.to_date("last_update"), F.col("event_id") % 10 == 0
    for run, until in enumerate((first, second, last)):
        there = events if until == last else events.filter((day < until) | ((day == until) & ~late))
        source = FrameSource(spark, {"events": there})
        if run == 0:
            extract_history(source, f"{path}/raw", journal, fmt="parquet")
        else:
            extract_increment(source, f"{path}/raw", journal, until, fmt="parquet")
    loaded = spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{path}/raw/events")
    spec = TableSpec("events", ("event_id",))
    return events_out(loaded.transform(clean(spec, "historical", fill=False)).withColumnRenamed("last_update", "ts"))


@query("late_keys", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def late_keys(spark, root):
    """Four runs over a growing table without change time, in which a third of the keys is committed one to three runs late, below
    keys that were loaded long ago: every row comes, once."""
    orders, path = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), work_folder(spark, "late")
    journal, key = Journal(spark, f"{path}/journal"), F.col("o_orderkey")
    top = inc.key_range(orders, "o_orderkey").first()["max_id"]
    due = F.ceil(4 * key / top) + F.when(F.pmod(F.hash(key), F.lit(3)) == 0, F.pmod(F.hash(key), F.lit(4))).otherwise(0)
    for run in range(1, 5):
        there = orders if run == 4 else orders.filter(due <= run)
        source = FrameSource(spark, {"orders": there}, {"orders": ("o_orderkey",)})
        if run == 1:
            extract_history(source, f"{path}/raw", journal, fmt="parquet", late_keys=True)
        else:
            extract_increment(source, f"{path}/raw", journal, f"1998-01-0{run}", fmt="parquet", late_keys=True)
    return spark.read.schema(orders.schema).option("recursiveFileLookup", "true").parquet(f"{path}/raw/orders")


@query("key_intervals", """WITH k AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 1000 > 20 OR o_orderkey % 7 = 0),
  runs AS (SELECT k, k - row_number() OVER (ORDER BY k) AS run FROM k),
  held AS (SELECT min(k) AS low, max(k) AS high FROM runs GROUP BY run),
  ends AS (SELECT * FROM held UNION ALL SELECT max(o_orderkey) + 1, max(o_orderkey) + 1 FROM orders UNION ALL SELECT min(o_orderkey) - 1, min(o_orderkey) - 1 FROM orders),
  open AS (SELECT high + 1 AS low, lead(low) OVER (ORDER BY low) - 1 AS high FROM ends)
  SELECT 'held' AS kind, low, high FROM held UNION ALL SELECT 'gap', low, high FROM open WHERE high >= low""")
def key_intervals(spark, root):
    """Keys that are there as intervals, and the gaps between them."""
    orders, key = table(spark, root, "orders"), F.col("o_orderkey")
    held = islands(orders.filter((key % 1000 > 20) | (key % 7 == 0)), "o_orderkey")
    _, low, top = inc.key_range(orders, "o_orderkey").first()
    return held.withColumn("kind", F.lit("held")).unionByName(gaps(held, low, top).withColumn("kind", F.lit("gap")))


@query("key_increment", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)")
def key_increment(spark, root):
    orders = table(spark, root, "orders")
    last_id = inc.key_range(orders, "o_orderkey").first()["max_id"] // 2
    return inc.key_increment(orders, "o_orderkey", last_id).select("o_orderkey", "o_custkey")


@query("written_mark", """SELECT 'orders' AS "table", max(o_orderkey) AS last_id, true AS bootstrapped FROM orders
WHERE o_orderdate < DATE '1998-01-01'""")
def written_mark(spark, root):
    written = table(spark, root, "orders").filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("date"))
    return inc.written_mark(written, "orders", "o_orderkey", 0)


@query("bootstrap_state", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", coalesce(max({k}), 0) AS last_id, true AS bootstrapped FROM {t}" for t, k in KEYS.items()))
def bootstrap_state(spark, root):
    return inc.bootstrap_state({t: (table(spark, root, t), k) for t, k in KEYS.items()})


@query("state_log", """SELECT event_type AS "table", max(event_id) AS last_id, bool_or(value > 50) AS bootstrapped
FROM events GROUP BY event_type""")
def state_log(spark, root):
    """Events read as a log of marks: the state is the highest mark of each table."""
    log = table(spark, root, "events").select(
        F.col("event_type").alias("table"), F.col("event_id").alias("last_id"), (F.col("value") > 50).alias("bootstrapped"))
    return inc.current_state(log)


@query("extract_plan", """
WITH ranges AS (
  SELECT 'customer' AS "table", count(*) AS rows, min(c_custkey) AS min_id, coalesce(max(c_custkey), 0) AS max_id FROM customer
  UNION ALL SELECT 'orders', count(*), min(o_orderkey), coalesce(max(o_orderkey), 0) FROM orders
  UNION ALL SELECT 'part', count(*), min(p_partkey), coalesce(max(p_partkey), 0) FROM part
  UNION ALL SELECT 'supplier', count(*), min(s_suppkey), coalesce(max(s_suppkey), 0) FROM supplier),
plan AS (SELECT "table", 'key' AS strategy, true AS in_increment FROM ranges
  UNION ALL SELECT 'events', 'date', true UNION ALL SELECT 'lineitem', 'full', false)
SELECT plan."table", strategy, in_increment, rows, min_id, max_id, CAST(ceil(rows / 10000.0) AS BIGINT) AS chunks
FROM plan LEFT JOIN ranges ON plan."table" = ranges."table" """)
def extract_plan(spark, root):
    frames = {t: table(spark, root, t) for t in (*KEYS, "events", "lineitem")}
    source = FrameSource(spark, frames, {t: (k,) for t, k in KEYS.items()}, change="ts")
    ranges = inc.key_ranges({t: (frames[t], k) for t, k in KEYS.items()})
    return inc.plan_extract(source.catalog()).join(ranges, "table", "left").select(
        "table", "strategy", "in_increment", "rows", "min_id", "max_id", "chunks")


@query("load_manifest", """SELECT 'events' AS "table", coalesce(strftime(d, '%Y-%m-%d'), 'no-date') AS run_date, count(*) AS rows,
  CAST(ceil(count(*) / 100.0) AS BIGINT) AS files
FROM (SELECT CASE WHEN event_id % 40 <> 0 THEN CAST(ts AS DATE) END AS d FROM events) GROUP BY d""")
def load_manifest(spark, root):
    events = table(spark, root, "events").select(F.when(F.col("event_id") % 40 != 0, F.col("ts")).alias("last_update"))
    return inc.load_manifest(events, "events", "last_update", 100)


@query("partition_label", """SELECT o_orderkey, coalesce(strftime(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END, '%Y-%m-%d'),
  'no-date') AS run_date, CASE WHEN length((o_orderkey // 10)::VARCHAR) > 4 THEN (o_orderkey // 10)::VARCHAR
  ELSE lpad((o_orderkey // 10)::VARCHAR, 4, '0') END AS chunk FROM orders""")
def partition_label(spark, root):
    orders = table(spark, root, "orders").withColumn("at", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")))
    chunk = chunk_label(F.floor(F.col("o_orderkey") / 10))
    return inc.with_run_date(orders, "at").select("o_orderkey", "run_date", chunk.alias("chunk"))


# Units of work are the days of each event type; the journal has one or more tries for each.
TRIES_SQL = """tries AS (SELECT event_type || '/' || strftime(ts, '%Y-%m-%d') AS "table",
  CASE WHEN value < 40 THEN 'done' ELSE 'error' END AS status, event_id, ts, value FROM events),
ledger AS (SELECT * FROM tries QUALIFY row_number() OVER (PARTITION BY "table" ORDER BY ts DESC, status DESC) = 1)"""


def journal(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "events")
    return events.select(
        F.concat_ws("/", "event_type", F.date_format("ts", "yyyy-MM-dd")).alias("table"),
        F.when(F.col("value") < 40, "done").otherwise("error").alias("status"),
        F.col("event_id").alias("rows_uploaded"), F.col("value").cast("decimal(12,2)").alias("seconds"),
        F.col("ts").alias("saved_at"))


@query("resume_work_list", f"""WITH {TRIES_SQL} SELECT DISTINCT "table" FROM tries
WHERE "table" NOT IN (SELECT "table" FROM ledger WHERE status = 'done')""")
def resume_work_list(spark, root):
    log = journal(spark, root)
    return inc.work_list(log.select("table").distinct(), inc.current_ledger(log))


@query("ledger_totals", f"""WITH {TRIES_SQL} SELECT count(*) AS tables, count(*) FILTER (status = 'done') AS done,
  count(*) FILTER (status = 'error') AS failed, CAST(sum(event_id) AS BIGINT) AS rows_uploaded,
  CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS seconds FROM ledger""")
def ledger_totals(spark, root):
    totals = inc.ledger_totals(inc.current_ledger(journal(spark, root)))
    return totals.withColumn("seconds", F.col("seconds").cast("double"))


@query("union_chunks", """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 4 <> 3 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def union_chunks_query(spark, root):
    """Four chunks with overlap, one without the priority column; together they are the whole table."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    part = F.col("o_orderkey") % 4
    chunks = [orders.filter(part.isin(0, 1)), orders.filter(part.isin(1, 2)), orders.filter(part == 2),
              orders.filter(part == 3).drop("o_orderpriority").select("o_orderstatus", "o_custkey", "o_orderkey")]
    return latest_per_key(union_chunks(chunks), ["o_orderkey"])


# --- triggers -----------------------------------------------------------------------------------

def trigger_log(spark: SparkSession, root: str) -> DataFrame:
    """Every event becomes a trigger event in JSON, of a shape that depends on its type."""
    day = F.date_format("ts", "yyyy-MM-dd")
    folder = F.when(F.col("event_id") % 10 == 0, F.lit("not-a-date")).otherwise(day)

    def record(name: str):
        key = F.concat(F.lit("incremental-data/"), folder, F.lit(f"/{name}/{name}.csv"))
        return F.struct(F.lit("aws:s3").alias("eventSource"), F.struct(F.struct(key.alias("key")).alias("object")).alias("s3"))

    one, two = F.array(record("orders")), F.array(record("orders"), record("lineitem"))
    kind, odd = F.col("event_type"), F.col("event_id") % 2 == 1
    text = (
        F.when(kind == "click", F.to_json(F.struct(F.when(odd, two).otherwise(one).alias("Records"))))
        .when(kind == "view", F.lit('{"source": "aws.events", "detail-type": "Scheduled Event"}'))
        .when(kind == "signup", F.lit('{"source": "aws.events", "detail-type": "Run Historical Load"}'))
        .when(kind == "purchase", F.concat(F.lit('{"trigger_type": "direct", "run_date": "'), F.when(
            F.col("event_id") % 5 == 0, F.lit("2024-02-31")).otherwise(F.lit("2024-02-01")), F.lit('"}')))
        .when(odd, F.lit('{"trigger_type": "other"}')).otherwise(F.lit('{"note": 1}')))
    return table(spark, root, "events").select("event_id", "ts", text.alias("event"))


TRIGGER_SQL = """
base AS (SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day, event_id % 10 = 0 AS bad FROM events),
files AS (SELECT b.*, r.name FROM base b, (VALUES ('orders'), ('lineitem')) r(name)
  WHERE event_type = 'click' AND (name = 'orders' OR event_id % 2 = 1)),
triggers AS (
  SELECT event_id, 's3' AS trigger,
    'incremental-data/' || CASE WHEN bad THEN 'not-a-date' ELSE day END || '/' || name || '/' || name || '.csv' AS object_key,
    name AS "table", CASE WHEN bad THEN NULL ELSE day END AS run_date, bad AS bad_date FROM files
  UNION ALL SELECT event_id, CASE event_type WHEN 'view' THEN 'schedule' WHEN 'signup' THEN 'historical'
      WHEN 'purchase' THEN 'direct' ELSE 'unknown' END, NULL, NULL,
    CASE WHEN event_type <> 'purchase' THEN day WHEN event_id % 5 = 0 THEN NULL ELSE '2024-02-01' END,
    event_type = 'purchase' AND event_id % 5 = 0 FROM base WHERE event_type <> 'click')
"""


@query("event_log", f"WITH {TRIGGER_SQL} SELECT * FROM triggers")
def event_log(spark, root):
    return read_events(trigger_log(spark, root), today=F.to_date("ts")).drop("ts", "event")


@query("event_log_today", """SELECT CASE event_type WHEN 'view' THEN 'schedule' WHEN 'signup' THEN 'historical' ELSE 'unknown' END AS trigger,
  strftime(current_date, '%Y-%m-%d') AS run_date, count(*) AS n FROM events WHERE coalesce(event_type, '') NOT IN ('click', 'purchase')
GROUP BY ALL""")
def event_log_today(spark, root):
    """Events that name no day belong to the day on which the log is read."""
    events = read_events(trigger_log(spark, root)).filter(F.col("run_date") >= F.date_format(F.current_date(), "yyyy-MM-dd"))
    return trigger_counts(events)


@query("split_tables", """SELECT event_type AS "table", count(*) % 2 = 0 AS has_change, 'keyed' AS part FROM events GROUP BY event_type HAVING count(*) % 2 <> 0
UNION ALL SELECT event_type, count(*) % 2 = 0, 'dated' FROM events GROUP BY event_type HAVING count(*) % 2 = 0""")
def split_tables(spark, root):
    """A catalog with a table for each kind of event, cut into those that have a change column and the rest."""
    catalog = table(spark, root, "events").groupBy(F.col("event_type").alias("table")).agg((F.count("*") % 2 == 0).alias("has_change"))
    dated, keyed = inc.split_by_change(catalog)
    return dated.withColumn("part", F.lit("dated")).unionByName(keyed.withColumn("part", F.lit("keyed")))


@query("trigger_counts", f"WITH {TRIGGER_SQL} SELECT trigger, run_date, count(*) AS n FROM triggers GROUP BY ALL")
def trigger_counts_query(spark, root):
    return trigger_counts(read_events(trigger_log(spark, root), today=F.to_date("ts")))


# --- paths --------------------------------------------------------------------------------------

def raw_paths(spark: SparkSession, root: str) -> DataFrame:
    """A listing with one path per order: some are no CSV, some do not sit deep enough."""
    key = F.col("o_orderkey")
    name = F.lower(F.substring("o_orderpriority", 3, 4))
    folder = F.concat(time_text(F.col("o_orderdate"), "yyyy-MM-dd"), F.lit("/"))
    chunk = F.concat(F.lit("chunk"), F.lpad((key % 1000).cast("string"), 4, "0"))
    suffix = F.when(key % 9 == 0, F.lit(".txt")).otherwise(F.lit(".csv"))
    inner = F.when(key % 12 == 0, F.lit("")).otherwise(F.concat(name, F.lit("/")))
    return table(spark, root, "orders").select(
        F.concat(folder, inner, name, F.lit("_"), chunk, suffix).alias("path"), key.alias("length"))


@query("file_discovery", """SELECT "table", count(*) AS files, CAST(sum(o_orderkey) AS BIGINT) AS bytes,
  count(DISTINCT run_date) AS days FROM (SELECT lower(substring(o_orderpriority, 3, 4)) AS "table", o_orderkey,
  CAST(o_orderdate AS DATE) AS run_date FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 12 <> 0) GROUP BY "table" """)
def file_discovery(spark, root):
    files = file_tables(raw_paths(spark, root))
    days = files.select("table", "run_date").distinct().groupBy("table").agg(F.count("*").alias("days"))
    return table_files(files).join(days, "table").select("table", "files", "bytes", "days")
