import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmill.operators import increment as inc
from starmill.operators.trigger import read_events, trigger_counts
from starmill.plans.extract import Journal, extract_history, extract_increment, history_manifest
from starmill.sinks.report import LoadFailed
from starmill.sources.catalog import FrameSource, has_column, list_tables, spark_tables
from starmill.sources.files import discover_files, read_csv, table_glob, table_names
from starmill.sources.jdbc import JdbcSource, build_catalog, key_options

DAY = dt.datetime


def source(spark, extra=()):
    film = [(1, "A", DAY(2024, 1, 1, 5)), (2, "B", DAY(2024, 1, 2)), (3, "C", None), *extra]
    return FrameSource(spark, {
        "film": spark.createDataFrame(film, "film_id int, title string, last_update timestamp"),
        "rental": spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "rental_id int, customer_id int"),
        "link": spark.createDataFrame([(1, 1), (1, 2)], "a int, b int"),
        "note": spark.createDataFrame([("x",)], "text string"),
        "void": spark.createDataFrame([], "void_id int"),
    }, {"film": ("film_id",), "rental": ("rental_id",), "link": ("a", "b"), "void": ("void_id",)})


def test_plan(spark):
    plan = {r["table"]: (r["strategy"], r["in_increment"]) for r in inc.plan_extract(source(spark).catalog()).collect()}
    assert plan == {"film": ("date", True), "link": ("full", True), "note": ("full", False), "rental": ("key", True), "void": ("key", True)}
    timed, others = inc.split_by_change(source(spark).catalog())
    assert [r[0] for r in timed.collect()] == ["film"] and others.count() == 4


def test_key_ranges(spark):
    frames = source(spark).frames
    out = rows(inc.key_ranges({"rental": (frames["rental"], "rental_id"), "void": (frames["void"], "void_id")}, chunk=2))
    assert out == [("rental", 3, 1, 3, 2), ("void", 0, None, 0, 0)]
    assert rows(inc.bootstrap_state({"void": (frames["void"], "void_id")})) == [("void", 0, True)]


def test_marks(spark):
    rental = source(spark).frames["rental"]
    new = inc.key_increment(rental, "rental_id", 1)
    assert inc.written_mark(new, "rental", "rental_id", 1).first() == ("rental", 3, True)
    assert inc.written_mark(new.filter("false"), "rental", "rental_id", 1).first() == ("rental", 1, True)
    log = spark.createDataFrame([("a", 5, True), ("a", 9, False), ("b", 0, True)], inc.STATE_SCHEMA)
    assert rows(inc.current_state(log)) == [("a", 9, True), ("b", 0, True)]


def test_ledger(spark):
    log = spark.createDataFrame([
        ("a", "error", 0, None, "boom", 1.0, DAY(2024, 1, 1)), ("a", "done", 7, 3, None, 2.0, DAY(2024, 1, 2)),
        ("b", "error", 0, None, "boom", 1.0, DAY(2024, 1, 2))], inc.LEDGER_SCHEMA)
    now = inc.current_ledger(log)
    assert {r["table"]: (r["status"], r["rows_uploaded"]) for r in now.collect()} == {"a": ("done", 7), "b": ("error", 0)}
    units = spark.createDataFrame([("a",), ("b",), ("c",)], "table string")
    assert rows(inc.work_list(units, now)) == [("b",), ("c",)]
    assert inc.ledger_totals(now).first() == (2, 1, 1, 7, 3.0)


def test_manifest(spark):
    film = source(spark, [(4, "D", DAY(2024, 1, 1, 6)), (5, "E", DAY(2024, 1, 1, 7))]).frames["film"]
    assert rows(inc.load_manifest(film, "film", "last_update", 2)) == [
        ("film", "2024-01-01", 3, 2), ("film", "2024-01-02", 1, 1), ("film", "no-date", 1, 1)]
    assert rows(inc.load_manifest(film, "film", "absent", 2)) == [("film", "no-date", 5, 3)]


def test_dry_run_writes_nothing(spark):
    out = rows(history_manifest(source(spark), chunk=2).select("table", "run_date", "rows", "files"))
    assert ("film", "2024-01-01", 1, 1) in out and ("rental", "no-date", 3, 2) in out and len(out) == 6


def test_history_then_increments(spark, tmp_path):
    target, journal = str(tmp_path / "raw"), Journal(spark, str(tmp_path / "journal"))
    out = {o.table: (o.status, o.rows) for o in extract_history(source(spark), target, journal, chunk=2)}
    assert out == {"film": ("written", 3), "link": ("written", 2), "note": ("written", 1), "rental": ("written", 3), "void": ("empty", 0)}
    assert {p.name for p in (tmp_path / "raw" / "film").iterdir() if p.is_dir()} == {
        "run_date=2024-01-01", "run_date=2024-01-02", "run_date=no-date"}
    assert {p.name for p in (tmp_path / "raw" / "rental").iterdir() if p.is_dir()} == {"run_date=no-date"}
    assert rows(journal.state()) == [("rental", 3, True), ("void", 0, True)]
    # Everything is done, so a second run has no work.
    assert extract_history(source(spark), target, journal) == []

    # The history seeded the marks: the increment starts right away.
    grown = source(spark, [(4, "D", DAY(2024, 1, 3, 9))])
    grown.frames["rental"] = grown.frames["rental"].union(spark.createDataFrame([(4, 8)], "rental_id int, customer_id int"))
    inc_target = str(tmp_path / "inc")
    out = {o.table: (o.status, o.rows) for o in extract_increment(grown, inc_target, journal, "2024-01-03")}
    # The last day of the history is read again, for rows that came late.
    assert out == {"film": ("written", 2), "link": ("written", 2), "note": ("skipped", 0), "rental": ("written", 1), "void": ("empty", 0)}
    assert rows(journal.state()) == [("rental", 4, True), ("void", 0, True)]
    # Same day again: the late film is read again beside the first run, rental has nothing new.
    out = {o.table: (o.status, o.rows) for o in extract_increment(grown, inc_target, journal, "2024-01-03")}
    assert out["film"] == ("written", 1) and out["rental"] == ("empty", 0)
    # Two days later: the missed day is caught up.
    later = source(spark, [(5, "E", DAY(2024, 1, 4)), (6, "F", DAY(2024, 1, 5, 23)), (7, "G", DAY(2024, 1, 6))])
    out = {o.table: (o.status, o.rows) for o in extract_increment(later, inc_target, journal, "2024-01-05")}
    assert out["film"] == ("written", 2)


def test_late_and_skipped_days_without_keyed_tables(spark, tmp_path):
    """History on day 1, increments on days 4 and 5; rows come late on days 1 and 4, day 2 has no run."""
    came = {1: [(1, DAY(2024, 1, 1, 3))], 4: [(2, DAY(2024, 1, 1, 4)), (3, DAY(2024, 1, 2)), (4, DAY(2024, 1, 4))],
            5: [(5, DAY(2024, 1, 4, 9)), (6, DAY(2024, 1, 5))]}
    journal, seen = Journal(spark, str(tmp_path / "journal")), []
    for day, new in came.items():
        seen += new
        frame = spark.createDataFrame(seen, "id int, last_update timestamp")
        now = FrameSource(spark, {"visit": frame})
        if day == 1:
            extract_history(now, str(tmp_path / "raw"), journal, fmt="parquet")
        else:
            extract_increment(now, str(tmp_path / "raw"), journal, f"2024-01-0{day}", fmt="parquet")
    loaded = spark.read.schema("id int").option("recursiveFileLookup", "true").parquet(str(tmp_path / "raw"))
    assert rows(loaded.distinct()) == [(i,) for i in range(1, 7)]


def test_bootstrap_loads_nothing(spark, tmp_path):
    journal = Journal(spark, str(tmp_path / "journal"))
    out = extract_increment(source(spark), str(tmp_path / "inc"), journal, "2024-01-01")
    assert {o.status for o in out} == {"skipped"} and not (tmp_path / "inc").exists()
    assert rows(journal.state()) == [("rental", 3, True), ("void", 0, True)]


def test_from_zero_loads_all_keys(spark, tmp_path):
    journal = Journal(spark, str(tmp_path / "journal"))
    out = extract_increment(source(spark), str(tmp_path / "inc"), journal, "2024-01-01", from_zero=True)
    assert {o.table: o.rows for o in out}["rental"] == 3


def test_a_failed_table_is_reported_and_tried_again(spark, tmp_path):
    bad = source(spark)
    bad.frames["rental"] = bad.frames["rental"].withColumn("customer_id", F.raise_error(F.lit("broken")).cast("int"))
    journal = Journal(spark, str(tmp_path / "journal"))
    with pytest.raises(LoadFailed) as failure:
        extract_history(bad, str(tmp_path / "raw"), journal)
    assert {o.table for o in failure.value.outcomes if o.status == "failed"} == {"rental"}
    assert {o.table for o in failure.value.outcomes if o.status == "written"} == {"film", "link", "note"}
    assert rows(journal.state()) == [("void", 0, True)]  # no mark without a good write
    assert [o.table for o in extract_history(source(spark), str(tmp_path / "raw"), journal)] == ["rental"]


# --- sources ------------------------------------------------------------------------------------

def write_zone(root, *files):
    for path, text in files:
        file = root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text, encoding="utf-8")


def test_discovery(spark, tmp_path):
    write_zone(tmp_path / "zone", ("2024-01-01/film/film.csv", "a\n1\n"), ("2024-01-02/film/film_chunk0001.csv", "a\n2\n"),
               ("2024-01-02/zone/zone.csv", "a\n2\n"), ("2024-01-02/readme.csv", "x"), ("2024-01-02/film/film.txt", "x"),
               ("no-date/note/note.csv", "a\n3\n"))
    files = discover_files(spark, str(tmp_path / "zone"))
    assert rows(files.select("table", "run_date")) == [
        ("film", "2024-01-01"), ("film", "2024-01-02"), ("note", "no-date"), ("zone", "2024-01-02")]
    assert table_names(files) == ["film", "note", "zone"]
    assert table_names(discover_files(spark, str(tmp_path / "zone"), "2024-01-01")) == ["film"]
    both = read_csv(spark, table_glob(str(tmp_path / "zone"), "film"))
    assert rows(both) == [("1",), ("2",)]


def test_csv_dialect(spark, tmp_path):
    write_zone(tmp_path, ("t.csv", 'id,text\n1,"a, b"\n2,"say ""hi"""\n3,"two\nlines"\n4,\n5,""\n'))
    assert rows(read_csv(spark, str(tmp_path / "t.csv"))) == [
        ("1", "a, b"), ("2", 'say "hi"'), ("3", "two\nlines"), ("4", None), ("5", None)]
    assert dict(read_csv(spark, str(tmp_path / "t.csv"), infer=True).dtypes)["id"] == "int"


def test_other_header_raises(spark, tmp_path):
    write_zone(tmp_path, ("a.csv", "id,name\n1,x\n"), ("b.csv", "name,id\ny,2\n"))
    with pytest.raises(Exception, match="header"):
        read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "id string, name string").collect()


def test_spark_catalog(spark):
    spark.sql("DROP TABLE IF EXISTS starmill_probe")
    spark.range(3).withColumn("last_update", F.current_timestamp()).write.saveAsTable("starmill_probe")
    try:
        assert "starmill_probe" in list_tables(spark)
        assert has_column(spark.table("starmill_probe"), "last_update") and not has_column(spark.table("starmill_probe"), "x")
        plan = inc.plan_extract(spark_tables(spark).catalog()).filter("table = 'starmill_probe'").first()
        assert plan["strategy"] == "date"
    finally:
        spark.sql("DROP TABLE starmill_probe")


# --- relational source: everything but the connection ---------------------------------------------

def test_jdbc_text(spark):
    db = JdbcSource(spark, "jdbc:x", "shop", {"user": "u", "password": "secret"}, quote="`")
    assert "secret" not in repr(db)
    assert db.table("a`b") == "`shop`.`a``b`"
    assert db.text("o'clock") == "'o''clock'"
    assert db.day_predicates("at", {"2024-01-01": 5}) == [
        "`at` IS NULL", "`at` >= DATE '2024-01-01' AND `at` < DATE '2024-01-01' + INTERVAL '1' DAY"]
    heavy = db.day_predicates("at", {"2024-01-01": 25, None: 11}, key="id", chunk=10)
    assert len(heavy) == 5 and all("MOD(`id`, " in p for p in heavy)
    assert db.key_range_sql("t", "id") == (
        "SELECT COUNT(*) AS row_count, MIN(`id`) AS min_id, COALESCE(MAX(`id`), 0) AS max_id FROM `shop`.`t`")
    assert db.day_counts_sql("t", "at") == (
        "SELECT CAST(`at` AS DATE) AS day_of_row, COUNT(*) AS row_count FROM `shop`.`t` GROUP BY CAST(`at` AS DATE)")
    assert "PRIMARY KEY" in db.keys_sql() and "'shop'" in db.tables_sql() and "'shop'" in db.columns_sql()


def test_key_partitions():
    assert key_options("id", 0, None, 0) == {} and key_options("id", 10, 1, 10, 10) == {}
    assert key_options("id", 25, 1, 25, 10) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "26", "numPartitions": "3"}


def test_catalog_rows(spark):
    tables = spark.createDataFrame([("b",), ("a",), ("c",)], "table string")
    columns = spark.createDataFrame([("a", "Last_Update"), ("a", "id"), ("b", "x")], "table string, column string")
    keys = spark.createDataFrame([("b", "k2", 2), ("b", "k1", 1), ("a", "id", 1)], "table string, column string, position int")
    assert [tuple(r) for r in build_catalog(tables, columns, keys).collect()] == [
        ("a", ["id"], True), ("b", ["k1", "k2"], False), ("c", [], False)]


# --- triggers -------------------------------------------------------------------------------------

EVENTS = {
    '{"Records":[{"eventSource":"aws:s3","s3":{"object":{"key":"incremental-data/2024-06-14/film/film.csv"}}}]}':
        [("s3", "film", "2024-06-14", False)],
    '{"Records":[{"eventSource":"aws:s3","s3":{"object":{"key":"z/2024-06-14/a/a.csv"}}},{"eventSource":"aws:s3","s3":{"object":{"key":"z/2024-06-15/b/b.csv"}}}]}':
        [("s3", "a", "2024-06-14", False), ("s3", "b", "2024-06-15", False)],
    '{"run_date":"2024-01-01","Records":[{"eventSource":"aws:s3","s3":{"object":{"key":"z/2024-06-14/a/a.csv"}}}]}':
        [("s3", "a", "2024-01-01", False)],
    '{"Records":[{"eventSource":"aws:s3","s3":{"object":{"key":"z/nowhen/a/a.csv"}}}]}': [("s3", "a", None, True)],
    '{"Records":[{"eventSource":"aws:s3","s3":{"object":{"key":"lonely.csv"}}}]}': [("s3", None, "2030-01-01", False)],
    '{"Records":[{"eventSource":"other"}]}': [("unknown", None, "2030-01-01", False)],
    '{"Records":[]}': [("unknown", None, "2030-01-01", False)],
    '{"source":"aws.events","detail-type":"Scheduled Event"}': [("schedule", None, "2030-01-01", False)],
    '{"source":"aws.events","detail-type":"HISTORICAL load"}': [("historical", None, "2030-01-01", False)],
    '{"source":"aws.events"}': [("schedule", None, "2030-01-01", False)],
    '{"trigger_type":"direct","run_date":"2024-02-30"}': [("direct", None, None, True)],
    '{"trigger_type":"historical"}': [("historical", None, "2030-01-01", False)],
    '{"trigger_type":"anything"}': [("unknown", None, "2030-01-01", False)],
    'not json': [("unknown", None, "2030-01-01", False)],
}


def test_events(spark):
    log = spark.createDataFrame([(t,) for t in EVENTS], "event string")
    out = read_events(log, today=F.lit("2030-01-01").cast("date"))
    got = {}
    for r in out.orderBy("object_key").collect():
        got.setdefault(r["event"], []).append((r["trigger"], r["table"], r["run_date"], r["bad_date"]))
    assert got == EVENTS
    assert trigger_counts(out).filter("trigger = 'unknown'").first()["n"] == 4
