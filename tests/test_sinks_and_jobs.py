import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmill.plans import jobs
from starmill.session import work_folder
from starmill.sinks import files, jdbc
from starmill.sinks.report import LoadFailed, Outcome, attempt, finish, report, run_tables
from starmill.sources.files import discover_files, read_csv, read_parquet_registry, read_registry, table_names, union_chunks
from starmill.specs import STAR_SPECS


def test_rows_written_are_counted_in_the_write(spark, tmp_path):
    assert files.write_files(spark.range(10), str(tmp_path / "a")) == 10
    assert files.write_files(spark.range(10).filter("id > 99"), str(tmp_path / "b")) == 0
    assert files.write_files(spark.range(10).filter("false"), str(tmp_path / "c")) == 0
    assert files.write_files(spark.createDataFrame([], "id int"), str(tmp_path / "d")) == 0
    assert files.write_files(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path / "e")) == 7


def test_replace_partitions_touches_only_its_own(spark, tmp_path):
    path = str(tmp_path)
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    files.replace_partitions(one, path, ["day"])
    assert files.replace_partitions(spark.createDataFrame([(3, "b")], "id int, day string"), path, ["day"]) == 1
    assert files.replace_partitions(one.filter("id > 9"), path, ["day"]) == 0
    assert rows(spark.read.parquet(path)) == [(1, "a"), (3, "b")]


def test_hot_partition_is_split(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 5)).alias("day"),
                                              F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500KB")
    try:
        files.replace_partitions(df, str(tmp_path), ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "day=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path)).count() == 200_000


def test_replace_table_keeps_old_rows_when_empty(spark, tmp_path):
    path = str(tmp_path)
    files.replace_table(spark.range(3), path)
    assert files.replace_table(spark.range(5).filter("id > 9"), path) == 0
    assert rows(files.read_table(spark, path)) == [(0,), (1,), (2,)]
    files.replace_table(spark.range(1), path)
    assert rows(files.read_table(spark, path)) == [(0,)]
    assert files.read_table(spark, str(tmp_path / "none")) is None


def test_append_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path)
    batch = spark.createDataFrame([(1, 20240101), (2, 20240102), (None, None)], "id int, day int")
    for expected in (3, 0):
        assert files.append_new(batch, path, ["id"], partition_by=["day"]) == expected
    more = batch.union(spark.createDataFrame([(3, 20240102), (3, 20240103), (1, None), (2, 20240401)], "id int, day int"))
    assert files.append_new(more, path, ["id"], partition_by=["day"]) == 1
    assert spark.read.parquet(path).count() == 4
    new = files.new_rows(more, files.read_table(spark, path), ["id"])
    assert new.count() == 0
    assert files.append_new(batch, str(tmp_path / "x"), ["id"]) == 3


def test_chunks_have_a_row_limit(spark, tmp_path):
    df = spark.range(25).select("id", F.lit(dt.datetime(2024, 1, 1)).alias("last_update"))
    files.write_chunks(df, str(tmp_path), "last_update", chunk=10)
    assert len(list((tmp_path / "run_date=2024-01-01").glob("*.csv"))) >= 3


def test_csv_keeps_every_text(spark, tmp_path):
    texts = ["a, b", 'say "hi"', "two\nlines", " padded ", "back\\slash", "é", None, "tab\t", '"', "x\r\ny"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    files.write_files(df, str(tmp_path / "t"), fmt="csv")
    assert rows(read_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)
    files.write_files(spark.createDataFrame([(1, "")], df.schema), str(tmp_path / "e"), fmt="csv")
    assert rows(read_csv(spark, str(tmp_path / "e"), df.schema)) == [(1, None)]


def test_increments_of_one_day_stay_apart(spark, tmp_path):
    for run, n in (("a", 2), ("b", 3), ("a", 1)):
        files.write_increment(spark.range(n), str(tmp_path), "2024-01-01", run, fmt="parquet")
    assert rows(spark.read.parquet(str(tmp_path)).groupBy("run_id").count()) == [("a", 1), ("b", 3)]


def test_union_chunks(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2)], "name string, id int")
    c = spark.createDataFrame([(3,)], "id int")
    assert rows(union_chunks([a, b, c])) == [(1, "x"), (2, "y"), (3, None)]


def test_jdbc_options_and_modes():
    options = jdbc.jdbc_options("jdbc:x", "s.t", {"batchsize": "5", "user": "u"})
    assert options["dbtable"] == "s.t" and options["batchsize"] == "5" and options["truncate"] == "true"


def test_empty_frame_does_not_reach_a_replaced_warehouse_table(spark):
    # No connection is opened, because the emptiness is known before the write.
    assert jdbc.write_spec_jdbc(spark.createDataFrame([], "film_id int"), STAR_SPECS["dim_film"], "jdbc:none:", "star") == "empty"


def test_outcomes(spark):
    def boom():
        raise ValueError("no")

    out = run_tables({"a": lambda: 3, "b": lambda: 0, "c": boom}, workers=2)
    assert [(o.table, o.status, o.rows) for o in out] == [("a", "written", 3), ("b", "empty", 0), ("c", "failed", 0)]
    assert out[2].error == "no" and attempt("a", lambda: 1).status == "written"
    assert {r["status"] for r in report(spark, out).collect()} == {"written", "empty", "failed"}
    with pytest.raises(LoadFailed, match="c"):
        finish(out)
    assert finish([Outcome("a", "skipped"), Outcome("b", "empty")])


def test_work_folder_follows_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    assert root is None or folder.startswith(root)


# --- jobs over a raw zone -------------------------------------------------------------------------

AT = "2006-02-15 04:34:33"
RAW = {
    "country": "Country ID,country,last_update\n1,Chad,{at}\n2,\"Peru, Rep.\",{at}\n",
    "city": "city_id,city,country_id,last_update\n1, Lima ,2,{at}\n",
    "address": "address_id,address,district,postal_code,city_id\n1,1 Road,N,,1\n",
    "customer": "customer_id,first_name,last_name,email,active,address_id,create_date,last_update\n"
                "1,ANN,A,a@x,1,1,{at},{at}\n1,ANN,A,a@x,1,1,{at},{at}\n2,BOB,B,,,,NaT,{at}\n",
    "payment": "payment_id,customer_id,staff_id,rental_id,amount,payment_date,last_update\n"
               "1,1,1,1,2.99,2005-05-28 10:00:00,{at}\n2,2,1,,0.99,2005-05-29 10:00:00,{at}\n",
    "rental": "rental_id,inventory_id,customer_id\n1,1,1\n",
    "inventory": "inventory_id,film_id,store_id\n1,7,2\n",
    "staff": "staff_id,first_name,last_name,store_id\n1,Mike,H,1\n",
    "extra": "code,value,note,seen_date\nx,1,a,2024-01-01\ny,,b,bad\nz,,,\n",
}


@pytest.fixture
def zone(tmp_path):
    for table, text in RAW.items():
        folder = tmp_path / "raw" / "2024-06-14" / table
        folder.mkdir(parents=True)
        (folder / f"{table}.csv").write_text(text.replace("{at}", AT), encoding="utf-8")
    return tmp_path


def test_rows_in_and_out_are_logged(spark, zone, caplog):
    caplog.set_level("INFO", logger="starmill")
    jobs.clean_day(spark, str(zone / "raw"), str(zone / "clean"), "2024-06-14")
    assert "table customer: 3 rows in, 2 out" in caplog.messages
    assert "table extra: 3 rows in, 2 out" in caplog.messages


def test_clean_day_is_repeatable(spark, zone):
    target = str(zone / "clean")
    for _ in range(2):
        out = {o.table: (o.status, o.rows) for o in jobs.clean_day(spark, str(zone / "raw"), target, "2024-06-14")}
    assert out["customer"] == ("written", 2) and set(out) == set(RAW)
    day = read_parquet_registry(spark, target, ["customer"], "2024-06-14")["customer"]
    assert day.count() == 2 and "run_date" not in day.columns
    country = spark.read.parquet(f"{target}/country")
    assert rows(country.select("country_id", "country")) == [(1, "Chad"), (2, "Peru, Rep.")]
    extra = spark.read.parquet(f"{target}/extra").orderBy("code").collect()
    assert [(r["code"], r["value"], r["seen_date"]) for r in extra] == [("x", 1, dt.datetime(2024, 1, 1)), ("y", 0, None)]


def test_history_reads_all_days_and_keeps_the_newest(spark, zone):
    later = zone / "raw" / "no-date" / "city"
    later.mkdir(parents=True)
    (later / "city_chunk0001.csv").write_text("city_id,city,country_id,last_update\n1,Lima II,2,2020-01-01 00:00:00\n2,Cusco,2,\n")
    jobs.clean_history(spark, str(zone / "raw"), str(zone / "clean"))
    assert rows(files.read_table(spark, str(zone / "clean/city")).select("city_id", "city")) == [(1, "Lima II"), (2, "Cusco")]


def test_warehouse_load_is_repeatable(spark, zone):
    sink = jobs.file_warehouse(str(zone / "wh"), "2024-06-14")
    for _ in range(2):
        jobs.load_day(spark, str(zone / "raw"), "2024-06-14", sink)
    assert spark.read.parquet(str(zone / "wh/customer")).count() == 2


def test_star_day(spark, zone):
    for fresh in (2, 0):
        out = {o.table: (o.status, o.rows) for o in jobs.star_day(spark, str(zone / "raw"), jobs.star_sink(str(zone / "star")), "2024-06-14")}
        assert out["fact_payment"] == (("written", fresh) if fresh else ("empty", 0))
    assert out["dim_customer"] == ("written", 2) and out["dim_film"][0] == "skipped" and out["dim_store"][0] == "skipped"
    fact = spark.read.parquet(str(zone / "star/fact_payment"))
    assert rows(fact.select("payment_id", "film_id", "store_id", "amount")) == [(1, 7, 2, Decimal("2.99")), (2, None, 1, Decimal("0.99"))]
    assert fact.agg(F.sum("amount")).first()[0] == Decimal("3.98")


def test_one_bad_table_does_not_stop_the_others(spark, zone):
    (zone / "raw/2024-06-14/city/second.csv").write_text("city,city_id,country_id,last_update\nx,2,2,\n")
    with pytest.raises(LoadFailed) as failure:
        jobs.clean_day(spark, str(zone / "raw"), str(zone / "clean"), "2024-06-14")
    status = {o.table: o.status for o in failure.value.outcomes}
    assert status.pop("city") == "failed" and set(status.values()) == {"written"}


def test_own_layout_can_be_read_back(spark, zone):
    df = spark.createDataFrame([(1, "a", "2024-01-01 00:00:00"), (2, "b", None)], "film_id int, title string, last_update string")
    files.write_chunks(df, str(zone / "own/film"), "last_update")
    files.write_increment(df.limit(1), str(zone / "inc/film"), "2024-01-05", "run-1")
    assert table_names(discover_files(spark, str(zone / "own"), layout="hive")) == ["film"]
    assert rows(read_registry(spark, str(zone / "own"), layout="hive")["film"].select("film_id")) == [("1",), ("2",)]
    day = read_registry(spark, str(zone / "own"), "2024-01-01", layout="hive", views=True)
    assert day["film"].columns == ["film_id", "title", "last_update"] and spark.table("film").count() == 1
    assert read_registry(spark, str(zone / "inc"), "2024-01-05", layout="hive")["film"].count() == 1


def test_command_line(spark, zone, capsys):
    from starmill.__main__ import parser, run

    def call(*words):
        return run(spark, parser().parse_args(list(words)))

    raw, day = str(zone / "raw"), ["--run-date", "2024-06-14"]
    assert {o.status for o in call("clean-day", "--raw", raw, "--target", str(zone / "c"), *day)} == {"written"}
    assert {o.table for o in call("load-day", "--raw", raw, "--target", str(zone / "w"), *day)} == set(RAW)
    assert any(o.table == "fact_payment" and o.rows == 2 for o in call("star-day", "--raw", raw, "--target", str(zone / "s"), *day))
    found = {(r["table"], r["check"]): r["violations"] for r in call("quality", "--raw", raw, *day).collect()}
    assert found["customer", "duplicate_rows"] == 1 and found["payment", "orphan"] == 0
    assert {r["column"]: r["type"] for r in call("types", "--raw", raw, *day, "--table", "extra").collect()} == {
        "code": "string", "value": "int", "note": "string", "seen_date": "string"}
    assert {o.status for o in call("clean-day", "--raw", raw, "--target", str(zone / "m"), *day, "--mixed", "yes")} == {"written"}
    assert call("profile", "--raw", raw, *day, "--table", "payment", "--column", "amount").first()["count"] == 2
