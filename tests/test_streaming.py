import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from starmill.specs import TableSpec
from starmill.streaming import contents, daily, ingest, keyed

SPEC = TableSpec("film", ("film_id",), types={"film_id": "bigint", "last_update": "timestamp"})
SCHEMA = "film_id string, title string, last_update string"


def put(root, day, name, *lines):
    folder = root / day / "film"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("film_id,title,last_update\n" + "\n".join(lines) + "\n")


def films(spark, root):
    return ingest.csv_stream(spark, str(root / "raw"), "film", SCHEMA)


def test_each_file_is_taken_once(spark, tmp_path):
    put(tmp_path / "raw", "2024-01-01", "a.csv", "1,A,2024-01-01", "2,B,2024-01-01")
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    assert ingest.ingest(films(spark, tmp_path), target, checkpoint) == 2
    assert ingest.ingest(films(spark, tmp_path), target, checkpoint) == 0
    put(tmp_path / "raw", "nowhen", "b.csv", "3,C,2024-01-02")
    assert ingest.ingest(films(spark, tmp_path), target, checkpoint) == 1
    out = spark.read.parquet(target)
    assert rows(out.select("film_id", "table", F.col("run_date").cast("string"))) == [
        ("1", "film", "2024-01-01"), ("2", "film", "2024-01-01"), ("3", "film", None)]


def test_cleaning_on_arrival(spark, tmp_path):
    put(tmp_path / "raw", "2024-01-01", "a.csv", "1, A ,2024-01-01", "1,A,2024-01-01", "2,,bad", "3,,2024-01-03")
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    ingest.clean_on_arrival(films(spark, tmp_path), SPEC, target, checkpoint)
    out = spark.read.parquet(target).select("film_id", "title", "last_update", F.col("run_date").cast("string"))
    # Row 2 holds nothing but its key and its run date.
    assert rows(out) == [(1, "A", dt.datetime(2024, 1, 1), "2024-01-01"), (3, "", dt.datetime(2024, 1, 3), "2024-01-01")]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    write = ingest.batch_writer(str(tmp_path), ["day"])
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    for batch in (0, 1, 1):
        write(df, batch)
    assert spark.read.parquet(str(tmp_path)).count() == 4


def events(spark, root):
    schema = "id int, ts timestamp, value int"
    return ingest.parquet_stream(spark, str(root / "events"), schema, max_files=1)


def put_events(spark, root, *lines):
    spark.createDataFrame(list(lines), "id int, ts timestamp, value int").coalesce(1).write.mode("append").parquet(str(root / "events"))


def T(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_latest_over_batches(spark, tmp_path):
    put_events(spark, tmp_path, (1, T(5), 10), (1, T(6), 11), (2, T(5), 20))
    put_events(spark, tmp_path, (1, T(1), 99), (2, T(5), 21), (3, T(1), 30))
    keyed.collect_latest(events(spark, tmp_path), ["id"], ["ts"], str(tmp_path / "t"), str(tmp_path / "c"))
    out = keyed.latest(spark, str(tmp_path / "t"), ["id"], ["ts"])
    assert out.count() == 3 and {r["id"]: r["value"] for r in out.collect()} | {2: None} == {1: 11, 2: None, 3: 30}


def test_first_wins_within_the_watermark(spark, tmp_path):
    put_events(spark, tmp_path, (1, T(5), 10), (1, T(5), 10), (2, T(5), 20))
    stream = keyed.first_wins(events(spark, tmp_path), ["id"], "ts")
    ingest.run_available(stream, str(tmp_path / "c"), ingest.batch_writer(str(tmp_path / "t")))
    assert rows(spark.read.parquet(str(tmp_path / "t")).select("id", "value")) == [(1, 10), (2, 20)]


def test_late_rows_still_count_in_the_daily_totals(spark, tmp_path):
    put_events(spark, tmp_path, (1, T(20), 1), (2, T(20, 5), 2))
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    daily.collect_daily(events(spark, tmp_path), "ts", "value", [], target, checkpoint)
    put_events(spark, tmp_path, (3, T(1), 4), (4, T(20), 8))
    daily.collect_daily(events(spark, tmp_path), "ts", "value", [], target, checkpoint)
    assert rows(daily.daily_totals(spark, target)) == [(dt.date(2024, 1, 1), 1, 4), (dt.date(2024, 1, 20), 3, 11)]


def test_windows_close_behind_the_watermark(spark, tmp_path):
    put_events(spark, tmp_path, (1, T(1), 1), (2, T(1, 5), 2), (3, T(2), 1), (4, T(4), 1))
    days = daily.daily_windows(events(spark, tmp_path), "ts", {"n": F.count("*"), "total": F.sum("value")})
    ingest.run_available(days, str(tmp_path / "c"), ingest.batch_writer(str(tmp_path / "t")))
    out = spark.read.parquet(str(tmp_path / "t")).select("day", "n", "total")
    assert rows(out) == [(dt.date(2024, 1, 1), 2, 3), (dt.date(2024, 1, 2), 1, 1)]


def test_open_days_are_there(spark, tmp_path):
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    measures = {"n": F.count("*"), "total": F.sum("value")}
    put_events(spark, tmp_path, (1, dt.datetime(2024, 1, 1, 9), 1), (2, dt.datetime(2024, 1, 2, 9), 2))
    daily.collect_windows(events(spark, tmp_path), "ts", measures, [], target, checkpoint)
    assert rows(daily.window_totals(spark, target)) == [(dt.date(2024, 1, 1), 1, 1), (dt.date(2024, 1, 2), 1, 2)]
    put_events(spark, tmp_path, (3, dt.datetime(2024, 1, 2, 23), 5), (4, dt.datetime(2024, 1, 9, 1), 7))
    daily.collect_windows(events(spark, tmp_path), "ts", measures, [], target, checkpoint)
    assert rows(daily.window_totals(spark, target)) == [
        (dt.date(2024, 1, 1), 1, 1), (dt.date(2024, 1, 2), 2, 7), (dt.date(2024, 1, 9), 1, 7)]


def test_contents_come_once(spark, tmp_path):
    raw, target, checkpoint, ledger = (str(tmp_path / x) for x in ("raw", "t", "c", "l"))
    load = lambda: contents.ingest_contents(films(spark, tmp_path), target, checkpoint, ledger)
    put(tmp_path / "raw", "2024-01-01", "a.csv", "1,A,2024-01-01", "2,B,2024-01-01")
    put(tmp_path / "raw", "2024-01-01", "a-again.csv", "1,A,2024-01-01", "2,B,2024-01-01")
    assert load() == 2
    put(tmp_path / "raw", "2024-01-02", "renamed.csv", "1,A,2024-01-01", "2,B,2024-01-01")
    put(tmp_path / "raw", "2024-01-02", "turned.csv", "2,B,2024-01-01", "1,A,2024-01-01")
    put(tmp_path / "raw", "2024-01-02", "more.csv", "1,A,2024-01-01", "2,B,2024-01-01", "2,B,2024-01-01")
    assert load() == 5 and load() == 0
    assert spark.read.parquet(target).count() == 7 and raw


def test_digests_do_not_depend_on_splits(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    body = "".join(f"line {k % 70},{k}\n" for k in range(4000))
    for name, text in {"a": body, "b": body, "swapped": body.replace("line 1,1\nline 2,2\n", "line 2,2\nline 1,1\n"), "less": body[:-9], "empty": ""}.items():
        (folder / f"{name}.csv").write_text(text)
    whole = {r.file.split("/")[-1]: (r.lines, r.digest) for r in contents.file_digests(spark, str(folder)).collect()}
    cut = spark.newSession()
    cut.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    cut.conf.set("spark.sql.files.openCostInBytes", 0)
    assert {r.file.split("/")[-1]: (r.lines, r.digest) for r in contents.file_digests(cut, str(folder)).collect()} == whole
    assert whole["a.csv"] == whole["b.csv"] and whole["a.csv"][0] == 4000
    assert len({whole[n][1] for n in ("a.csv", "swapped.csv", "less.csv")}) == 3


def test_a_batch_of_one_day_is_neither_gathered_nor_sorted(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw", "2024-01-01", "a.csv", "1,A,2024-01-01", "2,B,2024-01-01")
    put(tmp_path / "raw", "2024-01-01", "b.csv", "3,C,2024-01-01")
    target, checkpoint, ledger = (str(tmp_path / x) for x in ("t", "c", "l"))
    given = []
    replace = ingest.replace_partitions
    monkeypatch.setattr(ingest, "replace_partitions", lambda df, *a, **k: given.append(k["constant"]) or replace(df, *a, **k))
    assert contents.ingest_contents(films(spark, tmp_path), target, checkpoint, ledger) == 3
    put(tmp_path / "raw", "2024-01-02", "c.csv", "4,D,2024-01-01")
    put(tmp_path / "raw", "2024-01-03", "d.csv", "5,E,2024-01-01")
    put(tmp_path / "raw", "nowhen", "e.csv", "6,F,2024-01-01")
    assert contents.ingest_contents(films(spark, tmp_path), target, checkpoint, ledger) == 3
    put(tmp_path / "raw", "nowhen", "f.csv", "7,G,2024-01-01")
    assert contents.ingest_contents(films(spark, tmp_path), target, checkpoint, ledger) == 1
    assert given == [{"run_date": "2024-01-01", "batch_id": 0}, {"batch_id": 1}, {"batch_id": 2}]
    got = spark.read.parquet(target).groupBy(F.col("run_date").cast("string")).count()
    assert rows(got) == [(None, 2), ("2024-01-01", 3), ("2024-01-02", 1), ("2024-01-03", 1)]
