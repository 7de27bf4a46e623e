"""Keyed appends through the index: exact whatever the filters say, and reading as few partitions as hold keys."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmill.sinks import keyindex
from starmill.sinks.files import read_table


def batch(spark, lines):
    return spark.createDataFrame(lines, "id long, v string, day int")


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "fact")
    days = spark.range(2000).select("id", F.lit("a").alias("v"), (F.col("id") / 100).cast("int").alias("day"))
    assert keyindex.append_indexed(days, path, ["id"], partition_by=["day"]) == 2000
    return path


def test_only_partitions_that_may_hold_a_key_are_read(spark, table):
    read = lambda lines: sorted(keyindex.partitions_to_read(batch(spark, lines), table, ["id"], ["day"]))
    assert read([(5000, "x", 3)]) == [] and read([(-1, "x", None)]) == []
    assert (3,) in read([(350, "x", 9)]) and len(read([(350, "x", 9)])) <= 2
    assert {(0,), (19,)} <= set(read([(0, "x", 9), (1999, "x", 9), (7000, "x", 9)]))
    assert len(read([(0, "x", 9), (1999, "x", 9), (7000, "x", 9)])) <= 4
    assert len(read([(i * 100, "x", 0) for i in range(20)])) == 20
    assert read([(None, "x", 0)]) == []
    held = keyindex.held_rows(spark, table, [(3,), (7,)], ["day"])
    assert len(held.inputFiles()) == len([f for f in held.inputFiles() if "day=3/" in f or "day=7/" in f]) > 0 or held.count() == 200
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_appends_are_exact(spark, table):
    again = [(i, "b", 50) for i in range(0, 2000, 7)]
    new = [(i, "n", 50) for i in range(2000, 2100)] + [(2000, "twice", 51), (None, "n", None), (None, "n", 3)]
    assert keyindex.append_indexed(batch(spark, again), table, ["id"], partition_by=["day"]) == 0
    assert keyindex.append_indexed(batch(spark, again + new), table, ["id"], partition_by=["day"]) == 101
    assert keyindex.append_indexed(batch(spark, again + new), table, ["id"], partition_by=["day"]) == 0
    got = read_table(spark, table)
    assert got.count() == 2101 and got.select("id").distinct().count() == 2101
    assert rows(got.filter("v <> 'n'").groupBy("v").count()) == [("a", 2000)]
    assert keyindex.append_indexed(batch(spark, []), table, ["id"], partition_by=["day"]) == 0


def test_false_positives_cost_reads_only(spark, tmp_path, monkeypatch):
    """Filters of one bit in which every key is: each partition in range is read, and the rows are the same."""
    path = str(tmp_path / "fact")
    hashed = keyindex._hashed
    monkeypatch.setattr(keyindex, "_hashed", lambda df, keys: hashed(df, keys).withColumn("mask", F.lit(1).cast("bigint")).withColumn(
        "hash", F.lit(0).cast("bigint")))
    even = [(i, "a", i // 100) for i in range(0, 1000, 2)]
    odd = [(i, "b", i // 100) for i in range(1, 1000, 2)]
    assert keyindex.append_indexed(batch(spark, even), path, ["id"], partition_by=["day"]) == 500
    assert len(keyindex.partitions_to_read(batch(spark, odd), path, ["id"], ["day"])) == 10
    assert keyindex.append_indexed(batch(spark, odd + even), path, ["id"], partition_by=["day"]) == 500
    assert rows(read_table(spark, path).groupBy("v").count()) == [("a", 500), ("b", 500)]


def test_filters_seldom_err(spark, tmp_path):
    path = str(tmp_path / "fact")
    even = spark.range(0, 40_000, 2).select("id", F.lit("a").alias("v"), (F.col("id") % 8).cast("int").alias("day"))
    keyindex.append_indexed(even, path, ["id"], partition_by=["day"])
    words = spark.read.parquet(f"{path}/_keys/words")
    odd = keyindex._hashed(spark.range(1, 40_000, 2), ["id"]).crossJoin(words.select("size").distinct())
    odd = odd.withColumn("word", keyindex._word(F.col("size")))
    hits = odd.join(words, ["size", "word"]).filter("(bits & mask) = mask").count()
    assert hits / (20_000 * 4) < 0.05  # four days have rows


def test_a_failed_load_leaves_only_maybes(spark, table, monkeypatch):
    lines = batch(spark, [(9000, "n", 1), (9001, "n", 2)])
    monkeypatch.setattr(keyindex, "write_files", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        keyindex.append_indexed(lines, table, ["id"], partition_by=["day"])
    monkeypatch.undo()
    assert keyindex.append_indexed(lines, table, ["id"], partition_by=["day"]) == 2
    assert keyindex.append_indexed(lines, table, ["id"], partition_by=["day"]) == 0


def test_tables_without_index_or_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    batch(spark, [(1, "a", 1), (2, "a", 1)]).write.partitionBy("day").parquet(path)
    assert keyindex.append_indexed(batch(spark, [(2, "b", 2), (3, "b", 2)]), path, ["id"], partition_by=["day"]) == 1
    flat = str(tmp_path / "flat")
    pairs = spark.createDataFrame([("x", 1), ("x", 2), (None, 1), (None, 1)], "k string, n int")
    assert keyindex.append_indexed(pairs, flat, ["k", "n"]) == 3
    assert keyindex.append_indexed(pairs.union(spark.createDataFrame([("y", 1)], pairs.schema)), flat, ["k", "n"]) == 1
    assert rows(read_table(spark, flat)) == [(None, 1), ("x", 1), ("x", 2), ("y", 1)]


def test_thousands_of_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    keyindex.append_indexed(spark.range(40).selectExpr("id", "id % 4 as a", "'x' as b"), path, ["id"], partition_by=["a", "b"])
    parts = [(a, b) for a in range(3000) for b in ("x", None)]
    assert keyindex.held_rows(spark, path, parts, ["a", "b"]).count() == 40
    assert keyindex.held_rows(spark, path, [(1, "x"), (9, None)], ["a", "b"]).count() == 10
    one = str(tmp_path / "one")
    keyindex.append_indexed(spark.range(9).selectExpr("id", "nullif(id % 3, 0) as a"), one, ["id"], partition_by=["a"])
    assert keyindex.held_rows(spark, one, [(k,) for k in range(2, 5000)], ["a"]).count() == 3
    assert keyindex.held_rows(spark, one, [(None,)], ["a"]).count() == 3
    assert keyindex.append_indexed(spark.range(12).selectExpr("id", "id % 3 as a"), one, ["id"], partition_by=["a"]) == 3


def test_known_keys_cost_no_rows(spark, tmp_path, monkeypatch):
    """A load of keys that the table has is told by its keys: no row of it is built, staged or indexed."""
    path = str(tmp_path / "fact")
    lines = spark.range(3000).selectExpr("id", "id * 2 as v")
    assert keyindex.append_indexed(lines, path, ["id"], unique=True) == 3000
    never = lines.withColumn("v", F.raise_error(F.lit("built")).cast("bigint"))
    staged = []
    add = keyindex.add_to_index
    monkeypatch.setattr(keyindex, "add_to_index", lambda rows, *a: staged.append(1) or add(rows, *a))
    assert keyindex.append_indexed(never, path, ["id"], unique=True) == 0 and not staged
    assert keyindex.append_indexed(never, path, ["id"], unique=True, asked=lines.select("id").union(lines.select("id"))) == 0
    more = spark.range(2990, 3010).selectExpr("id", "-id as v")
    assert keyindex.append_indexed(more.union(more), path, ["id"]) == 10 and staged == [1]
    got = read_table(spark, path)
    assert got.count() == 3010 and got.filter("v < 0").count() == 10
    assert keyindex.append_indexed(more, path, ["id"], asked=more.select("id")) == 0


def test_a_first_load_without_index_is_indexed_later(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    lines = spark.range(40).selectExpr("id", "concat('0', id % 3) as a")
    monkeypatch.setattr(keyindex, "add_to_index", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        keyindex.append_indexed(lines, path, ["id"], partition_by=["a"])
    monkeypatch.undo()
    assert keyindex.append_indexed(spark.range(30, 44).selectExpr("id", "'01' as a"), path, ["id"], partition_by=["a"]) == 4
    assert read_table(spark, path).select("id").distinct().count() == read_table(spark, path).count() == 44
