"""Records of files that are cut anywhere, chunks with other headers, and types found by values."""

import csv
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmill.operators.types import inferred_types, type_report, with_inferred_types
from starmill.plans import jobs
from starmill.sources.files import read_csv
from starmill.sources.records import column_names, numbered_lines, read_chunks, records

CELLS = ["plain", "", "a, b", 'say "hi"', "two\nlines", "three\n\nlines\n", "x\r\ny", '"', '""', '"\n"', " padded ", "é\n東京", ",", "back\\slash", "\n"]


def write(path, table, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=newline).writerows(table)


def table_of(n, seed):
    pick = random.Random(seed)
    return [["id", "a", "b"], *([str(i), pick.choice(CELLS), pick.choice(CELLS) * pick.randint(0, 3)] for i in range(n))]


@pytest.mark.parametrize(("newline", "split"), [("\n", 200), ("\n", 1000), ("\r\n", 333), ("\n", 1 << 20)])
def test_cut_files_equal_whole_files(spark, tmp_path, newline, split):
    for k in range(2):
        write(tmp_path / f"f{k}.csv", table_of(150, k), newline)
    lines = numbered_lines(spark, str(tmp_path), split_bytes=split)
    assert (lines.select("file", "split").distinct().count() > 2) == (split < 1 << 20)
    expected = [tuple(c or None for c in r) for k in range(2) for r in table_of(150, k)[1:]]
    got = read_chunks(spark, str(tmp_path), split_bytes=split)
    assert got.columns == ["id", "a", "b"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    if newline == "\n":  # the reader turns CR LF inside cells into LF
        assert rows(got) == rows(read_csv(spark, str(tmp_path)))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    write(tmp_path / "f.csv", table_of(3000, 5))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    assert session.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 3
    assert spark.read.options(header=True, multiLine=True).csv(str(tmp_path)).rdd.getNumPartitions() == 1
    assert numbered_lines(spark, str(tmp_path), split_bytes=4000).select("split").distinct().count() > 3


def test_a_record_over_many_splits(spark, tmp_path):
    long = "\n".join(["line"] * 400)
    write(tmp_path / "f.csv", [["id", "a"], ["1", long], ["2", "x"], ["3", long + '"' + long]])
    assert rows(read_chunks(spark, str(tmp_path), split_bytes=100)) == [("1", long), ("2", "x"), ("3", long + '"' + long)]


def test_single_lines_are_not_shuffled(spark, tmp_path):
    write(tmp_path / "f.csv", table_of(20, 1))
    plan = records(numbered_lines(spark, str(tmp_path))).filter("split = 0")
    assert plan.count() > 0
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ObjectHashAggregate") + text.count("SortAggregate") >= 1  # the parts only
    assert "SortMergeJoin" not in text


def test_odd_files(spark, tmp_path):
    for name, text in {"empty": "", "head": "id,a\n", "bom": "﻿id,a\n1,x\n", "open": 'id,a\n2,"never closed\nto the end', "blank": "id,a\n\n\r\n3,z\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text, newline="", encoding="utf-8")
    got = sorted(map(tuple, read_chunks(spark, str(tmp_path)).collect()))
    assert [r[0] for r in got] == ["1", "2", "3"] and got[0][1] == "x" and got[1][1].startswith("never closed")
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert read_chunks(spark, str(tmp_path / "none")).count() == 0


def test_other_headers_meet_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", [["Film ID", "title", "rate"], ["1", "A", "2.99"]])
    write(tmp_path / "b.csv", [["title", "film-id"], ["B\nb", "2"]])
    write(tmp_path / "c.csv", [["rate", "extra", "film_id", "title"], ["3", "e", "30000000000", "C"], ["", "", "4", ""]])
    got = read_chunks(spark, str(tmp_path), infer=True)
    assert got.dtypes == [("film_id", "bigint"), ("title", "string"), ("rate", "double"), ("extra", "string")]
    assert sorted(map(tuple, got.collect())) == [
        (1, "A", 2.99, None), (2, "B\nb", None, None), (4, None, None, None), (30000000000, "C", 3.0, "e")]
    assert column_names('"a ""q""",b,b') == ["a_q", "b", "b_2"]


def test_history_with_other_headers_is_cleaned(spark, tmp_path):
    for day, table in {"2024-01-01": [["category_id", "name", "last_update"], ["1", "one\nline", "2024-01-01 00:00:00"]],
                       "2024-01-02": [["last_update", "name", "category_id", "note"], ["2024-01-02 00:00:00", "two", "2", "n"],
                                      ["2024-01-03 00:00:00", "newer", "1", ""]]}.items():
        folder = tmp_path / "raw" / day / "category"
        folder.mkdir(parents=True)
        write(folder / "category_chunk0001.csv", table)
    done = jobs.clean_history(spark, str(tmp_path / "raw"), str(tmp_path / "clean"))
    assert [(o.table, o.status, o.rows) for o in done] == [("category", "written", 2)]
    got = spark.read.parquet(str(tmp_path / "clean" / "category"))
    assert {(r.category_id, r.name, r.note) for r in got.collect()} == {(1, "newer", ""), (2, "two", "n")} or \
        {(r.category_id, r.name) for r in got.collect()} == {(1, "newer"), (2, "two")}


VALUES = {
    "int": ["1", "-2", "+3", "0", "2147483647"], "bigint": ["1", "2147483648", "-9223372036854775808"],
    "decimal(21,0)": ["1", "123456789012345678901"], "double": ["1", "1e3", ".5", "2.", "-0.25"], "date": ["2024-02-29"],
    "timestamp": ["2024-02-29", "2024-02-29 10:00:00", "2024-02-29T10:00:00.5"], "boolean": ["true", "FALSE"],
    "string": ["1", "x"]}


def test_types_of_values(spark):
    n = max(map(len, VALUES.values()))
    data = [tuple(v[i] if i < len(v) else [None, ""][i % 2] for v in VALUES.values()) for i in range(n)]
    df = spark.createDataFrame(data, ", ".join(f"c{i} string" for i in range(len(VALUES))))
    assert list(inferred_types(df).values()) == list(VALUES)
    typed = with_inferred_types(df)
    assert [t for _, t in typed.dtypes] == list(VALUES)
    assert typed.filter("c2 is not null").agg(F.max("c2")).first()[0] == Decimal("123456789012345678901")


@pytest.mark.parametrize(("values", "kind"), [
    (["2024-02-30"], "string"), (["2024-01-01", "1"], "string"), (["true", "1"], "string"), ([None, ""], "string"), ([], "string"),
    (["1" * 39, "1"], "double"), (["1" * 38], "decimal(38,0)"), (["0" * 40 + "1"], "int"), (["NaN"], "string"), ([" 1"], "string"), (["1", "1.5", "99999999999"], "double")])
def test_least_type(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    if not values:
        assert inferred_types(df) == {}
    else:
        assert inferred_types(df) == {"v": kind}


def test_report_names_what_widens(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",), ("n/a",), ("-",), (None,), ("",)], "v string")
    assert type_report(df).collect() == [(1, "v", "string", 7, 2, "int", 2, "-")]


def test_types_merge_in_any_order(spark):
    values = ["5", "2024-01-01", None, "1.5", "7000000000", "x", "true"]
    for cut in range(1, len(values)):
        df = spark.createDataFrame([(v,) for v in values[cut:] + values[:cut]], "v string").repartition(3)
        assert type_report(df).collect()[0]["type"] == "string"
