import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.operators.clean import clean, column_classes, drop_empty_rows, fill_defaults, rejects, tidy
from starmill.operators.dedup import dedup_counts, distinct_rows, latest_per_key
from starmill.operators.rules import CUSTOMER_RULES, FILM_RULES, PAYMENT_RULES
from starmill.specs import SOURCE_SPECS, STAR_SPECS, TableSpec, guess_spec, is_time_name

SPEC = TableSpec("t", ("id",), refs=("ref",), types={
    "id": "bigint", "ref": "bigint", "amount": "decimal(10,2)", "last_update": "timestamp"})
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def raw(spark, *lines):
    return spark.createDataFrame(list(lines), "ID string, Ref string, Name string, Amount string, `Last Update` string")


def test_tidy_types_and_blanks(spark):
    df = raw(spark, ("1", " 2 ", "  x ", " 3.456", "2024-01-01"), ("2", "x", "   ", "", "bad"), ("3", None, "\t", "NaT", "NaT"))
    out = rows(df.transform(clean(SPEC, "star", fill=False)))
    assert out == [(1, 2, "x", Decimal("3.46"), T1), (2, None, None, None, None), (3, None, "\t", None, None)]


def test_fill_spares_keys_and_times(spark):
    df = raw(spark, ("1", None, None, None, None), ("2", "5", "x", "1", "2024-01-01"))
    out = rows(df.transform(clean(SPEC, "star")))
    assert out == [(1, None, "", Decimal("0.00"), None), (2, 5, "x", Decimal("1.00"), T1)]


@pytest.mark.parametrize("type_, filled", [("int", 0), ("bigint", 0), ("smallint", 0), ("double", 0.0), ("float", 0.0),
                                           ("decimal(21,0)", Decimal(0)), ("boolean", None), ("date", None)])
def test_fill_by_type(spark, type_, filled):
    df = spark.createDataFrame([(1, None)], f"id int, x {type_}")
    assert fill_defaults(df, TableSpec("t", ("id",))).first() == (1, filled)


def test_empty_rows_go_before_the_fills(spark):
    df = raw(spark, ("1", None, "", None, "bad"), ("2", None, "x", None, None))
    assert [r[0] for r in rows(df.transform(clean(SPEC, "incremental")))] == [2]
    # In the other order the filled name and amount keep the row.
    assert [r[0] for r in rows(df.transform(clean(SPEC, "incremental", empty_after_fill=True)))] == [1, 2]
    assert [r[0] for r in rows(df.transform(clean(SPEC, "star")))] == [1, 2]


def test_empty_rows_of_time_columns_only(spark):
    df = spark.createDataFrame([(1, None), (2, T1)], "id int, last_update timestamp")
    assert rows(drop_empty_rows(df, ["id"])) == [(2, T1)]
    assert drop_empty_rows(df.select("id"), ["id"]).count() == 2


def test_profiles_and_duplicates(spark):
    lines = [("1", "1", "a", "1", "2024-01-01"), ("1", "1", "a ", "1.00", "2024-01-01"), ("1", "1", "b", "1", "2024-01-02")]
    df = raw(spark, *lines)
    assert df.transform(clean(SPEC, "incremental")).count() == 2
    assert df.transform(clean(SPEC, "star")).count() == 2
    for profile in ("historical", "warehouse"):
        assert rows(df.transform(clean(SPEC, profile))) == [(1, 1, "b", Decimal("1.00"), T2)]


def test_composite_key_keeps_its_rows(spark):
    df = spark.createDataFrame([("1", "1", "2024-01-01"), ("1", "2", "2024-01-01"), ("1", "2", "2024-01-02")],
                               "actor_id string, film_id string, last_update string")
    out = df.transform(clean(SOURCE_SPECS["film_actor"], "historical"))
    assert rows(out) == [(1, 1, T1), (1, 2, T2)]


def test_rules_and_options(spark):
    df = raw(spark, ("1", None, "None", "0", None), ("2", None, "B", "2.5", None))
    rules = (lambda d: d.filter("amount > 0"), lambda d: d.withColumn("name", F.lower("name")))
    assert rows(df.transform(clean(replace(SPEC, rules=rules), "historical"))) == [(2, None, "b", Decimal("2.50"), None)]
    assert rows(df.transform(clean(SPEC, "star", markers=["None"])))[0][2] == ""


def test_builtin_rules(spark):
    pay = spark.createDataFrame([(1, 2.555), (2, 0.0), (3, -1.0)], "payment_id int, amount double")
    assert rows(_apply(pay, PAYMENT_RULES)) == [(1, 2.56)]
    assert rows(_apply(spark.createDataFrame([("A@B",)], "email string"), CUSTOMER_RULES)) == [("a@b",)]
    assert _apply(spark.createDataFrame([(-1.0,), (0.0,)], "rental_rate double"), FILM_RULES).count() == 1
    assert _apply(pay.select("payment_id"), PAYMENT_RULES).count() == 3


def _apply(df, rules):
    for rule in rules:
        df = df.transform(rule)
    return df


def test_text_columns_with_time_like_names_survive(spark):
    assert not is_time_name("candidate_name") and not is_time_name("timezone")
    assert is_time_name("create_date") and is_time_name("last_update")
    df = spark.createDataFrame([(1, "Ann", "2024-01-01")], "id int, candidate_name string, hire_date string")
    spec = guess_spec(df, "x")
    assert spec.keys == () and guess_spec(df, "x", ("id",)).keys == ("id",) and dict(spec.types) == {"hire_date": "timestamp"}
    assert df.transform(clean(spec)).first() == (1, "Ann", T1)


def test_values_that_cannot_be_read_are_kept_apart(spark):
    pay = TableSpec("payment", ("payment_id",), types={"payment_id": "bigint", "amount": "decimal(10,2)"})
    lines = [("x1", "1.00", "a"), ("x2", "abc", "a"), ("x2", "abc", "a"), ("7", "123456789.99", "b"), ("8", "2.999", "b"),
             ("9", "", "b"), ("10", "2.50", "b"), ("11", "9" * 40, "c")]
    df = spark.createDataFrame(lines, "payment_id string, amount string, note string")
    for profile in ("historical", "incremental"):
        assert rows(df.transform(clean(pay, profile))) == [
            (None, None, "a"), (None, Decimal("1.00"), "a"), (10, Decimal("2.50"), "b"), (11, None, "c"), (7, None, "b"),
            (8, Decimal("3.00"), "b"), (9, Decimal("0.00"), "b")]
    assert {tuple(r) for r in rejects(df, pay).collect()} == {
        ("payment_id", "unread", "x1", 1), ("payment_id", "unread", "x2", 2), ("amount", "unread", "abc", 2),
        ("amount", "unread", "123456789.99", 1), ("amount", "rounded", "2.999", 1), ("amount", "unread", "9" * 40, 1)}
    only = spark.createDataFrame([("1", "oops", None)], "payment_id string, amount string, note string")
    assert only.transform(clean(pay, "historical")).count() == 1  # not an empty row
    assert rejects(spark.range(2), TableSpec("t")).count() == 0


def test_undeclared_bridge_keeps_its_rows(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1)], "a int, b int")
    for profile in ("historical", "warehouse", "incremental"):
        assert bridge.transform(clean(guess_spec(bridge, "bridge"), profile)).count() == 3


def test_column_classes(spark):
    df = spark.createDataFrame([], "id int, name string, at string, ok boolean, amount decimal(10,2)")
    spec = TableSpec("t", ("id",), types={"at": "timestamp"})
    assert column_classes(df, spec) == {"text": ["name"], "numeric": ["id", "amount"], "time": ["at"], "other": ["ok"]}


def test_specs():
    assert len(SOURCE_SPECS) == 16
    assert STAR_SPECS["fact_payment"].mode == "append" and STAR_SPECS["dim_film"].mode == "overwrite"


def test_latest_has_a_repeatable_survivor(spark):
    data = [(1, "b", T1), (1, "a", T1), (1, "z", None), (2, None, None), (2, "c", None), (None, "n", T1), (None, "m", T2)]
    df = spark.createDataFrame(data, "id int, name string, last_update timestamp")
    expected = [(None, "m", T2), (1, "a", T1), (2, "c", None)]
    for shuffled in (df, df.repartition(3), df.orderBy(F.desc("name"))):
        assert rows(latest_per_key(shuffled, ["id"], ["last_update"])) == expected


def test_latest_of_keys_only(spark):
    assert rows(latest_per_key(spark.createDataFrame([(1,), (1,), (2,)], "id int"), ["id"])) == [(1,), (2,)]


def test_exact_dedup_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "id int, name string")
    assert rows(distinct_rows(df)) == [(1, None), (1, "x")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("id"), F.col("id").alias("last_update"))
    plan = latest_per_key(df, ["id"], ["last_update"])._jdf.queryExecution().executedPlan().toString()
    exchange, partial = plan.index("Exchange hashpartitioning"), plan.rindex("Partial")
    assert exchange < partial  # plans print the later step first


def test_dedup_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (None, None)], "id int, name string")
    assert dedup_counts(df, ["id"]).first() == (5, 4, 3, 1, 1)
    assert dedup_counts(df.filter("id > 9"), ["id"]).first() == (0, 0, 0, 0, 0)


CELL = st.sampled_from(["1", " 1", "2", "", "  ", "x", "bad", "2024-01-01", None])
NUMBER = st.sampled_from(["1", " 1", "2", "", "  ", None])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(st.tuples(NUMBER, NUMBER, CELL, NUMBER, CELL), min_size=1, max_size=12),
       profile=st.sampled_from(["incremental", "historical", "star"]))
def test_cleaning_twice_changes_nothing(spark, lines, profile):
    """Numbers that cannot be read are left out: the second time they are just missing."""
    once = raw(spark, *lines).transform(clean(SPEC, profile))
    assert rows(once.transform(clean(SPEC, profile))) == rows(once)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(st.tuples(CELL, CELL, CELL, CELL, CELL), min_size=1, max_size=12))
def test_leaving_out_exact_dedup_before_key_dedup_changes_nothing(spark, lines):
    tidied = tidy(raw(spark, *lines).toDF("id", "ref", "name", "amount", "last_update"), SPEC)
    direct = latest_per_key(tidied, SPEC.keys, SPEC.order_by)
    assert rows(direct) == rows(latest_per_key(distinct_rows(tidied), SPEC.keys, SPEC.order_by))
