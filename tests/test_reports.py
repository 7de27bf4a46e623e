import math

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.functions import quantiles
from starmill.functions.quantiles import exact_quantiles
from starmill.operators import profile
from starmill.operators import quality as q


@pytest.fixture(scope="module")
def shop(spark):
    def t(schema, *lines):
        return spark.createDataFrame(list(lines), schema)

    return {
        "customer": t("customer_id int, first_name string, email string", (1, "A", "a@x"), (2, " ", "bad"), (3, None, None), (3, "C", ""), (3, "C", "")),
        "payment": t("payment_id int, customer_id int, amount double", (1, 1, 2.0), (2, 9, -1.0), (3, None, 0.0), (4, 3, None)),
        "film": t("film_id int, rental_duration int", (1, 0), (2, 3)),
        "rental": t("rental_id int, inventory_id int", (1, 1), (2, 5)),
        "inventory": t("inventory_id int, film_id int", (1, 1), (None, 2)),
    }


def found(report):
    return {(r["table"], r["check"], r["column"]): r["violations"] for r in report.collect()}


def test_rental_checks(shop):
    out = found(q.rental_checks(shop))
    assert out["customer", "missing", "first_name"] == 1 and out["customer", "missing", "email"] == 1
    assert out["customer", "blank", "first_name"] == 1 and out["customer", "blank", "email"] == 2
    assert out["customer", "email", "email"] == 4
    assert out["customer", "duplicate_rows", "*"] == 1
    assert out["customer", "duplicate_key", "customer_id"] == 2
    assert out["payment", "negative", "amount"] == 1 and out["payment", "zero", "amount"] == 1
    assert out["film", "not_positive", "rental_duration"] == 1
    assert out["film", "not_positive", "replacement_cost"] is None  # the column does not exist
    assert out["payment", "orphan", "customer_id"] == 2             # unknown and missing customer
    assert out["rental", "orphan", "inventory_id"] == 1


def test_status_and_failures_only(shop):
    report = q.rental_checks({t: shop[t] for t in ("film",)})
    status = {(r["check"], r["column"]): r["status"] for r in report.collect()}
    assert status["not_positive", "rental_duration"] == "failed"
    assert status["not_positive", "replacement_cost"] == "skipped"
    assert status["missing", "film_id"] == "passed"
    failed = q.rental_checks(shop, only_failed=True)
    assert failed.filter("status <> 'failed'").count() == 0 and failed.filter("table = 'rental'").count() == 1


def test_one_scan_per_table_for_all_column_checks(shop):
    plan = q.check_report(shop["payment"], "payment", q.standard_checks(shop["payment"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_one_scan_for_all_checks_of_a_table(spark, tmp_path):
    lines = [(1, "a", 0.0), (1, "a", -0.0), (None, None, None), (None, None, None), (2, " ", 3.0), (2, "b", 3.0), (3, "a1", 1.0)]
    spark.createDataFrame(lines, "k int, t string, x double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = q.quality_report({"t": q.TableChecks(df, ("k",), [q.zero("x"), q.negative("gone")])})
    assert scans(report) == 1
    assert found(report) == {
        ("t", "missing", "k"): 2, ("t", "missing", "t"): 2, ("t", "missing", "x"): 2, ("t", "blank", "t"): 1, ("t", "zero", "x"): 2,
        ("t", "negative", "gone"): None, ("t", "duplicate_rows", "*"): 2, ("t", "duplicate_key", "k"): 3}
    assert set(found(q.quality_report({"t": q.TableChecks(df.limit(0), ("k",), [q.zero("x")])})).values()) == {0}
    assert found(q.quality_report({"t": q.TableChecks(df, ("none",), [], copies=False, standard=False)})) == {("t", "duplicate_key", "none"): None}


def test_digests_of_rows_tell_values_apart(spark):
    lines = [("1", "2", [1, None]), ("12", "", [1, None]), ("1", None, [1]), (None, "1", [1]), ("", "1", None), ("1", "", []),
             ("1:1", "-", []), ("-", "1:1", []), ("1", "2", [None, 1])]
    df = spark.createDataFrame(lines, "a string, b string, c array<int>")
    assert df.select(q.row_digest(df, df.columns).alias("d")).distinct().count() == len(lines)
    twice = df.union(df)
    assert found(q.quality_report({"t": q.TableChecks(twice, (), [], standard=False)})) == {("t", "duplicate_rows", "*"): len(lines)}


def test_one_scan_of_a_child_for_all_its_links(spark, tmp_path):
    spark.createDataFrame([(1, 1, 2.0), (None, 5, 9.0), (7, 1, None)], "a int, b bigint, c double").write.parquet(str(tmp_path / "c"))
    spark.createDataFrame([(1, 2), (None, 9)], "k int, m int").write.parquet(str(tmp_path / "p"))
    child, parent = spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p"))
    links = [("c", child, parent, "a", "k"), ("c", child, parent, "b", "k"), ("c", child, parent, "c", "m"), ("c", child, parent, "x", "k")]
    report = q.referential_report(links)
    assert found(report) == {("c", "orphan", "a"): 2, ("c", "orphan", "b"): 1, ("c", "orphan", "c"): 1, ("c", "orphan", "x"): None}
    assert scans(report) == 1 + 2 + 1  # the child, two columns of the parent, the absent column's line
    assert found(q.referential_report(links[:3], ignore_null=True))["c", "orphan", "a"] == 1
    assert found(q.referential_report([("p", parent.filter("k = 1"), parent, "k", "k")])) == {("p", "orphan", "k"): 0}
    assert found(q.referential_report([("p", parent.limit(0), parent, "k", "k")])) == {("p", "orphan", "k"): 0}


def test_orphans(shop):
    assert {r[0] for r in q.orphan_rows(shop["payment"], shop["customer"], "customer_id").collect()} == {2, 3}
    kept = q.orphan_rows(shop["payment"], shop["customer"], "customer_id", ignore_null=True)
    assert kept.columns == ["payment_id", "customer_id", "amount"] and kept.count() == 1
    assert q.orphan_count(shop["payment"], shop["customer"], "customer_id", ignore_null=True).first()[0] == 1
    # A NULL in the parent matches nothing.
    assert q.orphan_count(shop["rental"], shop["inventory"], "inventory_id").first()[0] == 1


def test_duplicate_rows_wide_and_narrow(spark):
    wide = spark.createDataFrame([("x" * 1000, 1), ("x" * 1000, 1), ("x" * 1000, 2), (None, None), (None, None), (None, None)], "a string, b int")
    assert q.duplicate_rows(wide).first()[0] == 3
    assert q.duplicate_rows(wide.select("b")).first()[0] == 3
    assert q.duplicate_rows(spark.createDataFrame([(0.0, "a"), (-0.0, "a")], "a double, b string")).first()[0] == 1
    assert q.duplicate_rows(wide.filter("b > 9")).first()[0] == 0


def test_row_counts_shape_and_columns(shop):
    assert rows(q.row_counts({t: shop[t] for t in ("film", "rental")})) == [("film", 2), ("rental", 2)]
    assert rows(profile.shape({"film": shop["film"]})) == [("film", 2, 2)]
    assert rows(profile.column_profile(shop["payment"], "p")) == [
        ("p", 1, "payment_id", "int", 4, 0), ("p", 2, "customer_id", "int", 4, 1), ("p", 3, "amount", "double", 4, 1)]


def test_describe_like_a_data_frame(spark):
    import pandas as pd

    values = [2.99, 4.99, 0.99, 0.99, None, 11.99, float("nan")]
    out = profile.describe(spark.createDataFrame([(v,) for v in values], "x double"), ["x"]).first()
    expected = pd.Series(values).describe()
    assert out["count"] == 5
    assert list(out)[2:] == pytest.approx([expected[k] for k in ("mean", "std", "min", "25%", "50%", "75%", "max")])


def test_describe_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert profile.describe(empty, ["x"]).first() == ("x", 0, None, None, None, None, None, None, None)
    assert profile.total_and_mean(empty, "x").first() == (0.0, None)


HARD = {
    "normal": lambda r: r.normal(size=4000),
    "one outlier": lambda r: np.append(r.random(4000), 1e18),
    "a third equal": lambda r: np.where(r.random(4000) < 0.34, 0.5, r.random(4000)),
    "all equal": lambda r: np.full(4000, 3.25),
    "two values": lambda r: r.integers(0, 2, 4001).astype(float),
    "heavy tail": lambda r: r.pareto(0.3, 4000),
    "all powers": lambda r: r.choice([-1.0, 1.0], 4000) * 2.0 ** r.integers(-1060, 1020, 4000),
    "least doubles": lambda r: r.integers(-40, 40, 4000) * 5e-324,
    "neighbours": lambda r: 1.0 + r.integers(0, 9, 4000) * 2.0 ** -52,
    "around zero": lambda r: np.append(r.normal(size=2001) * 1e-9, [0.0, -0.0] * 500),
}


@pytest.mark.parametrize("name", HARD)
def test_large_quantiles_are_exact(spark, name):
    values = HARD[name](np.random.default_rng(7))
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    got = exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.75, 1.0))["x"]
    assert got == pytest.approx(list(np.quantile(values, (0, .25, .5, .75, 1))), rel=1e-12, abs=0)


def test_quantiles_move_no_rows(spark, monkeypatch):
    """What is shuffled is a line for each digit of a column, however many rows there are."""
    seen = []
    pick = quantiles._pass
    monkeypatch.setattr(quantiles, "_pass", lambda values, digit, p: seen.append(
        values.withColumn("digit", digit).groupBy("place", "digit").count()) or pick(values, digit, p))
    df = spark.range(0, 400_000, 1, 4).select((F.col("id") % 1000 + 1).cast("double").alias("x"))
    assert exact_quantiles(df, ["x"], (0.5,)) == {"x": [500.5]}
    assert seen[0].count() <= 16 * 11
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.index("Exchange") > plan.index("HashAggregate")


def test_moments_of_many_digits_like_numpy(spark):
    values = np.random.default_rng(3).lognormal(3, 2, 5000) - 20
    out = profile.describe(spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4), ["x"]).first()
    assert [out["mean"], out["std"], out["min"], out["max"]] == pytest.approx([values.mean(), values.std(ddof=1), values.min(), values.max()])


def test_infinite_values_have_ranks(spark):
    df = spark.createDataFrame([(v,) for v in (float("inf"), float("-inf"), 1.0, 2.0, 3.0)], "x double")
    assert exact_quantiles(df, ["x"], (0.0, 0.5, 1.0)) == {"x": [float("-inf"), 2.0, float("inf")]}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([-5.0, -0.5, 0.0, 0.1, 0.2, 1e9, None]), min_size=12, max_size=60))
def test_large_quantiles_of_few_values(spark, values):
    kept = [v for v in values if v is not None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], (0.25, 0.5, 0.75))["x"]
    assert got == (pytest.approx(list(np.quantile(kept, (.25, .5, .75)))) if kept else [None] * 3)


def test_value_counts_and_sums(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", None), (None, 9.0), ("c", None)], "k string, v double")
    assert [tuple(r) for r in profile.value_counts(df, "k").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert rows(profile.group_sum(df, "k", "v")) == [("a", 1.0), ("b", 2.0), ("c", 0.0)]
    assert [tuple(r) for r in profile.top_sums(df, "k", "v", 2).collect()] == [("b", 2.0), ("a", 1.0)]
    assert [r[0] for r in profile.top_k(df, "v", ["k"], 2, ["k"]).collect()] == [None, "b"]


@pytest.mark.parametrize("values, bins", [
    ([0.0, 1.0, 2.0, 3.0, 10.0, None], 5), ([5.0, 5.0], 4), ([0.1 * i for i in range(31)], 3), ([1.0, 2.0, 3.0, 7.0], 10)])
def test_histogram_like_numpy(spark, values, bins):
    out = profile.histogram(spark.createDataFrame([(v,) for v in values], "x double"), "x", bins).orderBy("bin").collect()
    counts, edges = np.histogram([v for v in values if v is not None], bins)
    assert [r["n"] for r in out] == list(counts)
    assert [r["lower"] for r in out] == list(edges[:-1]) and out[-1]["upper"] == edges[-1]


def test_histogram_of_nothing(spark):
    assert profile.histogram(spark.createDataFrame([(math.nan,), (None,)], "x double"), "x").count() == 0


def test_top_k_keeps_only_k_per_task(spark):
    plan = profile.top_k(spark.range(100), "id", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
