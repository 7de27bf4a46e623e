"""A star refreshed by what changed is the star built anew."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_star import AT, rental  # noqa: F401

from starmill import fixed
from starmill.operators.refresh import changed_rows, refresh, touched
from starmill.operators.star import BUILDERS, SHAPES, clean_registry
from starmill.plans import jobs
from starmill.sinks.files import read_table


def changed(tables, **new):
    now = {**tables, **new}
    return now, {t: changed_rows(tables[t], df) for t, df in new.items()}


def more(df, *lines):
    return df.unionByName(df.sparkSession.createDataFrame(list(lines), df.schema))


def renamed(t):
    return {"city": t["city"].withColumn("city", F.when(F.col("city_id") == "1", "Callao").otherwise(F.col("city")))}


def moved(t):
    return {"address": t["address"].withColumn("city_id", F.when(F.col("address_id") == "2", "1").otherwise(F.col("city_id"))),
            "rental": t["rental"].withColumn("inventory_id", F.lit("2")),
            "staff": t["staff"].withColumn("store_id", F.lit("7")).withColumn("first_name", F.lit("X")),
            "payment": t["payment"].withColumn("payment_date", F.when(F.col("payment_id") == "3", "2005-09-09 00:00:00").otherwise(F.col("payment_date")))}


def added(t):
    return {"customer": more(t["customer"], ("1", "ANNA", "A", "a@x", "1", "3", AT, "2007-01-01 00:00:00"), (None, "NO", "KEY", None, None, "1", AT, AT)),
            "payment": more(t["payment"], ("9", "1", "1", "1", "1", "2005-07-01 00:00:00", AT)),
            "film_category": more(t["film_category"], ("2", "2", AT))}


def gone(t):
    return {"customer": t["customer"].filter("customer_id <> '1'"), "language": t["language"].filter("false"),
            "city": t["city"].filter("city_id = '2'"), "film_category": t["film_category"].filter("category_id = '2'"),
            "payment": t["payment"].filter("payment_id <> '3'")}


@pytest.mark.parametrize("change", [renamed, moved, added, gone])
def test_refreshed_is_rebuilt(rental, change):  # noqa: F811
    now, diff = changed(rental, **change(rental))
    before, now, diff = clean_registry(rental), clean_registry(now), clean_registry(diff)
    for star, sources in fixed.STAR_SOURCES.items():
        if set(diff) & set(sources):
            assert rows(refresh(star, BUILDERS[star](before), now, diff)) == rows(BUILDERS[star](now)), star


def test_only_reached_rows_are_built(rental):  # noqa: F811
    now, diff = changed(rental, **renamed(rental))
    now, diff = clean_registry(now), clean_registry(diff)
    all_changes = {t: diff.get(t, df.limit(0)) for t, df in now.items()}
    reach = lambda star: rows(touched(SHAPES[star](now), SHAPES[star](all_changes)))
    assert reach("dim_customer") == [(1,)] and reach("dim_store") == [(1,)]
    assert reach("dim_film") == [] and reach("fact_payment") == []


def test_dimensions_on_files(rental, tmp_path):  # noqa: F811
    target = str(tmp_path)
    jobs.load_star(rental, jobs.star_sink(target))
    now, diff = changed(rental, **renamed(rental), customer=added(rental)["customer"])
    done = {o.table: o.status for o in jobs.refresh_dimensions(now, diff, target)}
    assert done == {"dim_customer": "written", "dim_store": "written", "dim_film": "skipped", "dim_date": "skipped"}
    spark = rental["city"].sparkSession
    for star in ("dim_customer", "dim_store", "dim_film"):
        assert rows(read_table(spark, f"{target}/{star}")) == rows(BUILDERS[star](clean_registry(now)))
    fresh = str(tmp_path / "fresh")
    assert {o.status for o in jobs.refresh_dimensions(now, diff, fresh)} == {"written", "skipped"}


def test_changed_rows_are_counted_in_one_shuffle(spark, monkeypatch):
    """Rows as often as the states differ, NULLs alike, whatever a row is repeated by."""
    monkeypatch.setattr("starmill.operators.refresh.RUN", 3)
    old = spark.createDataFrame([(1, "a")] * 9 + [(2, None)] * 2 + [(None, None), (3, "c"), (4, "d")], "k int, v string")
    new = spark.createDataFrame([("a", 1)] * 2 + [(None, 2)] * 2 + [("c", 3)] + [("e", 5)] * 4, "v string, k int")
    got = changed_rows(old, new)
    assert rows(got) == rows(spark.createDataFrame([(1, "a")] * 7 + [(None, None), (4, "d")] + [(5, "e")] * 4, "k int, v string"))
    assert got.columns == ["k", "v"] and changed_rows(old, old).count() == 0
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Union") == 1


def test_rows_without_key_are_refreshed(rental):  # noqa: F811
    """A changed row without key: its old form goes, its new one comes, and no other row is lost."""
    lost = more(rental["customer"], (None, "NO", "KEY", None, None, "1", AT, AT))
    for before, after in ((rental["customer"], lost), (lost, rental["customer"]), (lost, lost.withColumn("first_name", F.lit("X")))):
        was = clean_registry({**rental, "customer": before})
        now, diff = clean_registry({**rental, "customer": after}), clean_registry({"customer": changed_rows(before, after)})
        assert rows(refresh("dim_customer", BUILDERS["dim_customer"](was), now, diff)) == rows(BUILDERS["dim_customer"](now))
