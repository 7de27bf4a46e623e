import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmill import fixed
from starmill.operators.lookup import Lookup, first_link, flatten
from starmill.operators.spread import SPREAD, spread_join
from starmill.operators.star import build_star, buildable, date_dimension

AT = "2006-02-15 04:34:33"
STAMP = dt.datetime(2006, 2, 15, 4, 34, 33)


@pytest.fixture(scope="module")
def rental(spark):
    def t(schema, *lines):
        return spark.createDataFrame(list(lines), schema)

    return {
        "country": t("country_id string, country string, last_update string", ("1", "Chad", AT), ("2", "Peru", AT)),
        "city": t("city_id string, city string, country_id string, last_update string", ("1", "Lima", "2", AT), ("2", "Nowhere", "9", AT)),
        "address": t("address_id string, address string, district string, postal_code string, city_id string",
                     ("1", " 1 Road", "North", None, "1"), ("2", "2 Road", "", "12", "2"), ("3", "3 Road", "S", "3", None),
                     ("1", " 1 Road", "North", None, "1")),
        "customer": t("customer_id string, first_name string, last_name string, email string, active string, address_id string, "
                      "create_date string, last_update string",
                      ("1", "ANN", "A", "ann@x", "1", "1", AT, AT), ("2", "BOB", "B", None, None, "2", AT, AT),
                      ("3", "CAT", "C", "c", "0", "7", "bad", AT), ("4", "DAN", "D", "d", "1", None, AT, AT),
                      ("1", "ANN", "OLD", "ann@x", "1", "2", AT, "2005-01-01 00:00:00")),
        "film": t("film_id string, title string, description string, release_year string, rental_duration string, rental_rate string, "
                  "length string, rating string, language_id string, last_update string",
                  ("1", "ALIEN", "d", "2006", "3", "2.99", "90", "PG", "1", AT), ("2", "BIRDS", None, None, None, None, None, "R", "8", AT)),
        "language": t("language_id string, name string, last_update string", ("1", "English ", AT)),
        "category": t("category_id string, name string, last_update string", ("1", "Action", AT), ("2", "Horror", AT)),
        "film_category": t("film_id string, category_id string, last_update string", ("1", "2", AT), ("1", "1", AT)),
        "store": t("store_id string, manager_staff_id string, address_id string, last_update string", ("1", "1", "1", AT), ("2", "9", "3", AT)),
        "staff": t("staff_id string, first_name string, last_name string, store_id string", ("1", "Mike", "H", "1"), ("2", "Jon", "S", "2")),
        "inventory": t("inventory_id string, film_id string, store_id string", ("1", "1", "2"), ("2", "2", "1")),
        "rental": t("rental_id string, inventory_id string, customer_id string", ("1", "1", "3"), ("2", "7", "1")),
        "payment": t("payment_id string, customer_id string, staff_id string, rental_id string, amount string, payment_date string, last_update string",
                     ("1", "1", "1", "1", "2.99", "2005-05-28 10:00:00", AT), ("2", "1", "2", None, "0.99", "2005-05-28 23:00:00", AT),
                     ("3", "2", "2", "2", "4.99", "2005-06-04 00:00:00", AT), ("4", "2", "9", "8", "1", "NaT", AT),
                     ("1", "1", "1", "1", "2.99", "2005-05-28 10:00:00", AT)),
    }


def test_columns_of_the_star(rental):
    star = build_star(rental)
    assert list(star) == ["dim_customer", "dim_film", "dim_store", "dim_date", "fact_payment"]
    for name, columns in (("dim_customer", fixed.DIM_CUSTOMER), ("dim_film", fixed.DIM_FILM), ("dim_store", fixed.DIM_STORE),
                          ("dim_date", fixed.DIM_DATE), ("fact_payment", fixed.FACT_PAYMENT)):
        assert star[name].columns == list(columns)


def test_dim_customer(rental):
    out = rows(build_star(rental)["dim_customer"].drop("email", "last_update"))
    assert out == [
        (1, "ANN", "A", 1, "1 Road", "North", "", "Lima", "Peru", STAMP),
        (2, "BOB", "B", 0, "2 Road", "", "12", "Nowhere", None, STAMP),
        (3, "CAT", "C", 0, None, None, None, None, None, None),
        (4, "DAN", "D", 1, None, None, None, None, None, STAMP),
    ]


def test_dim_film(rental):
    out = rows(build_star(rental)["dim_film"])
    assert out == [(1, "ALIEN", "d", 2006, 3, Decimal("2.99"), 90, "PG", "English", "Action", STAMP),
                   (2, "BIRDS", "", 0, 0, Decimal("0.00"), 0, "R", None, None, STAMP)]


def test_dim_store(rental):
    assert rows(build_star(rental)["dim_store"]) == [
        (1, "Mike", "H", "1 Road", "Lima", "Peru", STAMP), (2, None, None, "3 Road", None, None, STAMP)]


def test_dim_date(rental):
    out = [tuple(r) for r in build_star(rental)["dim_date"].collect()]
    assert out == [
        (20050528, dt.date(2005, 5, 28), 28, 5, "May", 2, 2005, "Saturday", True),
        (20050604, dt.date(2005, 6, 4), 4, 6, "June", 2, 2005, "Saturday", True)]


def test_fact_payment(rental):
    out = rows(build_star(rental)["fact_payment"].drop("payment_date", "last_update"))
    assert out == [
        (1, 1, 1, 2, 20050528, 1, Decimal("2.99")),     # the payment's own customer, the inventory's store
        (2, 1, None, 2, 20050528, None, Decimal("0.99")),  # no rental: store of the staff
        (3, 2, None, 2, 20050604, 2, Decimal("4.99")),  # rental without inventory: store of the staff
        (4, 2, None, None, None, 8, Decimal("1.00")),   # nothing known
    ]


def test_amount_is_kept(rental):
    assert build_star(rental)["fact_payment"].agg(F.sum("amount")).first()[0] == Decimal("9.97")


def test_only_what_the_sources_allow(rental):
    some = {t: rental[t] for t in ("payment", "film", "language")}
    assert list(build_star(some)) == ["dim_date"]
    assert buildable(some)["dim_film"] == ["film_category", "category"]


def test_calendar(spark):
    days = spark.createDataFrame([(dt.datetime(2006, 2, 14, 15),), (dt.datetime(2006, 2, 14, 16),), (None,), (dt.datetime(2005, 8, 21),)], "at timestamp")
    out = [tuple(r) for r in date_dimension(days, "at").collect()]
    assert out == [(20050821, dt.date(2005, 8, 21), 21, 8, "August", 3, 2005, "Sunday", True),
                   (20060214, dt.date(2006, 2, 14), 14, 2, "February", 1, 2006, "Tuesday", False)]


def test_lookup_never_multiplies_and_reports_clashes(spark):
    base = spark.createDataFrame([(1, 5), (2, None)], "id int, k int")
    twice = spark.createDataFrame([(5, "old", 1), (5, "new", 2)], "key int, v string, last_update int")
    assert flatten(base, [Lookup(twice, {"k": "key"}, {"v": "v"})], ["id"]).select("id", "v").orderBy("id").collect() == [(1, "new"), (2, None)]
    with pytest.raises(ValueError, match="rename"):
        flatten(base, [Lookup(twice, {"k": "key"}, {"id": "v"})], ["id"])


def test_first_link(spark):
    assert rows(first_link(spark.createDataFrame([(1, 3), (1, 2), (2, None)], "f int, c int"), "f", "c")) == [(1, 2), (2, None)]


@pytest.mark.parametrize("left_type, right_type", [("int", "bigint"), ("bigint", "int"), ("string", "string"), ("decimal(10,0)", "bigint")])
def test_spread_join_equals_the_plain_join(spark, left_type, right_type):
    left = spark.range(60).select("id", F.when(F.col("id") % 4 != 0, F.col("id") % 5).cast(left_type).alias("k"))
    right = spark.range(3).select(F.col("id").cast(right_type).alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "left_anti"):
        spread = spread_join(left, right, ["k"], how, ["id"])
        plain = left.join(right, "k", how)
        assert SPREAD not in spread.columns
        assert rows(spread.select(*plain.columns)) == rows(plain)


def test_hot_and_missing_keys_are_split(spark):
    """A third of the rows has one key, a third none; the lookup has to be reduced to one row per key."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        base = spark.range(0, 300_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 1000).cast("int").alias("k"))
        table = spark.range(2000).select((F.col("id") % 1000).alias("key"), F.col("id").alias("v"), F.col("id").alias("last_update"))
        out = flatten(base, [Lookup(table, {"k": "key"}, {"v": "v"})], ["id"])
        assert out.agg(F.count("*"), F.count("v"), F.sum("v")).first() == (300_000, 200_000, 250_650_000)
        out.foreachPartition(lambda it: None)
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
