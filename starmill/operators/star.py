"""Dimensions, calendar and facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill import fixed
from starmill.functions.columns import date_id
from starmill.operators.clean import clean
from starmill.operators.dedup import latest_per_key
from starmill.operators.lookup import Lookup, first_link, flatten
from starmill.specs import TableSpec, spec_for

Tables = Mapping[str, DataFrame]


def dimension(base: DataFrame, key: str | Sequence[str], lookups: Sequence[Lookup], columns: Sequence[str],
              *, order_by: Sequence[str] = (fixed.CHANGE_COLUMN,), unique: bool = False) -> DataFrame:
    """Flattened table with one row per key.

    Rows are reduced on the base, narrowed to the columns in use and before the lookups: these keep
    the number of rows, so the result is the same and the wide rows need no shuffle of their own.
    """
    keys = [key] if isinstance(key, str) else list(key)
    links = [c for look in lookups for c in look.on]
    used = {*keys, *links, *columns, *order_by}
    rows = base.select(*[c for c in base.columns if c in used])
    rows = rows if unique else latest_per_key(rows, keys, order_by)
    return flatten(rows, lookups, keys).select(*columns)


def date_attributes(day: Column) -> dict[str, Column]:
    return {
        "date_id": date_id(day),
        "full_date": day,
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "month_name": F.date_format(day, fixed.MONTH_NAME_PATTERN),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "day_of_week": F.date_format(day, fixed.DAY_NAME_PATTERN),
        "is_weekend": F.dayofweek(day).isin(*fixed.WEEKEND),
    }


def date_dimension(df: DataFrame, column: str, *, ordered: bool = True) -> DataFrame:
    """Calendar of the days that occur in ``column``; days without a row have no entry.

    Days are made distinct first, so the attributes are computed once per day. The sort is for
    presentation and covers at most one row per day.
    """
    days = df.select(F.to_date(column).alias("d")).filter(F.col("d").isNotNull()).distinct()
    out = days.select(*[c.alias(n) for n, c in date_attributes(F.col("d")).items()])
    return out.orderBy("date_id") if ordered else out


def fact(base: DataFrame, key: str | Sequence[str], lookups: Sequence[Lookup], columns: Mapping[str, Column | str],
         *, order_by: Sequence[str] = (fixed.CHANGE_COLUMN,)) -> DataFrame:
    """Fact rows: one per key, keys of the dimensions resolved by left lookups.

    ``base`` should hold no more columns than the fact uses: all of them travel with the row and
    settle ties.
    """
    keys = [key] if isinstance(key, str) else list(key)
    wide = flatten(latest_per_key(base, keys, order_by), lookups, keys)
    return wide.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


@dataclass(frozen=True)
class Shape:
    """What a star table is built of: the base, its key, its lookups, and the columns it ends with (a mapping for a fact)."""

    base: DataFrame
    key: str
    lookups: Sequence[Lookup]
    columns: Sequence[str] | Mapping[str, Column | str]

    def build(self) -> DataFrame:
        make = fact if isinstance(self.columns, Mapping) else dimension
        return make(self.base, self.key, self.lookups, self.columns)

    def keys(self) -> DataFrame:
        """The keys that ``build`` gives, repeats included."""
        return self.base.select(self.key)


# --- the rental star ----------------------------------------------------------------------------

def _place(tables: Tables, city: str, country: str) -> Lookup:
    return Lookup(tables["city"], {"city_id": "city_id"}, {city: "city", country: country}, small=True, then=(
        Lookup(tables["country"], {"country_id": "country_id"}, {country: "country"}, small=True),))


def customer_shape(tables: Tables) -> Shape:
    address = Lookup(
        tables["address"], {"address_id": "address_id"},
        {c: c for c in ("address", "district", "postal_code", "city", "country")},
        then=(_place(tables, "city", "country"),))
    return Shape(tables["customer"], "customer_id", [address], fixed.DIM_CUSTOMER)


def film_shape(tables: Tables) -> Shape:
    language = Lookup(tables["language"], {"language_id": "language_id"}, {"language": "name"}, small=True)
    category = Lookup(
        first_link(tables["film_category"], "film_id", "category_id"), {"film_id": "film_id"},
        {"category": "category"}, unique=True,
        then=(Lookup(tables["category"], {"category_id": "category_id"}, {"category": "name"}, small=True),))
    return Shape(tables["film"], "film_id", [language, category], fixed.DIM_FILM)


def store_shape(tables: Tables) -> Shape:
    manager = Lookup(tables["staff"], {"manager_staff_id": "staff_id"},
                     {"manager_first_name": "first_name", "manager_last_name": "last_name"})
    address = Lookup(tables["address"], {"address_id": "address_id"},
                     {"store_address": "address", "store_city": "store_city", "store_country": "store_country"},
                     then=(_place(tables, "store_city", "store_country"),))
    return Shape(tables["store"], "store_id", [manager, address], fixed.DIM_STORE)


def dim_date(tables: Tables) -> DataFrame:
    return date_dimension(tables["payment"], "payment_date")


def payment_shape(tables: Tables) -> Shape:
    """One row per payment; the customer is the payment's own, the store falls back to the staff's."""
    rental = Lookup(
        tables["rental"], {"rental_id": "rental_id"}, {"film_id": "film_id", "rented_store_id": "store_id"},
        then=(Lookup(tables["inventory"], {"inventory_id": "inventory_id"},
                     {"film_id": "film_id", "store_id": "store_id"}),))
    staff = Lookup(tables["staff"], {"staff_id": "staff_id"}, {"staff_store_id": "store_id"})
    payment = tables["payment"].select(
        "payment_id", "customer_id", "staff_id", "rental_id", "amount", "payment_date", fixed.CHANGE_COLUMN)
    columns = {c: c for c in fixed.FACT_PAYMENT}
    columns["store_id"] = F.coalesce("rented_store_id", "staff_store_id")
    columns["date_id"] = date_id(F.col("payment_date"))
    return Shape(payment, "payment_id", [rental, staff], columns)


SHAPES: dict[str, Callable[[Tables], Shape]] = {
    "dim_customer": customer_shape,
    "dim_film": film_shape,
    "dim_store": store_shape,
    "fact_payment": payment_shape,
}


def build(name: str, tables: Tables) -> DataFrame:
    return dim_date(tables) if name == "dim_date" else SHAPES[name](tables).build()


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {name: partial(build, name) for name in fixed.STAR_SOURCES}


def buildable(tables: Tables) -> dict[str, list[str]]:
    """Missing sources per star table; an empty list means that it can be built."""
    return {name: [t for t in need if t not in tables] for name, need in fixed.STAR_SOURCES.items()}


def clean_registry(tables: Tables, specs: Mapping[str, TableSpec] | None = None, profile: str = "star_sources",
                   **options) -> dict[str, DataFrame]:
    """Every source cleaned once; all builders share the cleaned plans.

    Copies are left to the builders: each reduces its base and its lookups to one row per key, or
    takes a minimum or distinct days, so copies cannot change what they build.
    """
    return {name: df.transform(clean(spec_for(df, name, specs), profile, **options)) for name, df in tables.items()}


def build_star(tables: Tables, *, cleaned: bool = False, **options) -> dict[str, DataFrame]:
    """All star tables whose sources exist, dimensions first."""
    ready = {name: need for name, need in buildable(tables).items() if not need}
    needed = {t for name in ready for t in fixed.STAR_SOURCES[name]}
    sources = {t: tables[t] for t in needed}
    sources = sources if cleaned else clean_registry(sources, **options)
    return {name: BUILDERS[name](sources) for name in ready}
