"""Declarative descriptions of tables: keys, types, change order and rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starmill import fixed

Rule = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """What the cleaners, builders and sinks need to know about one table.

    ``types`` maps a column to a Spark type name; only listed columns are cast. ``keys`` is the whole
    primary key, so bridge tables keep all their rows. ``refs`` are foreign keys: like the primary
    key they are never filled with a default.
    """

    name: str
    keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = (fixed.CHANGE_COLUMN,)
    refs: tuple[str, ...] = ()
    types: Mapping[str, str] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    names: tuple[str, ...] = ()  # columns that name a row without being its key: no default, no content of their own

    @property
    def mode(self) -> str:
        """Facts accumulate, everything else is replaced."""
        return "append" if self.name.startswith(fixed.FACT_PREFIX) else "overwrite"

    @property
    def unfilled(self) -> frozenset[str]:
        return frozenset(self.keys) | frozenset(self.refs) | frozenset(self.names)


def is_time_name(column: str) -> bool:
    """True when one whole part of the name is a time word (``candidate`` and ``timezone`` are not)."""
    return any(part in fixed.TIME_WORDS for part in column.split("_"))


def guess_spec(df: DataFrame, name: str, keys: tuple[str, ...] | None = None) -> TableSpec:
    """Spec for a table nobody described: text time columns are parsed, the first column names a row. Without
    a declared key no rows are merged by key, so that a bridge table keeps all of them."""
    types = {f.name: "timestamp" for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and is_time_name(f.name)}
    return TableSpec(name, keys=keys or (), types=types, names=() if keys else tuple(df.columns[:1]))


_STAMP = {fixed.CHANGE_COLUMN: "timestamp"}
_MONEY = "decimal(10,2)"


def _spec(name: str, keys: str, refs: str = "", **types: str) -> TableSpec:
    ids = {c: "bigint" for c in (*keys.split(), *refs.split())}
    return TableSpec(name, tuple(keys.split()), refs=tuple(refs.split()), types={**ids, **_STAMP, **types})


SOURCE_SPECS: dict[str, TableSpec] = {s.name: s for s in (
    _spec("actor", "actor_id"),
    _spec("address", "address_id", "city_id"),
    _spec("category", "category_id"),
    _spec("city", "city_id", "country_id"),
    _spec("country", "country_id"),
    _spec("customer", "customer_id", "store_id address_id", active="int", create_date="timestamp"),
    _spec("film", "film_id", "language_id original_language_id", release_year="int",
          rental_duration="int", rental_rate=_MONEY, length="int", replacement_cost=_MONEY),
    _spec("film_actor", "actor_id film_id"),
    _spec("film_category", "film_id category_id"),
    _spec("film_text", "film_id"),
    _spec("inventory", "inventory_id", "film_id store_id"),
    _spec("language", "language_id"),
    _spec("payment", "payment_id", "customer_id staff_id rental_id", amount=_MONEY,
          payment_date="timestamp"),
    _spec("rental", "rental_id", "inventory_id customer_id staff_id", rental_date="timestamp",
          return_date="timestamp"),
    _spec("staff", "staff_id", "address_id store_id"),
    _spec("store", "store_id", "manager_staff_id address_id"),
)}

STAR_SPECS: dict[str, TableSpec] = {s.name: s for s in (
    TableSpec("dim_customer", ("customer_id",)),
    TableSpec("dim_film", ("film_id",)),
    TableSpec("dim_store", ("store_id",)),
    TableSpec("dim_date", ("date_id",)),
    TableSpec("fact_payment", ("payment_id",), refs=("customer_id", "film_id", "store_id", "date_id", "rental_id")),
)}


def spec_for(df: DataFrame, name: str, specs: Mapping[str, TableSpec] | None = None) -> TableSpec:
    known = SOURCE_SPECS if specs is None else specs
    return known[name] if name in known else guess_spec(df, name)
