"""Left lookups that flatten a snowflake of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill import fixed
from starmill.operators.dedup import latest_per_key
from starmill.operators.spread import spread_join


@dataclass(frozen=True)
class Lookup:
    """One lookup table.

    ``on`` maps columns of the base to key columns of ``table``; ``take`` maps output names to its
    columns, which also renames an attribute that would clash. ``then`` holds lookups that start from
    this table: they are joined to it first, so a large base is shuffled once per lookup of its own
    and not once per level of the snowflake. ``unique`` states that the key is unique in the data;
    without it the newest row per key is taken, so a lookup never multiplies rows. ``small`` states
    that the table is far below the broadcast size by its nature (countries, categories), so there is
    nothing to spread; it does not force a broadcast.
    """

    table: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str]
    then: Sequence["Lookup"] = ()
    unique: bool = False
    small: bool = False
    order_by: Sequence[str] = (fixed.CHANGE_COLUMN,)

    def rows(self) -> DataFrame:
        """Key columns under the names of the base, and the taken columns."""
        links = [c for look in self.then for c in look.on]
        own = [c for c in self.take.values() if c in self.table.columns]
        order = [c for c in self.order_by if c in self.table.columns]
        needed = dict.fromkeys([*self.on.values(), *own, *links, *(() if self.unique else order)])
        table = self.table.select(*needed)
        if not self.unique:
            table = latest_per_key(table, list(self.on.values()), order)
        # A row without a key cannot match anything.
        for key in self.on.values():
            table = table.filter(F.col(key).isNotNull())
        return flatten(table, self.then, list(self.on.values())).select(
            *[F.col(key).alias(base) for base, key in self.on.items()],
            *[F.col(src).alias(out) for out, src in self.take.items()],
        )


def flatten(base: DataFrame, lookups: Sequence[Lookup], spread_by: Sequence[str]) -> DataFrame:
    """``base`` with the taken columns of every lookup, one output row per base row.

    No join strategy is forced: Spark broadcasts a side whose size it knows to be small (from the
    files, or from the finished shuffle at run time) and otherwise sorts and merges. Then rows of the
    base that lack the key are spread by ``spread_by``, best the key of the base, and hot keys are
    split (``spread_join``).
    """
    for look in lookups:
        keys, rows = list(look.on), look.rows()
        clash = set(base.columns) & set(look.take) - set(keys)
        if clash:
            raise ValueError(f"lookup columns already exist: {sorted(clash)}; rename them in take")
        if look.small:
            base = base.join(rows, on=keys, how="left")
        else:
            base = spread_join(base, rows, keys, "left", spread_by)
    return base


def first_link(bridge: DataFrame, key: str, target: str) -> DataFrame:
    """Many-to-many bridge reduced to the smallest target per key, aggregated before its shuffle."""
    return bridge.groupBy(key).agg(F.min(target).alias(target))
