"""Data-quality checks, reported as rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import is_blank, lacks_at_sign
from starmill.operators.spread import spread_join

_HASH = "__hash"


@dataclass(frozen=True)
class Check:
    """A test on one column; rows for which ``broken`` is true are violations (NULL is none)."""

    name: str
    column: str
    broken: Column


def missing(column: str) -> Check:
    return Check("missing", column, F.col(column).isNull())


def blank(column: str) -> Check:
    return Check("blank", column, is_blank(F.col(column)))


def email(column: str) -> Check:
    return Check("email", column, lacks_at_sign(F.col(column)))


def _sign(column: str) -> Column:
    """The column as a number; raw tables hold it as text, and a text that is none has no sign."""
    return F.col(column).try_cast("double")


def negative(column: str) -> Check:
    return Check("negative", column, _sign(column) < 0)


def zero(column: str) -> Check:
    return Check("zero", column, _sign(column) == 0)


def not_positive(column: str) -> Check:
    return Check("not_positive", column, _sign(column) <= 0)


def standard_checks(df: DataFrame) -> list[Check]:
    """Missing values of every column and blanks of every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return [missing(c) for c in df.columns] + [blank(c) for c in texts]


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, frames)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of their kind; NULLs are equal.

    Wide rows (with texts or arrays) are counted by their hash first. Copies have equal hashes, so a
    row whose hash occurs once is no copy and only the others are compared in full: as long as
    copies are rare, a number per row goes through the shuffle and not the row.
    """
    if not any(isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)) for f in df.schema.fields):
        return duplicate_keys(df, df.columns)
    hashed = df.withColumn(_HASH, F.xxhash64(*df.columns))
    repeated = hashed.groupBy(_HASH).agg(F.count("*").alias("n")).filter("n > 1").select(_HASH)
    return duplicate_keys(hashed.join(repeated, _HASH, "left_semi"), df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))


def _status(violations: Column) -> Column:
    return (F.when(violations.isNull(), "skipped").when(violations > 0, "failed").otherwise("passed"))


def _report(df: DataFrame, table: str, check: str, column: str) -> DataFrame:
    return df.select(F.lit(table).alias("table"), F.lit(check).alias("check"), F.lit(column).alias("column"),
                     F.col("violations").cast("bigint"), _status(F.col("violations")).alias("status"))


def check_report(df: DataFrame, table: str, checks: Sequence[Check], absent: Iterable[Check] = ()) -> DataFrame:
    """All checks of a table in one pass: each is a counter of the same aggregate."""
    counters = [F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(checks)]
    lines = [(c, F.col(f"c{i}")) for i, c in enumerate(checks)]
    lines += [(c, F.lit(None).cast("bigint")) for c in absent]
    one = df.agg(*(counters or [F.count("*").alias("rows")]))
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(c.name).alias("check"), F.lit(c.column).alias("column"),
                 n.alias("violations"), _status(n).alias("status"))
        for c, n in lines])))


@dataclass(frozen=True)
class TableChecks:
    """Checks of one table. ``key`` adds the duplicate-key count, ``copies`` the duplicate-row count."""

    df: DataFrame
    key: Sequence[str] = ()
    checks: Sequence[Check] = field(default_factory=list)
    copies: bool = True
    standard: bool = True


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the columns' values: equal for equal values, NULL and NaN included, and in practice for no others.

    Each value stands with its length, NULL as a sign of its own, so values can't run into each other.
    """
    return F.unhex(F.sha2(F.concat(*[_spelt(F.col(c), df.schema[c].dataType) for c in columns]), 256))


def _spelt(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(data_type)  # -0.0 equals 0.0
    if isinstance(data_type, T.BinaryType):
        value = F.hex(value)
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        value = F.to_json(F.struct(value.alias("x")), {"ignoreNullFields": "false"})
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


_ROWS, _KEYS = -1, -2


def findings(df: DataFrame, checks: Sequence[Check], key: Sequence[str], copies: bool) -> DataFrame:
    """set, violations: all checks of a table, its repeated rows and its repeated keys in one scan.

    Each row gives a line for its digest, one for its key's digest and one for each check it breaks; lines are counted map-side by
    (set, digest), so a check is one line a task and only the digests of distinct rows and keys are shuffled. ``set`` is the
    check's number, or ``_ROWS`` or ``_KEYS``; a set without line has no row.
    """
    line = lambda number, digest: F.struct(F.lit(number).alias("set"), digest.alias("digest"))
    none = F.lit(None).cast("binary")
    lines = [F.when(F.coalesce(c.broken, F.lit(False)), line(i, none)) for i, c in enumerate(checks)]
    if copies:
        lines.append(line(_ROWS, row_digest(df, df.columns)))
    if key:
        lines.append(line(_KEYS, row_digest(df, key)))
    rows = df.select(F.inline(F.filter(F.array(*lines), lambda x: x.isNotNull())))
    counts = rows.groupBy("set", "digest").agg(F.count("*").alias("n"))
    return counts.groupBy("set").agg(F.sum(F.when(F.col("set") < 0, F.col("n") - 1).otherwise(F.col("n"))).alias("violations"))


def quality_report(tables: Mapping[str, TableChecks], *, only_failed: bool = False) -> DataFrame:
    """One row per table and check: violations and passed, failed or skipped (column absent).

    A table costs one scan, whatever is checked (``findings``). ``only_failed`` keeps the lines that found something.
    """
    out = reduce(DataFrame.unionByName, [_table_report(name, t) for name, t in tables.items()])
    return out.filter(F.col("status") == "failed") if only_failed else out


def _table_report(name: str, t: TableChecks) -> DataFrame:
    wanted = [*(standard_checks(t.df) if t.standard else []), *t.checks]
    here = [c for c in wanted if c.column in t.df.columns]
    key = t.key if set(t.key) <= set(t.df.columns) else ()
    lines = [(here.index(c) if c in here else None, c.name, c.column) for c in wanted]
    lines += [(_ROWS, "duplicate_rows", "*")] if t.copies else []
    lines += [(_KEYS if key else None, "duplicate_key", ",".join(t.key))] if t.key else []
    if not (here or key or t.copies):
        found = t.df.sparkSession.range(1).select(F.lit(None).cast("map<int,bigint>").alias("found"))
    else:
        found = findings(t.df, here, key, t.copies).agg(F.map_from_entries(F.collect_list(F.struct("set", "violations"))).alias("found"))
    count = lambda number: (F.lit(None).cast("bigint") if number is None
                            else F.coalesce(F.try_element_at("found", F.lit(number)), F.lit(0).cast("bigint")))
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("table"), F.lit(check).alias("check"), F.lit(column).alias("column"),
                 count(number).alias("violations"), _status(count(number)).alias("status")) for number, check, column in lines])))


# --- referential checks -------------------------------------------------------------------------

def orphan_rows(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None,
                *, ignore_null: bool = False) -> DataFrame:
    """Rows of ``child`` whose key is not in ``parent``; a NULL key counts unless ignored."""
    key = F.col(parent_column or column)
    keys = parent.filter(key.isNotNull()).select(key.alias(column)).distinct()
    rows = child.filter(F.col(column).isNotNull()) if ignore_null else child
    return spread_join(rows, keys, [column], "left_anti", child.columns).select(*child.columns)


def orphan_count(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None,
                 *, ignore_null: bool = False) -> DataFrame:
    """Number of orphan rows. The child is counted per key before the join, so a hot or NULL key
    enters it as one row per task and the join sees distinct keys only."""
    rows = child.filter(F.col(column).isNotNull()) if ignore_null else child
    per_key = rows.groupBy(column).agg(F.count("*").alias("n"))
    keys = parent.select(F.col(parent_column or column).alias(column)).distinct()
    orphans = per_key.join(keys, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def referential_report(links: Sequence[tuple[str, DataFrame, DataFrame, str, str]], *,
                       ignore_null: bool = False) -> DataFrame:
    """Report lines for links ``(label, child, parent, child column, parent column)``.

    All links of a child, a frame that is the same object, cost one scan of it: its keys are stacked as (parent, key), counted
    map-side, and meet the stacked keys of the parents in one anti join. A parent's column is read once, however many links
    name it.
    """
    here = [x for x in links if x[3] in x[1].columns and x[4] in x[2].columns]
    frames = [check_report(child, label, [], [Check("orphan", column, F.lit(False))])
              for label, child, parent, column, parent_column in links if (label, child, parent, column, parent_column) not in here]
    children = list({id(x[1]): x[1] for x in here}.values())
    for child in children:
        frames.append(_orphans_of(child, [x for x in here if x[1] is child], ignore_null))
    return reduce(DataFrame.unionByName, frames)


def _orphans_of(child: DataFrame, links: Sequence[tuple], ignore_null: bool) -> DataFrame:
    kinds = [_key_kind(child.schema[x[3]].dataType, x[2].schema[x[4]].dataType) for x in links]
    parents = {(id(x[2]), x[4], kind): x[2] for x, kind in zip(links, kinds, strict=True)}
    place = {parent: i for i, parent in enumerate(parents)}
    stacked = child.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("link"), F.lit(place[id(x[2]), x[4], kind]).alias("parent"), _key_text(F.col(x[3]), kind).alias("key"))
        for k, (x, kind) in enumerate(zip(links, kinds, strict=True))])))
    if ignore_null:
        stacked = stacked.filter("key IS NOT NULL")
    per_key = stacked.groupBy("link", "parent", "key").agg(F.count("*").alias("n"))
    keys = reduce(DataFrame.unionByName, [
        frame.select(F.lit(place[i, column, kind]).alias("parent"), _key_text(F.col(column), kind).alias("key"))
        for (i, column, kind), frame in parents.items()])
    orphans = per_key.join(keys.filter("key IS NOT NULL").distinct(), ["parent", "key"], "left_anti").groupBy().pivot(
        "link", list(range(len(links)))).agg(F.sum("n"))
    count = lambda k: F.coalesce(F.col(str(k)), F.lit(0).cast("bigint"))
    return orphans.select(F.inline(F.array(*[
        F.struct(F.lit(x[0]).alias("table"), F.lit("orphan").alias("check"), F.lit(x[3]).alias("column"),
                 count(k).alias("violations"), _status(count(k)).alias("status")) for k, x in enumerate(links)])))


def _key_kind(mine: T.DataType, theirs: T.DataType) -> str:
    """How a key is spelt so that two texts are equal where the keys are."""
    if isinstance(mine, T.IntegralType) and isinstance(theirs, T.IntegralType):
        return "bigint"
    if mine != theirs and (isinstance(mine, T.NumericType) or isinstance(theirs, T.NumericType)):
        return "decimal(38,6)"
    return "double" if isinstance(mine, (T.FloatType, T.DoubleType)) else "string"


def _key_text(key: Column, kind: str) -> Column:
    value = key.try_cast(kind)
    return (value + F.lit(0.0) if kind == "double" else value).cast("string")


# --- the rental checks --------------------------------------------------------------------------

def rental_checks(tables: Mapping[str, DataFrame], *, only_failed: bool = False) -> DataFrame:
    """The full set of checks for the rental tables that are present, referential ones included."""
    rules = {
        "customer": lambda: [email("email")],
        "payment": lambda: [negative("amount"), zero("amount")],
        "film": lambda: [not_positive("rental_duration"), not_positive("replacement_cost")],
        "rental": list,
        "inventory": list,
    }
    parts = {n: TableChecks(tables[n], (f"{n}_id",), rule()) for n, rule in rules.items() if n in tables}
    report = quality_report(parts, only_failed=only_failed)
    links = [(child, tables[child], tables[parent], f"{parent}_id", f"{parent}_id")
             for child, parent in (("payment", "customer"), ("rental", "inventory"))
             if child in tables and parent in tables]
    if links:
        refs = referential_report(links)
        report = report.unionByName(refs.filter(F.col("status") == "failed") if only_failed else refs)
    return report
