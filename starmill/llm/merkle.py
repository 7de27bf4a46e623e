"""Merkle manifest of a dataset: a tree of digests for each group, a tree over the groups, and a proof for each row.

DataFrame functions only. Rows get their rank within the group. Its three lowest digits to base 8 are grouped away one after the
other within a block of 512 rows: each step nests the children of a run as an array of structs and adds the run's digest. All
steps of a block share one shuffle. The blocks' digests are the next round's rows, so rounds grow with the logarithm of the
rows; the groups' digests are in turn the rows of one more tree. Going down again, the nested structs of a block are
transformed into (child, digests before it, digests after it) and exploded, level by level, so proofs need no join; a block and the
path above it meet as the two rows of a group.

Edge cases: null fields are ``-``; a null group is a group of its own and comes first; rows whose id is null come first; ties of the
id are ordered by digest, equal rows are leaves of their own; an empty text is ``0:``; texts of any length are digested whole, once,
and never shuffled; an empty table gives no rows; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.ranks import null_first, ranked
from starmill.llm.texts import keep

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_BITS, DEPTH = 3, 3  # runs of 8; levels of a block
FAN, BLOCK_BITS = 1 << FAN_BITS, FAN_BITS * DEPTH
PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(**changed: Column) -> Column:
    """The digest of a row of documents; ``changed`` replaces fields."""
    return digest(*(field(changed.get(c, F.col(c))) for c in FIELDS))


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str, carry: Sequence[str] = ()) -> DataFrame:
    """The ``carry`` columns of each row with leaf, subroot, root and path (digests before and after, from the leaf upwards)."""
    bodies = F.struct(*(F.col(c) for c in carry), F.lit(1).alias("one"))
    leaves = keep(rows.select(null_first(F.col(group)).alias("grp"), F.col(leaf).alias("digest"), bodies.alias("body")), "merkle-leaves")
    leaves = ranked(leaves, ["grp"], [*(F.col(f"body.{c}") if c in carry else F.col(c) for c in order), F.col("digest")])
    rounds, tops = climb(leaves)
    whole = tops.select(F.lit("").alias("grp"), "digest", F.struct(F.col("grp").alias("name")).alias("body"))
    above, root = climb(ranked(whole, ["grp"], [F.col("body.name")]))
    root = root.select("grp", F.lit(0).cast("long").alias("rank"), F.array().cast(PATH).alias("path"),
                       F.lit("").alias("subroot"), F.col("digest").alias("root"))
    groups = descend(above, root).select(F.col("body.name").alias("grp"), F.lit(0).cast("long").alias("rank"), "path",
                                         F.col("digest").alias("subroot"), "root")
    found = descend(rounds, keep(groups, "merkle-groups"))
    return found.select(*(F.col(f"body.{c}").alias(c) for c in carry), F.col("digest").alias("leaf"), "subroot", "root", "path")


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks from the bottom up, and the last digest of each group (grp, digest).

    ``nodes``: grp, rank, rows (of the group), digest, body.
    """
    rounds = []
    while True:
        blocks = keep(roll_up(nodes), "merkle-blocks")
        rounds.append(blocks)
        most = blocks.agg(F.max("rows")).first()[0]
        if most is None or most <= 1 << BLOCK_BITS:
            return rounds, blocks.select("grp", "digest")
        nodes = blocks.select(
            "grp", F.col("block").alias("rank"), F.shiftright(F.col("rows") + ((1 << BLOCK_BITS) - 1), BLOCK_BITS).alias("rows"),
            "digest", F.struct(F.lit(1).alias("one")).alias("body"))


def _levels(rows: Column, level: int) -> Column:
    """Whether nodes of that level (0: leaves) are still several, so that their runs are digested."""
    return rows > (1 << (FAN_BITS * level))


def roll_up(nodes: DataFrame) -> DataFrame:
    """grp, rows, block, digest, children: a row for each 512 nodes, the tree nested in it."""
    digits = [(F.shiftright("rank", FAN_BITS * k) % FAN).cast("int").alias(f"d{k}") for k in range(DEPTH)]
    rows = nodes.select("grp", "rows", F.shiftright("rank", BLOCK_BITS).alias("block"), *digits[1:],
                        F.struct(digits[0].alias("place"), "digest", "body").alias("node")).repartition("grp", "block")
    for level in range(DEPTH):
        left = [f"d{k}" for k in range(DEPTH - 1, level, -1)]
        runs = rows.groupBy("grp", "rows", "block", *left).agg(F.sort_array(F.collect_list("node")).alias("children"))
        joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        value = F.when(_levels(F.col("rows"), level), F.sha2(joined, 256)).otherwise(F.col("children")[0]["digest"]).alias("digest")
        if left:
            rows = runs.select("grp", "rows", "block", *left[:-1], F.struct(F.col(left[-1]).alias("place"), value, "children").alias("node"))
        else:
            rows = runs.select("grp", "rows", "block", value, "children")
    return rows


def descend(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The rows below: grp, rank, digest, body, path, subroot, root. ``paths``: grp, rank, path, subroot, root of the tops."""
    for blocks in reversed(rounds):
        kinds = dict(blocks.dtypes)
        above = paths.select("grp", F.col("rank").alias("block"), F.lit(None).cast("long").alias("rows"),
                             F.lit(None).cast(kinds["children"]).alias("children"), "path", "subroot", "root")
        trees = blocks.select("grp", "block", "rows", "children", F.lit(None).cast(PATH).alias("path"),
                              F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"))
        met = trees.unionByName(above).groupBy("grp", "block").agg(
            *(F.first(c, ignorenulls=True).alias(c) for c in ("rows", "children", "path", "subroot", "root")))
        paths = open_up(met)
    return paths


def open_up(blocks: DataFrame) -> DataFrame:
    rows = blocks.select("grp", F.col("block").alias("rank"), "rows", "children", "path", "subroot", "root")
    for level in reversed(range(DEPTH)):
        child = F.col("side")["child"]
        step = F.when(_levels(F.col("rows"), level), F.array(F.struct(
            F.col("side")["before"].alias("before"), F.col("side")["after"].alias("after")))).otherwise(F.array().cast(PATH))
        rest = [child["children"].alias("children")] if level else [child["digest"].alias("digest"), child["body"].alias("body")]
        rows = rows.withColumn("side", F.explode(sides(F.col("children")))).select(
            "grp", "rows", (F.shiftleft("rank", FAN_BITS) + child["place"]).alias("rank"), *rest,
            F.concat(step, F.col("path")).alias("path"), "subroot", "root")
    return rows


def sides(children: Column) -> Column:
    """Each child with the digests before and after it in its run."""
    digests = F.transform(children, lambda c: c["digest"])
    return F.transform(children, lambda c, i: F.struct(
        c.alias("child"), F.array_join(F.slice(digests, F.lit(1), i), "").alias("before"),
        F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "").alias("after")))


def proof(path: Column) -> Column:
    """Digest of all siblings, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda done, p: F.sha2(F.concat(p["before"], done, p["after"]), 256))
