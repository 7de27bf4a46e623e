"""Mixing sources to target weights by entropy balancing: each document gets a rate, rates become copies.

DataFrame functions only. Documents are first counted by (source, size), and all that follows works on these cells. Sources get
target words: shares of a budget by weight, never more than ``most`` times the source. Of all rates between 0 and ``most`` whose words
meet the target, those of highest entropy are ``most / (1 + exp(-t * size))``: odds tilted exponentially by size, one ``t`` for each
source. Newton steps on the convex dual find ``t``, all sources at once, one sum over the cells for each step; a step that leaves the
interval known to hold ``t`` is replaced by its middle. Sums are decimal, so they don't depend on the order of rows.

Rounding: a cell's copies are its documents times their rate, the fractions carried on from the largest size to the smallest,
so a source is off by one document at most; then a cell of each power of two of sizes gives or takes copies until no copy of its
size brings the words nearer. In a cell the documents of lowest hash have the extra copy.

Edge cases: a null or empty text has size 0 and takes no words; a null source is a source of its own, the last one; a null id is
an id like others; repeated rows are documents of their own and may differ by a copy; sources of size 0 have target 0; ties of the
hash are ordered by id and text; a text of any length is counted whole, and no copy is cut; an empty table gives no rows; other
columns are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.ranks import null_last, ranked
from starmill.llm.texts import keep

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
SHARE, MOST = 1.5, 2  # words of the mix against all words; copies of a document
NEAR = 1e-9  # of the target: Newton steps end when all sources are that near
STEPS = 100
EXACT = "decimal(38,9)"


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and rate of each document."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), null_last(F.col(source_col)).alias("name"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text_col).alias("text_hash"))
    rows = keep(rows, "mix-sizes")
    cells = keep(rows.groupBy("name", "size").agg(F.count("*").alias("docs")), "mix-cells")
    sources = targets(cells, weights, share, most)
    copies = keep(round_to_copies(solve(cells, sources, most), sources, most), "mix-copies")

    placed = ranked(rows, ["name", "size"], [F.xxhash64("doc_id"), F.col("doc_id"), F.col("text_hash")], rows="docs")
    copies = copies.withColumn("base", F.expr("copies div docs")).withColumn("extra", F.expr("copies % docs"))
    done = placed.drop("docs").join(copies.select("name", "size", "rate", "base", "extra"), ["name", "size"]).join(sources, "name")
    own = (F.col("base") + (F.col("rank") < F.col("extra")).cast("long")).alias("copies")
    return done.select("doc_id", "size", "source_size", "target", "rate", own).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), F.col("copies").cast("int").alias("copies"), "rate")


def targets(cells: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """name, source_size, target: the excess over ``most`` times a source is shared again until none is above."""
    sources = cells.groupBy("name").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    sources = ranked(sources.withColumn("every", F.lit(1)), ["every"], [F.col("name")])
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights)).cast("int") + 1)
    sources = keep(sources.select("name", "source_size", weight.cast("long").alias("weight"),
                                  (F.col("source_size") * most).alias("limit")), "mix-sources")
    total, free = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return sources.select("name", "source_size", F.lit(0.0).alias("target"))
    each, full = share * total / free, -1
    while True:
        above = F.col("limit") <= F.col("weight") * F.lit(each)
        words, weight_left, now = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("limit"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.count_if(above)).first()
        if now == full or not weight_left:
            break
        each, full = (share * total - words) / weight_left, now
    return keep(sources.select("name", "source_size", F.when(above, F.col("limit").cast("double")).otherwise(
        F.col("weight") * F.lit(each)).alias("target")), "mix-targets")


def solve(cells: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """The cells with the rate of their documents."""
    unit = F.sum(F.col("docs") * F.col("size") * F.col("size").cast("double")) / F.sum(F.col("docs") * F.col("size"))
    state = cells.filter("size > 0").groupBy("name").agg(F.round(unit, 3).alias("unit")).join(sources, "name").select(
        "name", "unit", "target", (F.col("target") >= most * F.col("source_size")).alias("full"), F.lit(0.0).alias("tilt"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), F.lit(False).alias("done"))
    state = keep(state, "mix-tilts")
    part = F.lit(1.0) / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("unit")))
    words = F.col("docs") * F.col("size") * most
    for _ in range(STEPS):
        sums = cells.filter("size > 0").join(state.filter("not full and not done"), "name").groupBy("name").agg(
            F.sum((words * part).cast(EXACT)).cast("double").alias("met"),
            F.sum((words * F.col("size") / F.col("unit") * part * (1 - part)).cast(EXACT)).cast("double").alias("slope"))
        state = keep(_step(state.join(sums, "name", "left")), "mix-tilts")
        if not state.filter("not full and not done").head(1):
            break
    return cells.join(state.select("name", "unit", "tilt", "full"), "name", "left").select(
        "name", "size", "docs", F.when(F.col("size") == 0, 0.0).when(F.col("full"), float(most)).otherwise(most * part).alias("rate"))


def _step(state: DataFrame) -> DataFrame:
    """One safeguarded Newton step; a source without sums stays as it is."""
    gap = F.col("met") - F.col("target")
    low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
    high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
    state = state.withColumns({"low": low, "high": high, "gap": gap, "next": F.col("tilt") - F.try_divide(gap, F.col("slope"))})
    inside = (F.col("next") > F.col("low")) & (F.col("next") < F.col("high")) & (F.abs(F.col("next")) <= 4 * F.abs(F.col("tilt")) + 4)
    middle = F.when(F.col("high") == float("inf"), 2 * F.col("tilt") + 1).when(
        F.col("low") == float("-inf"), 2 * F.col("tilt") - 1).otherwise((F.col("low") + F.col("high")) / 2)
    moved = F.when(F.coalesce(inside, F.lit(False)), F.col("next")).otherwise(middle)
    near = (F.abs(F.col("gap")) <= F.col("target") * NEAR) | (moved == F.col("tilt"))
    return state.select("name", "unit", "target", "full", F.when(F.col("gap").isNull() | near, F.col("tilt")).otherwise(moved).alias("tilt"),
                        "low", "high", (F.col("done") | F.coalesce(near, F.lit(True))).alias("done"))


def round_to_copies(cells: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """name, size, docs, rate, copies: whole copies of a cell's documents together."""
    wanted = (F.col("docs") * F.col("rate")).cast(EXACT)
    cells = cells.withColumn("whole", F.floor(wanted)).withColumn("part", wanted - F.floor(wanted))
    upto = F.sum("part").over(Window.partitionBy("name").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0))
    cells = cells.withColumn("upto", upto)
    half = F.lit(0.5).cast(EXACT)
    extra = F.floor(F.col("upto") + half) - F.floor(F.col("upto") - F.col("part") + half)
    cells = keep(cells.select("name", "size", "docs", "rate", F.least(F.col("whole") + extra, F.col("docs") * most).cast("long").alias("copies")),
                 "mix-rounded")
    return cells.join(_moves(cells, sources, most), ["name", "size"], "left").select(
        "name", "size", "docs", "rate", (F.col("copies") + F.coalesce("move", F.lit(0))).alias("copies"))


def _moves(cells: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """name, size, move: what the fullest cell of each power of two of sizes gives or takes, from the largest down."""
    bands = cells.filter("size > 0").groupBy("name", F.floor(F.log2("size")).alias("band")).agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max(F.struct("docs", "size", "copies")).alias("cell"))
    each = bands.groupBy("name").agg(F.sum("taken").alias("taken"), F.sort_array(F.collect_list(F.struct(
        F.col("cell.size").alias("size"), F.col("cell.docs").alias("docs"), F.col("cell.copies").alias("copies"))), False).alias("cells"))
    gap = F.round(F.col("target") - F.col("taken")).cast("long")
    start = F.struct(gap.alias("left"), F.array().cast("array<struct<size:bigint,move:bigint>>").alias("moves"))

    def give(done: Column, cell: Column) -> Column:
        move = F.greatest(-cell["copies"], F.least(most * cell["docs"] - cell["copies"], F.round(done["left"] / cell["size"]).cast("long")))
        return F.struct((done["left"] - move * cell["size"]).alias("left"),
                        F.concat(done["moves"], F.array(F.struct(cell["size"].alias("size"), move.alias("move")))).alias("moves"))

    moved = each.join(sources, "name").select("name", F.aggregate("cells", start, give)["moves"].alias("moves"))
    return moved.select("name", F.inline("moves")).filter("move <> 0")
