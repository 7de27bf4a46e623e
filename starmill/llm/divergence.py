"""Source divergence audit: how far each source's term distribution lies from the others' of its language, and by which terms.

Texts become counts (lang, source, term) in bounded batches. A language keeps the terms of at least ``LEAST_DOCS`` of its documents;
ordered by how frequent they are they get ids. What a source holds is kept as one bitset of term ids for each count that occurs
in it, in words of 64 ids: terms of a high count are side by side, so few counts meet in a word. For a pair of sources, two bitsets
ANDed and popcounted give the terms of count a here and count b there; terms that only one of the two has, or neither, are the
complement. Each such cell counts as often as it has terms times the term's part in the divergence, which depends on
the two counts alone. Blocks of ``BLOCK`` ids and tiles of about ``TILE`` by ``TILE`` sources bound a task.

Arithmetic is exact: decimals and 64-bit integers in Spark, Python integers for counts in tasks.

Edge cases: null lang, source and text are read as ''; a source without terms, or a language without kept terms, still has its
pairs (value 0 where no term is kept); an id is not used, so repeated rows are documents of their own; texts of any length are cut into
words slice by slice; ties of the value are ordered by item; an empty table gives no rows; other columns are not read, so their
names can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.ranks import ranked
from starmill.llm.texts import by_bytes, keep

LEAST_DOCS = 3
SCALE = 1_000_000_000  # of the probabilities
TOP_TERMS = 200
WORD_BITS, BLOCK_BITS = 6, 12
BLOCK = 1 << BLOCK_BITS
TILE = 32
HELD = 200_000  # counts that a task holds before it passes them on
SLICE = 1 << 20

# A-Z lower-cased; every other ASCII character that is no letter separates terms.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
TILE_ROWS = "lang string, source string, other string, value bigint"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice; a slice ends between terms."""
    start = 0
    while start < len(text):
        end = start + SLICE
        while end < len(text) and FOLD[text[end]] != 32:
            end += 1
        yield text[start:end].translate(FOLD).split()
        start = end


def count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and documents of each term for each (lang, source); a group itself is a row without term."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in by_bytes(batches):
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            counts, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before, own = len(counts), set()
            for part in terms(text):
                counts.update(part)
                own.update(part)
            docs.update(own)
            held += len(counts) - before
            if held >= HELD:
                yield from _flush(groups)
                groups, held = {}, 0
    yield from _flush(groups)


def _flush(groups: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in groups.items():
        words = list(counts)
        rows = len(words) + 1
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * rows), pa.array([source] * rows), pa.array([None, *words], pa.binary()).cast(pa.string()),
            pa.array([0, *counts.values()], pa.int64()), pa.array([0, *(docs[w] for w in words)], pa.int64())], schema=PARTIAL)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences, and documents that have the term; a null term stands for the group itself."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    part = rows.mapInArrow(count_batches, "lang string, source string, term string, n bigint, docs bigint")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exact."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return _div(wide, (total + kept).cast("decimal(19,0)")) + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(p: Column, q: Column) -> Column:
    """floor((p - q) squared / q), exact: p and q are at most SCALE + 1."""
    return _div((p - q) * (p - q), q)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    counts = keep(term_counts(docs), "terms-counts")
    vocab = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    vocab = ranked(vocab.filter(F.col("docs") >= least_docs).drop("docs"), ["lang"], [F.col("lang_n").desc(), F.col("term")],
                   rank="id", rows="kept")
    kept = keep(counts.drop("docs").join(vocab, ["lang", "term"]), "terms-kept")
    groups = group_totals(counts, kept)
    out = pairs(kept, groups).withColumn("part", F.lit("pair")).unionByName(
        top(kept, groups, top_terms).withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", "value", "rank")


def group_totals(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total, kept, lang_total, sources: every group, its kept occurrences, the language's terms and sources."""
    every = counts.filter("term is null").select("lang", "source")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.max("kept").alias("kept"))
    lang = own.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("kept").alias("kept"))
    size = every.groupBy("lang").agg(F.count("*").alias("sources"))
    every = every.join(own.drop("kept"), ["lang", "source"], "left").join(lang, "lang", "left").join(size, "lang")
    return keep(every.fillna(0, ["total", "kept", "lang_total"]), "terms-groups")


def top(kept: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """lang, source, item, value, rank: the terms that a source has more of than its language."""
    rows = kept.drop("kept").join(groups, ["lang", "source"])
    rows = rows.select("lang", "source", F.col("term").alias("item"), probability(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                       probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")).filter("p > q")
    return _by_value(rows.select("lang", "source", "item", share(F.col("p"), F.col("q")).alias("value"))).filter(F.col("rank") <= most)


def _by_value(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))))


def bitsets(kept: DataFrame) -> DataFrame:
    """lang, source, n, word, bits: the terms of count n in a source, 64 ids a row."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("id") % (1 << WORD_BITS)).cast("int"))
    return kept.groupBy("lang", "source", "n", F.shiftright("id", WORD_BITS).alias("word")).agg(F.bit_or(bit).alias("bits"))


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: the divergence of each source from each other one of its language."""
    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    own = F.pmod(F.xxhash64("source"), tiles).cast("int")
    place = groups.select("lang", "source", "total", "kept", own.alias("own"), F.explode(F.transform(
        F.sequence(F.lit(0), tiles - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))).alias("tile"))
    blocks = F.sequence(F.lit(0).cast("long"), F.shiftright(F.greatest(F.col("kept") - 1, F.lit(0)), BLOCK_BITS))
    heads = place.select("lang", "tile", "own", "source", F.explode(blocks).alias("block"), F.lit(-1).cast("long").alias("word"),
                         F.col("total").alias("n"), F.col("kept").alias("bits"))
    sets = bitsets(kept).join(place.select("lang", "source", "tile", "own"), ["lang", "source"]).withColumn(
        "block", F.shiftright("word", BLOCK_BITS - WORD_BITS))
    size = BLOCK

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        return tile_values(key, rows, size)

    parts = heads.unionByName(sets).groupBy("lang", "tile", "block").applyInArrow(run, TILE_ROWS)
    return _by_value(parts.groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value")))


def tile_values(key: tuple, rows: pa.Table, most: int) -> pa.Table:
    """The part that a block of ids has in the divergence of each pair of a tile of sources."""
    lang, tile, block = (k.as_py() for k in key)
    words, ns, bits, own = (rows.column(c).to_numpy() for c in ("word", "n", "bits", "own"))
    names = rows.column("source").to_pylist()
    heads = {names[k]: int(ns[k]) for k in np.flatnonzero(words < 0)}
    tiles = dict(zip(names, own.tolist(), strict=True))
    kept = int(bits[words < 0][0])
    size = min(most, kept - block * most)
    places: dict[str, list[int]] = {name: [] for name in heads}
    for k in np.flatnonzero(words >= 0)[np.argsort(words[words >= 0], kind="stable")]:
        places[names[k]].append(k)
    sides = {name: Side(words[at], ns[at], bits[at], heads[name], kept) for name, at in places.items()}
    ordered = sorted(sides)
    out: list[tuple[str, str, int]] = []
    for a, name in enumerate(ordered):
        for other in ordered[a + 1:]:
            if (tiles[name] == tiles[other]) == (tile["i"] == tile["j"]):
                there, back = (0, 0) if kept == 0 else divergence(sides[name], sides[other], size)
                out += [(name, other, there), (other, name, back)]
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array([x[0] for x in out], pa.string()),
                     "other": pa.array([x[1] for x in out], pa.string()), "value": pa.array([x[2] for x in out], pa.int64())})


class Side:
    """A source's bitsets in a block, sorted by word, with the probability of each one's count."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, bits: np.ndarray, total: int, kept: int):
        self.words, self.bits = words, bits.view(np.uint64)  # bits of a signed number would be counted in its absolute value
        levels, at = np.unique(counts, return_inverse=True)
        chance = [1 + SCALE * (int(c) + 1) // (total + kept) for c in (0, *levels)] if kept else [1]
        self.zero = chance[0]
        self.chance = np.array(chance[1:], np.int64)[at] if len(levels) else np.zeros(0, np.int64)
        self.terms = np.bitwise_count(self.bits).astype(np.int64)


def divergence(a: Side, b: Side, size: int) -> tuple[int, int]:
    """Of a from b and of b from a, over ``size`` terms."""
    first, last = np.searchsorted(b.words, a.words, "left"), np.searchsorted(b.words, a.words, "right")
    met = last - first
    here = np.repeat(np.arange(len(met)), met)
    there = np.arange(len(here)) - np.repeat(np.cumsum(met) - met, met) + np.repeat(first, met)
    joint = np.bitwise_count(a.bits[here] & b.bits[there]).astype(np.int64)
    only_a = a.terms - np.bincount(here, joint, len(a.terms)).astype(np.int64)
    only_b = b.terms - np.bincount(there, joint, len(b.terms)).astype(np.int64)
    none = size - int(a.terms.sum()) - int(b.terms.sum()) + int(joint.sum())
    p = np.concatenate([a.chance[here], a.chance, np.full(len(b.terms), a.zero), [a.zero]])
    q = np.concatenate([b.chance[there], np.full(len(a.terms), b.zero), b.chance, [b.zero]])
    cells = np.concatenate([joint, only_a, only_b, [none]])
    p, q, cells = p[cells > 0], q[cells > 0], cells[cells > 0]
    gap = (p - q) * (p - q)
    return int((cells * (gap // q)).sum()), int((cells * (gap // p)).sum())
