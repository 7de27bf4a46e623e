"""Document fingerprints by a randomised edit embedding.

All documents share one random walk: at step ``j`` the walk stands on a character; a random bit of (j, character) says
whether it goes on to the next character, another random bit is the output. Two texts at a small edit distance fall into step
again soon after each edit, so their outputs have a small Hamming distance. Of the output every 2^level-th bit is kept, so many
levels up that at most about 512 are left; the bits of a higher level are among those of a lower one, so texts of
different lengths compare on the coarser. The likeness is 1 less twice the share of differing bits, 0 at least: about the share of the text that
is alike, near 0 for unrelated texts.

The walk advances all documents of a batch by a step at a time; whole texts take part.

Edge cases: a null or empty text has an empty fingerprint, likeness 1 to another empty one and 0 to all others; equal texts have
equal fingerprints; ids that repeat are ordered by the hash of their texts, rows that repeat id and text are one document in the order of
documents and a row each in results; a row without id comes first in the order; a single document is its own next; texts of any
length take part whole; an empty table gives no rows; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm import parity_join
from starmill.llm.components import connected
from starmill.llm.texts import by_bytes, id_and_text, keep, strings
from starmill.operators.spread import spread_join

SAMPLES = 512
MOST_SAMPLES = 1024
PERIOD = 8192  # steps after which the random bits repeat
BATCH_BYTES = 24 << 20
PART_CHARS = 128 << 20
BANDS, BAND_BITS = 24, 14
BLOCK = 2048  # rows of a bucket that are held at once
ACROSS = 352  # bits from which a near text may be a level up: those begin at about 512 of this one
NO_ID = -(1 << 63)

_bits = np.random.Generator(np.random.PCG64(20))
MOVES = _bits.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
OUTPUT = _bits.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
MOVES[:, 0], OUTPUT[:, 0] = 0, 2  # behind the end the walk stands still
RANGES = [16]  # numbers of bits that bands are drawn from: each band of a range sees the whole text
while RANGES[-1] < MOST_SAMPLES * 8 // 7 + 1:
    RANGES.append(-(-RANGES[-1] * 4 // 3))
SAMPLED = np.stack([[_bits.choice(r, BAND_BITS, replace=False) for _ in range(BANDS)] for r in RANGES])
DIGITS = 3 ** np.arange(BAND_BITS, dtype=np.int64)


def classes_of(text: str) -> np.ndarray:
    """Code points as one of 255 classes; 0 is the end."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    mixed = (points * np.uint32(2654435761)) >> np.uint32(24)
    return np.maximum(mixed, 1).astype(np.uint8)


def level_of(n: int) -> int:
    """How often the steps of a text of ``n`` characters are halved."""
    return max(0, (2 * n - 1) // SAMPLES).bit_length()


def walk(codes: list[np.ndarray]) -> list[np.ndarray]:
    """Kept output bits of each text."""
    order = sorted(range(len(codes)), key=lambda i: len(codes[i]))
    flat = np.concatenate([x for i in order for x in (codes[i], np.zeros(1, np.uint8))] or [np.zeros(1, np.uint8)])
    sizes = np.array([len(codes[i]) + 1 for i in order], np.int64)
    at = np.cumsum(sizes) - sizes
    levels = np.array([level_of(len(codes[i])) for i in order], np.int64)
    kept = np.full((len(order), MOST_SAMPLES), 2, np.uint8)
    spans = {int(v): (int(np.searchsorted(levels, v)), int(np.searchsorted(levels, v, "right"))) for v in set(levels)}
    here = np.empty(len(order), np.uint8)
    go = np.empty(len(order), np.uint8)
    low, step = 0, 0
    while low < len(order):
        x, moves = here[low:], go[low:]
        np.take(flat, at[low:], out=x, mode="clip")
        output = OUTPUT[step % PERIOD]
        for level, (start, end) in spans.items():
            if step & ((1 << level) - 1) == 0 and end > low and step >> level < MOST_SAMPLES:
                start = max(start, low)
                kept[start:end, step >> level] = output[here[start:end]]
        np.take(MOVES[step % PERIOD], x, out=moves, mode="clip")
        np.add(at[low:], moves, out=at[low:], casting="unsafe")
        if step & 31 == 0:
            live = np.flatnonzero(x)
            low = low + int(live[0]) if len(live) else len(order)
            spans = {v: s for v, s in spans.items() if s[1] > low}
        step += 1
    out: list[np.ndarray] = [np.empty(0, np.uint8)] * len(order)
    ends = np.argmax(kept == 2, axis=1)
    ends[(kept != 2).all(axis=1)] = MOST_SAMPLES
    for row, i in enumerate(order):
        out[i] = kept[row, :ends[row]]
    return out


def fingerprints(texts: list[str]) -> list[str]:
    """level.samples.bits (hexadecimal) of each text."""
    return [f"{level_of(len(t)):x}.{len(bits):x}.{np.packbits(bits).tobytes().hex()}"
            for t, bits in zip(texts, walk([classes_of(t) for t in texts]))]


def parse(fingerprint: str) -> tuple[int, np.ndarray]:
    level, n, bits = fingerprint.split(".")
    return int(level, 16), np.unpackbits(np.frombuffer(bytes.fromhex(bits), np.uint8))[:int(n, 16)]


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    (la, x), (lb, y) = parse(a), parse(b)
    x, y = x[::1 << max(0, lb - la)], y[::1 << max(0, la - lb)]
    both = min(len(x), len(y))
    if not both:
        return 0.0
    same = int((x[:both] == y[:both]).sum())
    return max(0.0, 2.0 * same / max(len(x), len(y)) - 1.0)


def bands(fingerprint: str) -> list[int]:
    """Bucket keys: bits sampled over the whole fingerprint at its level and, if near ones can be there, at the next coarser one.

    The range drawn from is the first that holds all bits, and the next too if a text of likeness 0.75 (up to 8/7 as many bits) can
    need it; places behind the end read 2. So near texts share a range, and the places of a level nest in those of the finer.
    """
    level, bits = parse(fingerprint)
    out = []
    for up in (0, 1) if len(bits) >= ACROSS else (0,):
        seen = bits[::1 << up]
        first, last = (bisect_left(RANGES, n) for n in (len(seen), len(seen) * 8 // 7))
        for at in range(first, last + 1):
            padded = np.concatenate((seen, np.full(RANGES[at] - len(seen), 2, np.uint8)))
            place = ((level + up) * len(RANGES) + at) * BANDS + np.arange(BANDS)
            out += (padded[SAMPLED[at]] @ DIGITS + place * 3 ** BAND_BITS).tolist()
    return out


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, k, h: k and h order the documents."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .withColumn("k", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("h", F.xxhash64("text"))


def first_of_parts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """k and h of the first document of each part of the order; the parts' number is that of the shuffle, or more for very
    many characters. Only ids, hashes and lengths are dealt out, a row for each part comes to the driver."""
    spark = docs.sparkSession
    keys = keep(docs.select("k", "h", F.char_length("text").alias("n")), "edit-keys")
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_CHARS))
    found = keys.repartitionByRange(parts, "k").groupBy(F.spark_partition_id()).agg(F.min(F.struct("k", "h")).alias("low"))
    firsts = sorted((r.low.k, r.low.h) for r in found.collect())
    return tuple(np.array(x, np.int64) for x in (zip(*firsts) if firsts else ((), ())))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` dealt to the parts in order, part by part sorted; the first document of a part also stands behind the part before."""
    first_k, first_h = first_of_parts(docs)
    parts = max(1, len(first_k))

    @F.pandas_udf("array<int>")
    def places(k: pd.Series, h: pd.Series) -> pd.Series:
        part = np.searchsorted(first_k, k.to_numpy(), "right") - 1
        first = (first_k[part] == k.to_numpy()) & (first_h[part] == h.to_numpy())
        return pd.Series([[p, parts + (p - 1) % parts] if f else [p] for p, f in zip(part.tolist(), first.tolist())])

    dealt = docs.withColumn("place", F.explode(places("k", "h")))
    dealt = dealt.withColumn("part", F.col("place") % parts).withColumn("behind", F.col("place") >= parts)
    return dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "behind", "k", "h").select(
        "doc_id", "text", "k", "h", "part", "behind")


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    and the numbers of shared bands, near_edited_bands and near_next_bands.

    The edited text ends with the beginning of the next document in place of its last quarter. Texts are shuffled once, and
    then read in order.
    """

    def lines(held: list[tuple[str, list]]):
        """A line for each row of all documents of ``held`` but the last, which only follows."""
        texts = [t for t, _ in held]
        edits = []
        for text, after in zip(texts, texts[1:]):
            cut = len(text) // 4
            edits.append(text[:len(text) - cut] + after[:cut])
        prints = fingerprints(texts + edits)
        keys = [set(bands(p)) for p in prints]
        for i, (text, ids) in enumerate(held[:-1]):
            e = len(texts) + i
            line = (len(text), hashlib.sha256(edits[i].encode()).hexdigest(), prints[i], prints[e],
                    likeness(prints[i], prints[e]), likeness(prints[i], prints[i + 1]),
                    len(keys[i] & keys[e]), len(keys[i] & keys[i + 1]))
            for doc_id in ids:
                yield doc_id, *line

    def run(batches):
        held: list[tuple[str, list]] = []  # documents of a part, with the ids of their rows
        last = None
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            out = []
            k, h, part, behind, ids = (batch.column(c).to_pylist() for c in ("k", "h", "part", "behind", "doc_id"))
            for doc_id, text, *key in zip(ids, strings(batch.column("text")), part, behind, k, h):
                if key == last:
                    if not key[1]:
                        held[-1][1].append(doc_id)
                    continue
                if last and key[0] != last[0]:  # another part begins
                    out += lines(held)
                    held = []
                if not (last and key[:2] == [*last[:1], True] and last[1]):  # of those behind the first is the next one
                    held.append((text, [] if key[1] else [doc_id]))
                last = key
            out += lines(held)
            held = held[-1:]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), fields)], schema=fields)

    fields = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                        ("near_edited_bands", pa.int64()), ("near_next_bands", pa.int64())])
    return with_next(in_order(docs, id_col, text_col)).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
             "near_next double, near_edited_bands long, near_next_bands long")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint: a row for each row of ``docs``."""

    def run(batches):
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            prints = fingerprints(strings(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def alike(level: int, bits: np.ndarray, others: int, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``likeness`` of a fingerprint and each of ``rows``, whose level is ``others``; what is behind the end of a row is 2."""
    up, down = max(0, others - level), max(0, level - others)
    bits, rows, sizes = bits[::1 << up], rows[:, ::1 << down], (sizes + (1 << down) - 1) >> down
    both = min(len(bits), rows.shape[1])
    same = (rows[:, :both] == bits[:both]).sum(axis=1, dtype=np.int64)
    return np.where((sizes > 0) & (len(bits) > 0), np.maximum(0.0, 2.0 * same / np.maximum(1, np.maximum(sizes, len(bits))) - 1.0), 0.0)


def near_classes(prints: DataFrame, least: float = 0.75, block: int = BLOCK) -> DataFrame:
    """fingerprint, class_id: distinct fingerprints that share a band and are ``least`` alike are in one class.

    Equal fingerprints are one node. Each is compared with the first of its buckets; then the members of different components of
    a bucket are compared, two blocks of a large one at a time, and only links that connect leave the task.
    """
    def publish(batches):
        for batch in batches:
            for text, sid in zip(batch.column("fingerprint").to_pylist(), batch.column("sid").to_pylist()):
                keys = list(set(bands(text)))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([sid] * len(keys), pa.int64())], names=["key", "sid"])

    def verified(batches):
        for batch in batches:
            ok = [likeness(x, y) >= least for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def tie(side, sid, component, texts):
        parsed = [parse(x) for x in texts]
        levels, sizes = np.array([x for x, _ in parsed]), np.array([len(x) for _, x in parsed])
        rows = np.full((len(parsed), int(sizes.max(initial=1))), 2, np.uint8)
        for i, (_, bits) in enumerate(parsed):
            rows[i, :len(bits)] = bits
        for i, (level, bits) in enumerate(parsed):
            for other in np.unique(levels[i + 1:]):
                at = i + 1 + np.flatnonzero((levels[i + 1:] == other) & (component[i + 1:] != component[i])
                                            & ((side[i + 1:] != side[i]) | (side[i] == 0)))
                at = at[alike(level, bits, int(other), rows[at], sizes[at]) >= least]
                others, first = np.unique(component[at], return_index=True)
                yield from ((sid[i], sid[j]) for j in at[first])
                component[np.isin(component, others)] = component[i]

    def ties(batches):
        for part, key, *rest in parity_join.runs(batches, ["part", "key", "side", "sid", "component", "fingerprint"]):
            edges = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (key[1:] != key[:-1]), [True])))
            found = {p for x, y in zip(edges, edges[1:]) for p in tie(*(c[x:y] for c in rest))}
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])

    nodes = keep(prints.select("fingerprint").distinct().withColumn("sid", F.xxhash64("fingerprint")), "edit-nodes")
    shared = keep(nodes.mapInArrow(publish, "key long, sid long"), "edit-bands")
    firsts = shared.groupBy("key").agg(F.min("sid").alias("anchor"), F.count("*").alias("n")).filter("n > 1")
    members = keep(parity_join.among(shared, firsts.drop("n")), "edit-buckets")
    pairs = members.filter("anchor <> sid").select(F.col("anchor").alias("a"), F.col("sid").alias("b")).distinct()
    pairs = spread_join(pairs, nodes.select(F.col("sid").alias("a"), F.col("fingerprint").alias("x")), ["a"], "left", ["b"]) \
        .join(nodes.select(F.col("sid").alias("b"), F.col("fingerprint").alias("y")), "b").select("a", "b", "x", "y")
    links = keep(pairs.mapInArrow(verified, "a long, b long"), "edit-links")
    parts = keep(connected(links, "a", "b"), "edit-parts")
    rows = keep(parity_join.mixed(members.select("key", "sid"), parts), "edit-rows")
    rows = parity_join.blocks(rows, block).join(nodes, "sid").repartition("part").sortWithinPartitions("part", "key", "sid")
    links = keep(links.unionByName(rows.mapInArrow(ties, "a long, b long")), "edit-links")
    named = nodes.join(connected(links, "a", "b").withColumnRenamed("node", "sid"), "sid", "left")
    return named.select("fingerprint", F.coalesce("component", "sid").alias("class_id"))
