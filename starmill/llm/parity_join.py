"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct word shingles. Each hash is XORed into one of the ``m`` words
of a sketch, so two sketches differ in at most as many words as the sets' symmetric difference has members. Sets A and B
with J(A, B) >= 0.75 have sizes within a ratio of 4/3 and a symmetric difference of at most (|A| + |B|) / 7 = d: most of
the words are equal. Sizes are cut into bands, each with an ``m`` of its own, and a set also enters the band below if
its partners there can be that small. Of its non-empty words, ordered alike everywhere, a set needs to publish only the first
d + 1: at most d of them can miss from the partner's, so the first common one is among them on both sides
(pigeonhole). A set with fewer non-empty words publishes all of them and its empty ones too. So no pair is lost.

Words that hold more shingles come first in the order, because a passage that many documents share fills them less often.
Sets that publish an equal word meet in a bucket, where each meets the bucket's first; of these it is compared with the few
that it shares most buckets with. The links found give components, and only members of different components of a bucket are
then compared, block by block, by a second sketch of parity bits, about twice as many as members, whose Hamming distance also
bounds the symmetric difference from below. Of the pairs that pass, first a spanning part of each bucket is verified on whole
sets, which joins what belongs together; then every pair that passes and is still in two components. Equal sets are one node throughout.

No task holds a crowded bucket. Crowded buckets are told by the keys of a sample of the sets and dealt out in parts, all with one
anchor. To be compared, a bucket of more than ``BLOCK`` rows is cut into blocks, those of a large component apart from the rest, and each
two blocks that are not of one component meet in a group of their own.

Edge cases: without text or words a set is empty and linked with nothing; with fewer words than a shingle the whole
sequence is the only member; repeated rows and equal texts are in one class; rows without id take part, and their class has the
smallest id of the others, null if there is none; texts of any length are read whole; an empty table gives no rows; other columns are not read, so their names can't clash.
Set ids and shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starmill.llm.components import connected
from starmill.llm.texts import by_bytes, id_and_text, keep, strings
from starmill.operators.spread import spread_join

WIDTH = 5
LEAST_BITS = 128
PIECE = 1 << 20  # bytes of a text hashed at a time
SPACES = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
BROADCAST_IDS = 1_000_000  # 8 MB of ids; beyond that the ids are shuffled
BLOCK = 4096  # rows of a bucket that are held at once; a block of a larger bucket has about half as many
SEEN = 64  # sampled sets of a bucket of BLOCK
LISTED = 16  # keys by which a pair is known to be met in another bucket
ANCHORS = 4  # first sets of its buckets that a set is compared with before all others
BLOCK_WORDS = 1_000_000  # of the sketches compared at a time
C1, C2, C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
S27, S29, S30, S31 = (np.uint64(x) for x in (27, 29, 30, 31))
PLACES = 64  # of a word whose bytes' values are looked up


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    y = x >> S30
    y ^= x
    y *= C2
    z = y >> S27
    y ^= z
    y *= C3
    np.right_shift(y, S31, out=z)
    y ^= z
    return y


def _byte_values(code: np.ndarray) -> np.ndarray:
    """Value of a byte (the low 8 bits of ``code``) at a place of its word (the others); white space counts nothing."""
    return np.where(SPACES[code & 255], np.uint64(0), mix(code.astype(np.uint64) + C1))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of ``text``, in order: sums of mixed bytes and their places in the word."""
    raw = np.frombuffer(text.encode().lower(), np.uint8)  # bytes: only A-Z and the six ASCII white spaces
    gap = SPACES.take(raw)
    starts = ~gap
    starts[1:] &= gap[:-1]
    first = np.flatnonzero(starts)
    if not len(first):
        return np.empty(0, np.uint64)
    if len(raw) <= PIECE:
        return _hashed(raw, first)
    cuts = first[np.searchsorted(first, np.arange(0, len(raw), PIECE)[1:], "right").clip(1) - 1]  # at words, a piece at a time
    cuts = np.unique(np.concatenate((first[:1], cuts, [len(raw)])))
    return np.concatenate([_hashed(raw[a:b], first[np.searchsorted(first, a):np.searchsorted(first, b)] - a) for a, b in zip(cuts, cuts[1:])])


def _hashed(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of the words of ``raw`` that start at ``first``."""
    length = np.empty(len(first), np.int64)
    length[:-1] = first[1:] - first[:-1]
    length[-1] = len(raw) - first[-1]
    code = np.arange(len(raw) - first[0])
    code -= np.repeat(first - first[0], length)
    code <<= 8
    code += raw[first[0]:]
    values = byte_table().take(code) if length.max() <= PLACES else _byte_values(code)
    return np.add.reduceat(values, first - first[0])


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    return _byte_values(np.arange(PLACES << 8))


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """The set of ``text``: sorted distinct 64-bit hashes."""
    values = word_hashes(text)
    n = len(values)
    if not n:
        return values
    span = min(n, width)
    out = values[:n - span + 1] + np.uint64(span)
    for k in range(1, span):
        out ^= out >> S29
        out *= C1
        out += values[k:n - span + 1 + k]
    out = mix(out)
    out.sort()
    new = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=new[1:])
    return out[new]


def set_id(members: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63)


def width_of(n: int) -> int:
    """Parity bits of a set of ``n`` members: a power of two, at least three for two members."""
    return max(LEAST_BITS, 1 << (3 * n // 2 - 1).bit_length())


def parity_bits(members: np.ndarray) -> bytes:
    """Each member flips one bit."""
    bits = width_of(len(members))
    flips = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


@lru_cache(maxsize=1)
def bands() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest size, largest size and sketch words of each band. Band k holds the pairs whose smaller set has at least
    the smallest size of k and less than that of k + 1."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(-(-low[-1] * 16 // 9))
    starts = np.array(low, np.int64)
    most = (starts[1:] - 1) * 4 // 3
    words = np.ceil(0.3 * most + 2 * np.sqrt(most)).astype(np.int64) + 4
    return starts, most, words


def published(members: np.ndarray) -> np.ndarray:
    """Keys of the sketch words that a set publishes in its bands."""
    n = len(members)
    if not n:
        return np.empty(0, np.int64)
    starts, most, words = bands()
    own = int(np.searchsorted(starts, n, "right")) - 1
    out = [_keys(members, own, int(words[own]), (n + min(int(most[own]), 4 * n // 3)) // 7)]
    if own and n <= most[own - 1]:
        out.append(_keys(members, own - 1, int(words[own - 1]), (n + int(starts[own]) - 1) // 7))
    return np.concatenate(out).view(np.int64)


def _keys(members: np.ndarray, band: int, words: int, differ: int) -> np.ndarray:
    """The first ``differ`` + 1 non-empty words of the sketch; all words if there are not as many."""
    place = members >> np.uint64(32)
    place *= np.uint64(words)
    place >>= np.uint64(32)  # sorted, as the members are
    new = np.ones(len(place), bool)
    np.not_equal(place[1:], place[:-1], out=new[1:])
    first = np.flatnonzero(new)
    value = np.bitwise_xor.reduceat(mix(members + C1), first)
    where = place[first]
    held = np.empty(len(first), np.int64)
    held[:-1] = first[1:] - first[:-1]
    held[-1] = len(members) - first[-1]
    value ^= mix(where + np.uint64(band << 40))
    # a key starts with the number of members, the most first, so the order of keys is that of the words
    keys = mix(value) >> np.uint64(6)
    keys |= (63 - np.minimum(held, 63)).astype(np.uint64) << np.uint64(58)
    if len(first) <= differ:
        empty = np.ones(words, bool)
        empty[where.astype(np.int64)] = False
        return np.concatenate((keys, mix(mix(np.flatnonzero(empty).astype(np.uint64) + np.uint64(band << 40)))))
    return np.partition(keys, differ)[:differ + 1]


def describe(docs: DataFrame, width: int, every: int) -> DataFrame:
    """doc_id, n_shingles, sid (null for an empty set), bits: a row for each row; keys: what a sample of the sets, one in
    ``every``, publishes, once for each task that meets it."""

    def run(batches):
        met: set[int] = set()
        for batch in by_bytes(batches):
            sets = [shingles(t, width) for t in strings(batch.column("text"))]
            ids = [set_id(s) if len(s) else None for s in sets]
            keys = []
            for sid, members in zip(ids, sets):
                seen = sid is not None and sid % every == 0 and sid not in met
                keys.append(published(members) if seen else None)
                if seen:
                    met.add(sid)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()),
                pa.array([parity_bits(s) if len(s) else None for s in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "sid", "bits", "keys"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, sid long, bits binary, keys array<long>")


def crowded(nodes: DataFrame, every: int, block: int) -> DataFrame:
    """key, parts, anchor: the buckets of more than about half a block, as the sample tells, and a set of each."""
    seen = nodes.select("sid", F.explode("keys").alias("key")).groupBy("key").agg(
        F.count("*").alias("n"), F.min("sid").alias("anchor")).filter(F.col("n") * every > block // 2)
    return seen.select("key", F.ceil(F.col("n") * every * 2 / block).alias("parts"), "anchor")


def publish(docs: DataFrame, width: int) -> DataFrame:
    """key, sid: the published words of each set, once for each task that meets it."""

    def run(batches):
        met: set[int] = set()
        for batch in by_bytes(batches):
            ids, keys = [], []
            for text in strings(batch.column("text")):
                members = shingles(text, width)
                if len(members) and (sid := set_id(members)) not in met:
                    met.add(sid)
                    keys.append(published(members))
                    ids.append(np.full(len(keys[-1]), sid, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], names=["key", "sid"])

    return docs.mapInArrow(run, "key long, sid long")


def runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first column, in parts that hold all rows of their keys."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        if not len(now[0]):
            continue
        split = int(np.searchsorted(now[0], now[0][-1]))  # the last key may go on
        if split:
            yield [np.concatenate(c) for c in zip(*held, [x[:split] for x in now])]
            held = [[x[split:] for x in now]]
        elif held and held[-1][0][-1] != now[0][0]:
            yield [np.concatenate(c) for c in zip(*held)]
            held = [now]
        else:
            held.append(now)
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def meet(published_words: DataFrame, hot: DataFrame) -> DataFrame:
    """key, sid, anchor: the members of buckets with more than one set; the anchor is the smallest of a bucket, or the one
    given in ``hot`` (key, parts, anchor), whose buckets are dealt out in parts."""

    def run(batches):
        for part, key, sid, top, split in runs(batches, ["part", "key", "sid", "top", "split"]):
            same = np.concatenate(([False], part[1:] == part[:-1], [False]))
            several = same[1:] | same[:-1] | split  # most rows are alone, the others are few to sort
            if not several.any():
                continue
            part, key, sid, top, split = (x[several] for x in (part, key, sid, top, split))
            order = np.lexsort((sid, key, part))
            part, key, sid, top, split = (x[order] for x in (part, key, sid, top, split))
            new = np.concatenate(([True], (part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])))
            part, key, sid, top, split = (x[new] for x in (part, key, sid, top, split))
            first = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (key[1:] != key[:-1]))))
            size = np.diff(np.append(first, len(key)))
            anchor = np.where(split, top, np.repeat(sid[first], size))
            member = np.repeat(size > 1, size) | split
            if member.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[member]) for x in (key, sid, anchor)], names=["key", "sid", "anchor"])

    n_hot = hot.count()
    if n_hot:
        join = published_words.join(F.broadcast(hot), "key", "left") if n_hot <= BROADCAST_IDS else \
            spread_join(published_words, hot, ["key"], "left", ["sid"])
        part = F.xxhash64("key", F.pmod(F.xxhash64("sid", "key"), "parts"))
        dealt = join.select(
            F.when(F.col("parts").isNull(), F.col("key")).otherwise(part).alias("part"), "key", "sid",
            F.coalesce("anchor", F.lit(0)).alias("top"), F.col("parts").isNotNull().alias("split"))
        dealt = dealt.repartition("part").sortWithinPartitions("part")  # a sort by one number is by its digits
    else:
        dealt = published_words.repartition("key").sortWithinPartitions("key").select(
            F.col("key").alias("part"), "key", "sid", F.lit(0).cast("long").alias("top"), F.lit(False).alias("split"))
    return dealt.mapInArrow(run, "key long, sid long, anchor long")


def may_link(n: np.ndarray, bits: np.ndarray, m: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Pairwise: sizes within the ratio and sketches of one width no further apart than linked sets can be."""
    apart = np.bitwise_count(bits ^ other).sum(axis=-1, dtype=np.int64)
    return (4 * np.minimum(n, m) >= 3 * np.maximum(n, m)) & (7 * apart <= n + m)


def words_of(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, those of twice the ``width`` folded to it: the halves' parities add up."""
    rows = np.empty((len(bits), width // 64), np.uint64)
    for i, own in enumerate(bits):
        own = np.frombuffer(own, np.uint64)
        rows[i] = own if len(own) == rows.shape[1] else own[:rows.shape[1]] ^ own[rows.shape[1]:]
    return rows


def listed(rows: DataFrame) -> DataFrame:
    """sid, listed: the smallest keys of the buckets that each set is in, ``LISTED`` of them."""
    place = F.row_number().over(Window.partitionBy("sid").orderBy("key"))
    few = rows.select("sid", "key").withColumn("place", place).filter(F.col("place") <= LISTED)
    return few.groupBy("sid").agg(F.collect_list("key").alias("listed"))


def met_before(key: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairwise: whether two lists of keys have one in common that is below ``key``: the pair is met in that bucket too."""
    out = np.zeros(len(left), bool)
    for start in range(0, len(left), 100_000):
        a, b = left[start:start + 100_000], right[start:start + 100_000]
        for k in range(LISTED):
            out[start:start + 100_000] |= ((b == a[:, k:k + 1]) & (b < key)).any(axis=1)
    return out


def across(members: DataFrame, spanning: bool) -> DataFrame:
    """a, b: pairs of a bucket whose components differ and that may be linked; of ``blocks`` with n_shingles, bits, listed.

    Rows of their own (a is null) hold the keys of the buckets with such pairs. ``spanning`` leaves out the pairs that are
    connected by others of their bucket. Otherwise a pair is left out in buckets after one that the lists of both sets name, so
    that sets which share many buckets leave few rows, and none is lost. Buckets that a task has at a time share their pairs' rows.
    """

    def pairs(key, side, sid, component, n, bits, lists):
        order = np.argsort(n, kind="stable")
        side, sid, component, n, bits, lists = (x[order] for x in (side, sid, component, n, bits, lists))
        if not spanning:
            keys = np.full((len(lists), LISTED), np.iinfo(np.int64).max)
            for i, own in enumerate(lists):
                keys[i, :len(own)] = own
        widths = np.array([8 * len(x) for x in bits])  # sorted, as the sizes are
        for width in np.unique(widths):
            first, last = np.searchsorted(widths, [width, 2 * width])
            until = int(np.searchsorted(widths, 2 * width, "right"))
            words = words_of(bits[first:until], width)
            block = max(8, int((BLOCK_WORDS / words.shape[1]) ** 0.5))
            for start in range(int(first), int(last), block):
                rows = slice(start, min(start + block, int(last)))
                near = min(until, int(np.searchsorted(n, 4 * n[rows][-1] // 3, "right")))
                for at in range(start, near, block):
                    cols = slice(at, min(at + block, near))
                    ok = component[rows][:, None] != component[None, cols]
                    if side[0]:  # each of the two blocks meets itself elsewhere
                        ok &= side[rows][:, None] != side[None, cols]
                    if ok.any():
                        ok &= may_link(n[rows][:, None], words[rows.start - first:rows.stop - first][:, None, :],
                                       n[None, cols], words[None, cols.start - first:cols.stop - first, :])
                        if spanning:
                            ok = spanned(ok, component, rows, cols)
                        left, right = np.nonzero(ok)
                        if not spanning and len(left):
                            new = ~met_before(key, keys[rows][left], keys[cols][right])
                            left, right = left[new], right[new]
                        if len(left):
                            yield sid[rows][left], sid[cols][right]

    def run(batches):
        for part, key, *rest in runs(batches, ["part", "key", "side", "sid", "component", "n_shingles", "bits", "listed"]):
            edges = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (key[1:] != key[:-1]), [True])))
            found = [(key[x], p) for x, y in zip(edges, edges[1:]) for p in pairs(key[x], *(c[x:y] for c in rest))]
            if found:
                keys = np.unique(np.array([k for k, _ in found]))
                a, b = (np.concatenate(x) for x in zip(*(p for _, p in found)))
                a, b = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.array(keys), pa.nulls(len(a), pa.int64())]),
                     *(pa.concat_arrays([pa.nulls(len(keys), pa.int64()), pa.array(x)]) for x in (a, b))],
                    names=["key", "a", "b"])

    # in the same order everywhere, buckets with the same members span them by the same pairs
    return members.repartition("part").sortWithinPartitions("part", "key", "sid").mapInArrow(run, "key long, a long, b long")


def spanned(ok: np.ndarray, component: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
    """Of the pairs in ``ok`` those that connect; ``component`` is changed to what they connect."""
    kept = np.zeros_like(ok)
    for i in np.flatnonzero(ok.any(axis=1)):
        own = rows.start + i
        at = np.flatnonzero(ok[i] & (component[cols] != component[own]))
        if len(at):
            others, first = np.unique(component[cols][at], return_index=True)
            kept[i, at[first]] = True
            component[np.isin(component, others)] = component[own]
    return kept


def by_sketch(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that may be linked."""

    def run(batches):
        for batch in batches:
            col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            width = np.array([8 * min(len(x), len(y)) for x, y in zip(col["x"], col["y"])])
            size_ok = 4 * np.minimum(col["n"], col["m"]) >= 3 * np.maximum(col["n"], col["m"])
            ok = np.zeros(len(width), bool)
            for own in np.unique(width):
                at = np.flatnonzero((width == own) & size_ok)  # widths differ by two at most
                for part in np.array_split(at, 1 + len(at) * own // 64 // BLOCK_WORDS):
                    ok[part] = may_link(col["n"][part], words_of(col["x"][part], own),
                                        col["m"][part], words_of(col["y"][part], own))
            yield pa.RecordBatch.from_arrays([pa.array(col["a"][ok]), pa.array(col["b"][ok])], names=["a", "b"])

    left = nodes.select(F.col("sid").alias("a"), F.col("n_shingles").alias("n"), F.col("bits").alias("x"))
    right = nodes.select(F.col("sid").alias("b"), F.col("n_shingles").alias("m"), F.col("bits").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are linked: 100 * intersection >= percent * union."""

    def sets(batches):
        for batch in by_bytes(batches):
            own = [shingles(t, width) for t in strings(batch.column("text"))]
            ids = batch.column("sid").to_pylist()
            # an id may stand in several rows with other texts: only the set that is asked for counts
            found = [(set_id(s), s.tobytes()) for i, s in zip(ids, own) if len(s) and (i is None or set_id(s) == i)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                              pa.array([x[1] for x in found], pa.binary())], names=["sid", "members"])

    def run(batches):
        for batch in by_bytes(batches, "x"):
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(both) - common))
            kept = batch.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    pairs = keep(pairs, "parity-pairs")
    ends = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    ends = keep(ends.join(nodes, "sid").select("sid", "doc_id", "n_shingles"), "parity-ends")
    if ends.count() <= BROADCAST_IDS:
        ends = F.broadcast(ends)
    whole = docs.join(ends, "doc_id").select("sid", "text").mapInArrow(sets, "sid long, members binary")
    lost = ends.filter("doc_id is null").select("sid")
    if lost.head(1):  # sets all of whose rows lack an id are found by themselves
        own = docs.filter("doc_id is null").select(F.lit(None).cast("long").alias("sid"), "text").mapInArrow(sets, "sid long, members binary")
        whole = whole.unionByName(own.join(lost, "sid", "left_semi").dropDuplicates(["sid"]))
    whole = keep(whole, "parity-sets")
    left = whole.select(F.col("sid").alias("a"), F.col("members").alias("x"))
    right = whole.select(F.col("sid").alias("b"), F.col("members").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def join(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, sid, root (a set of the class), component_id (the smallest doc_id reachable by links of 0.75 or
    more) for each row."""
    percent = 75  # the bounds of the bands and of d hold for this similarity
    docs = id_and_text(docs, id_col, text_col)
    every = max(1, block // SEEN)
    about = keep(describe(docs, width, every), "parity-sets")
    nodes = about.filter("sid is not null").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"),
        F.first("keys", ignorenulls=True).alias("keys"))
    nodes = keep(nodes, "parity-nodes")
    hot = keep(crowded(nodes, every, block), "parity-crowded")
    members = keep(meet(publish(docs, width), hot), "parity-buckets")

    shared = members.filter("anchor <> sid").groupBy("sid", "anchor").count()
    most = Window.partitionBy("sid").orderBy(F.desc("count"), "anchor")
    first = shared.withColumn("place", F.row_number().over(most)).filter(F.col("place") <= ANCHORS)
    links = keep(verify(by_sketch(first.select(F.col("anchor").alias("a"), F.col("sid").alias("b")), nodes), docs, nodes, width, percent), "parity-links")
    parts = keep(connected(links, "a", "b"), "parity-parts")

    rows = keep(mixed(members.select("key", "sid"), parts), "parity-rows")
    described = nodes.select("sid", "n_shingles", "bits")
    none = F.array().cast("array<long>").alias("listed")
    some = keep(across(blocks(rows, block).join(described, "sid").select("*", none), True), "parity-spans")
    pairs = some.select("a", "b").filter("a is not null").distinct()
    links = keep(links.unionByName(verify(pairs, docs, nodes, width, percent)), "parity-links")
    parts = keep(connected(links, "a", "b"), "parity-parts")

    rows = keep(mixed(among(rows, some.select("key").filter("key is not null").distinct()).select("key", "sid"), parts), "parity-rows")
    members = blocks(rows, block).join(described, "sid").join(keep(listed(rows), "parity-lists"), "sid")
    rest = across(members, False).select("a", "b").filter("a is not null").distinct()
    rest = rest.join(pairs, ["a", "b"], "left_anti")
    links = links.unionByName(verify(rest, docs, nodes, width, percent))
    parts = connected(links, "a", "b").withColumnRenamed("node", "sid")

    roots = nodes.select("sid", "doc_id").join(parts, "sid", "left").withColumn("root", F.coalesce("component", "sid"))
    lowest = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    roots = roots.select("sid", "root").join(lowest, "root").select("sid", "root", "component_id")
    out = spread_join(about.drop("bits", "keys"), roots, ["sid"], "left", ["doc_id"])
    return out.select("doc_id", "n_shingles", "sid", "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def mixed(members: DataFrame, parts: DataFrame) -> DataFrame:
    """key, sid, component, n: the members of buckets with more than one component, n of each bucket."""
    rows = spread_join(members, parts.withColumnRenamed("node", "sid"), ["sid"], "left", ["sid"])
    rows = keep(rows.select("key", "sid", F.coalesce("component", "sid").alias("component")), "parity-rows")
    found = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    return among(rows, found.filter("low <> high").select("key", "n"))


def among(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` whose key is in ``keys``, hot keys split, with the other columns of ``keys``."""
    return spread_join(rows, keys.withColumn("__in", F.lit(True)), ["key"], "left", ["sid"]).filter("__in").drop("__in")


def blocks(rows: DataFrame, block: int) -> DataFrame:
    """part, key, side, sid, component of ``rows`` (key, sid, component, n): any two members of a bucket whose components
    differ are in one part, on other sides (1 and 2) or in one without sides (0). A bucket of up to ``block`` members is one part; of a
    larger one a part is two blocks. Components of more than half a block have blocks of their own, which do not meet each other.
    """
    whole = rows.filter(F.col("n") <= block).select(
        F.col("key").alias("part"), "key", F.lit(0).alias("side"), "sid", "component")
    large = rows.filter(F.col("n") > block)
    if not large.head(1):
        return whole
    sizes = keep(large.groupBy("key", "component").agg(F.count("*").alias("c")), "parity-sizes")
    cuts = F.ceil(F.col("c") * 2 / block)
    big = F.col("c") > block // 2
    totals = sizes.groupBy("key").agg(
        F.ceil(F.sum(F.when(big, 0).otherwise(F.col("c"))) * 2 / block).alias("pool"), F.sum(F.when(big, cuts).otherwise(0)).alias("owned"))
    before = Window.partitionBy("key").orderBy("component").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.filter(big).withColumn("cuts", cuts).withColumn("before", F.coalesce(F.sum("cuts").over(before), F.lit(0)))
    large = spread_join(large.drop("n"), own.drop("c"), ["key", "component"], "left", ["sid"])
    large = among(large, totals).withColumn("low", F.col("pool") + F.col("before"))
    place = F.xxhash64("sid", "key")
    x = F.when(F.col("cuts").isNull(), F.pmod(place, F.greatest("pool", F.lit(1)))).otherwise(
        F.col("low") + F.pmod(place, F.col("cuts")))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("pool") + F.col("owned") - 1), lambda y: F.col("cuts").isNull()
                      | (y < F.col("low")) | (y >= F.col("low") + F.col("cuts")))
    large = large.withColumn("x", x).withColumn("y", F.explode(others))
    return whole.unionByName(large.select(
        F.xxhash64("key", F.least("x", "y"), F.greatest("x", "y")).alias("part"), "key",
        F.when(F.col("x") == F.col("y"), 0).when(F.col("x") < F.col("y"), 1).otherwise(2).alias("side"), "sid", "component"))


def keep_one(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, as they were, with one row of each class: a row of its smallest id, a row without id only if it has no other.

    Rows without words are classes of their own. An id that stands in several rows, and null, is no name of a row: each of its rows
    goes or stays with the class of its own set.
    """
    joined = keep(join(docs, width, id_col, text_col), "parity-classes")
    own = "__class_id"
    ids = joined.filter("doc_id is not null")
    gone = ids.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias(own)).distinct()
    several = keep(ids.groupBy(F.col("doc_id").alias(own)).count().filter("count > 1").select(own), "parity-repeated")
    key = F.col(id_col).cast("long")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    single = docs.filter(key.isNotNull()).join(several, key == F.col(own), "left_anti").join(gone, key == F.col(own), "left_anti")
    rows = docs.filter(key.isNull()).unionByName(docs.join(several, key == F.col(own), "left_semi"))
    return single.unionByName(_kept(rows, joined, width, id_col, text_col))


def _kept(docs: DataFrame, joined: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that stay, told by their own sets."""

    def marked(batches):
        for batch in by_bytes(batches, text_col):
            sets = [shingles(t, width) for t in strings(batch.column(text_col))]
            yield batch.append_column("__sid", pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()))

    schema = StructType([*docs.schema.fields, StructField("__sid", LongType())])
    some = docs.mapInArrow(marked, schema)
    classes = joined.filter("sid is not null").select(
        F.col("sid").alias("__of"), "root", F.col("doc_id").alias("__id"), F.col("component_id").alias("__first")).distinct()
    first = F.col("__id").eqNullSafe(F.col("__first"))
    stay = some.join(classes.filter(first), (F.col("__sid") == F.col("__of")) & F.col(id_col).cast("long").eqNullSafe(F.col("__id")))
    stay = stay.dropDuplicates(["root"]).select(*docs.columns)
    return stay.unionByName(some.filter("__sid is null").select(*docs.columns))
