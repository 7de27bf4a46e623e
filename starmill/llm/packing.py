"""Packing documents into sequences: best fit, then a swap-based local search.

A document's ids, and the end id after them, are cut into pieces only if they are more than a sequence holds: full
pieces, of which only the first may be shorter. Full pieces are sequences of their own. The others are dealt at random
to groups of bounded size. In a group each piece, the longest first, goes to the fullest bin that it fits in. The local
search then takes the emptiest bin and tries to move its pieces to other underfull bins, to exchange one of its pieces for
a smaller one, or two of them for one. Every step raises the sum of squared fills, so it ends, when no bin has a step left; bins
that run empty go.
Pieces of bins that stay underfull meet those of other groups in a further round, until they are one group or no
round saves a sequence.

Edge cases: a null or empty text is the end id alone, a piece of length 1; repeated rows are documents of their own,
packed one by one; a text of any length is cut into full pieces; pieces of equal length are taken in the order of their ids, null first
or last; an empty table gives no rows; sequence ids are any numbers, the offsets in a sequence have no gaps; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.texts import by_bytes, id_and_text, keep, strings

SEQUENCE = 2048
GROUP_PIECES = 4096
UNDERFULL = 16  # a bin with fewer free tokens counts as full
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def encoder(ranks: str, pattern: str, special: tuple[tuple[str, int], ...]):
    """Encodes as the library of the .json file does: special strings inside a text get their id."""
    import tiktoken

    with open(ranks, "rb") as lines:
        known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    own = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=known, special_tokens=dict(special))
    names = {name for name, _ in special}
    return lambda text: own.encode(text, allowed_special=names, disallowed_special=())


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all full but the first."""
    first = n % most or min(n, most)
    return [(0, first)] + [(start, most) for start in range(first, n, most)] if n else []


def tokenise(docs: DataFrame, ranks: str, pattern: str, special: dict[str, int], end_id: int = 0,
             most: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece of each row of ``docs``: doc_id, piece, start, length, ids_crc32."""
    wanted = tuple(sorted(special.items()))

    def run(batches):
        encode = encoder(ranks, pattern, wanted)
        for batch in by_bytes(batches):
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text"))):
                ids = np.array([*encode(text), end_id], "<u4")
                out += [(doc, k, start, length, zlib.crc32(ids[start:start + length].tobytes()))
                        for k, (start, length) in enumerate(cut(len(ids), most))]
            doc, piece, start, length, crc = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PIECES)


class Bins:
    """Bins of one group: the lengths' places by bin, and the underfull bins by free room."""

    def __init__(self, lengths: list[int], most: int):
        self.lengths, self.most = lengths, most
        self.held: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """The longest piece first, each to the fullest bin with room for it."""
        room: list[tuple[int, int]] = []  # (free, bin), sorted
        for item in sorted(range(len(self.lengths)), key=lambda i: (-self.lengths[i], i)):
            size = self.lengths[item]
            at = bisect_left(room, (size, -1))
            if at < len(room):
                free, home = room.pop(at)
            else:
                free, home = self.most, len(self.held)
                self.held.append([])
                self.fill.append(0)
            self.held[home].append(item)
            self.fill[home] += size
            if free > size:
                insort(room, (free - size, home))

    def fewest(self) -> int:
        return -(-sum(self.lengths) // self.most)

    def search(self) -> None:
        """Empty the emptiest bins by steps that each raise the sum of squared fills.

        What one bin gives away makes room in it for pieces of emptier ones, which are then tried again. Ends at the least possible
        number of bins, or when no bin has a step left.
        """
        self.sizes = np.array(self.lengths, np.int64)
        self.home = np.empty(len(self.lengths), np.int64)
        for b, own in enumerate(self.held):
            self.home[own] = b
        self.full = np.array(self.fill, np.int64)
        alive, settled = int((self.full > 0).sum()), np.zeros(len(self.held), bool)
        while alive > self.fewest():
            open_bins = np.flatnonzero((self.full > 0) & (self.full < self.most) & ~settled)
            if len(open_bins) < 2:
                break
            source = int(open_bins[np.argmin(self.full[open_bins])])
            steps = 0
            while self.full[source] and self.step(source):
                steps += 1
            if not self.full[source]:
                alive -= 1
                settled[:] = False
                continue
            settled[source] = True
            if steps:  # there is more room now, which pieces of emptier bins may use
                least = np.full(len(self.full), self.most + 1)
                np.minimum.at(least, self.home, self.sizes)
                settled &= (least > self.most - self.full[source]) | (self.full >= self.full[source])
        for b in range(len(self.held)):
            self.held[b], self.fill[b] = [], int(self.full[b])
        for item, b in enumerate(self.home.tolist()):
            self.held[b].append(item)

    def move(self, item: int, target: int) -> None:
        self.full[self.home[item]] -= self.sizes[item]
        self.full[target] += self.sizes[item]
        self.home[item] = target

    def step(self, source: int) -> bool:
        """One move, one-for-one or two-for-one exchange out of ``source`` that raises the sum of squared fills: the target ends
        fuller than the source was. The one that takes most out of it, a move before all exchanges."""
        mine = np.flatnonzero(self.home == source)
        mine = mine[np.argsort(-self.sizes[mine], kind="stable")]
        room = np.where((self.full > 0) & (np.arange(len(self.full)) != source), self.most - self.full, -1)
        for item in mine:
            fits = np.where(self.full + self.sizes[item] > self.full[source], room - self.sizes[item], -1)
            if (fits >= 0).any():
                self.move(item, int(np.argmin(np.where(fits >= 0, fits, self.most + 1))))
                return True
        others = np.flatnonzero((room[self.home] > 0) & (self.full[self.home] + room[self.home] > self.full[source]))
        if not len(others):
            return False
        i, j = np.triu_indices(len(mine), 1)
        out = np.concatenate((self.sizes[mine], self.sizes[mine][i] + self.sizes[mine][j]))
        order = np.argsort(out, kind="stable")
        # of the moves out that a bin has room for beside one of its pieces, the largest
        most = self.sizes[others] + room[self.home[others]]
        at = np.searchsorted(out[order], most, "right") - 1
        gain = np.where(at >= 0, out[order][at] - self.sizes[others], 0)
        gain = np.where(self.full[self.home[others]] + gain > self.full[source], gain, 0)  # squared fills rise
        best = int(np.argmax(gain))
        if gain[best] <= 0:
            return False
        other, way = int(others[best]), int(order[at[best]])
        target = int(self.home[other])
        own = [mine[way]] if way < len(mine) else [mine[i[way - len(mine)]], mine[j[way - len(mine)]]]
        self.move(other, source)
        for item in own:
            self.move(int(item), target)
        return True


def pack_lengths(lengths: list[int], most: int = SEQUENCE) -> list[list[int]]:
    """Places of ``lengths`` by bin, none of which holds more than ``most``."""
    bins = Bins(lengths, most)
    bins.best_fit()
    bins.search()
    return [b for b in bins.held if b]


def pack_groups(pieces: DataFrame, groups: int, turn: int, most: int) -> DataFrame:
    """Packs each group by itself: the columns of ``pieces``, group, bin, offset, fill."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32")])
        lengths = rows.column("length").to_numpy()
        out = pack_lengths(lengths.tolist(), most)
        sizes = [len(b) for b in out]
        order = np.array([i for b in out for i in b], np.int64)
        upto = np.cumsum(lengths[order])
        ends = np.cumsum(sizes) - 1
        before = np.repeat(np.concatenate(([0], upto[ends[:-1]])), sizes)
        held = rows.take(pa.array(order)).append_column("bin", pa.array(np.repeat(np.arange(len(out)), sizes), pa.int64()))
        held = held.append_column("offset", pa.array(upto - lengths[order] - before, pa.int64()))
        return held.append_column("fill", pa.array(np.repeat(upto[ends], sizes) - before, pa.int64()))

    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "salt", F.lit(turn)), F.lit(groups)))
    return dealt.groupBy("part").applyInArrow(run, f"{PIECES}, salt long, part long, bin long, offset long, fill long")


def pack(pieces: DataFrame, most: int = SEQUENCE, group: int = GROUP_PIECES) -> DataFrame:
    """The columns of ``pieces``, sequence_id, offset: a row for each piece.

    ``group`` bounds the pieces that a task packs at a time; the number of groups grows with the input.
    """
    pieces = keep(pieces, "packing-pieces")  # texts are tokenised once
    full = pieces.filter(F.col("length") == most).withColumn("offset", F.lit(0).cast("long"))
    rest = pieces.filter(F.col("length") < most).withColumn("salt", F.monotonically_increasing_id())
    rest = keep(rest, "packing-rest")
    left, done, turn, before = rest.count(), [], 0, None
    while left:
        groups = max(1, -(-left // group))
        packed = keep(pack_groups(rest, groups, turn, most), "packing-round")
        last, bins = groups == 1, packed.select("part", "bin").distinct().count()
        if before is not None and bins >= before:
            last = True  # these pieces took no fewer sequences than in the round before
        enough = F.lit(True) if last else F.col("fill") > most - UNDERFULL
        done.append(packed.filter(enough).withColumn(
            "sequence", F.struct(F.lit(turn).alias("turn"), F.col("part"), F.col("bin"))))
        again = packed.filter(~enough)
        before, left = again.agg(F.count_distinct("part", "bin"), F.count("*")).first()
        rest, turn = again.select(*pieces.columns, "salt"), turn + 1
    names = [*pieces.columns, "offset"]
    number = F.expr("(cast(sequence.turn as long) * 1000000007 + sequence.part) * 1048576 + sequence.bin")
    out = full.select(*names, (-F.monotonically_increasing_id() - 1).alias("sequence_id"))
    for frame in done:
        out = out.unionByName(frame.select(*names, number.alias("sequence_id")))
    return out
